"""SimHash near-duplicates: fingerprints, a binary-trie self-join within a Hamming distance, components."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scanweave.llm.components import components
from scanweave.llm.tables import landed

_SEED = 42
_BITS = 64


def simhash(text: bytes, words: int = 4, at_once: int = 1 << 16) -> int:
    """Fingerprint of a UTF-8 text over shingles of `words` words between ASCII white space.

    A-Z count as a-z. Fewer words make one shingle of all; no words give 0. A bit is set if it is set in
    more than half of the shingles' XXH64 values.
    """
    import xxhash

    found = text.lower().split()
    if not found:
        return 0
    joined, digest = b" ".join(found), xxhash.xxh64_digest
    stops = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    width = min(words, len(found))
    ends = (stops[width - 1 :] - 1).tolist()
    starts = [0, *stops[: len(ends) - 1].tolist()]
    ones = np.zeros(_BITS, np.int64)
    for lo in range(0, len(ends), at_once):
        part = zip(starts[lo : lo + at_once], ends[lo : lo + at_once])
        values = b"".join([digest(joined[a:b], _SEED) for a, b in part])
        bits = np.unpackbits(np.frombuffer(values, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(ends)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = 4) -> DataFrame:
    """`doc_id`, `text_key` (MD5) and `fingerprint` (64 bits as a long) of every row; a null text has no words."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"), F.md5(body).alias("text_key"), body.cast("binary").alias("body")
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def compute(batches):
        for batch in batches:
            values = np.fromiter((simhash(body, words) for body in batch.column(2).to_pylist()), np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values.view(np.int64))], ["doc_id", "text_key", "fingerprint"]
            )

    return rows.mapInArrow(compute, f"doc_id {id_type}, text_key string, fingerprint long")


class _Links:
    """Which of n values are linked, as the smallest index of each class so far."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, one: np.ndarray, other: np.ndarray) -> None:
        while one.size:
            a, b = self.root[one], self.root[other]
            apart = a != b
            one, other, a, b = one[apart], other[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                further = self.root[self.root]
                if np.array_equal(further, self.root):
                    break
                self.root = further


def trie_self_join(
    values: np.ndarray,
    most: int,
    groups: np.ndarray | None = None,
    side: np.ndarray | None = None,
    leaf: int = 256,
    at_once: int = 1 << 20,
) -> np.ndarray:
    """Index of a linked value for every value: one and the same for each class.

    Two values of a group are linked if they differ in at most `most` bits; with `side`, only values of
    different sides are compared. The sorted values of a group are a binary trie whose nodes are ranges.
    Pairs of nodes go down together, one bit a step; the differing bits add up and a pair over the budget
    is dropped with all below it. Pairs of small nodes are compared directly, unless their values are in
    one class already.
    """
    groups = np.zeros(len(values), np.int64) if groups is None else groups
    order = np.lexsort((values, groups))
    keys = values[order]
    links = _Links(len(keys))
    # A frontier of node pairs: two ranges, the differing bits so far; `depth` bits are behind them.
    edges = np.flatnonzero(np.diff(groups[order])) + 1
    lo, hi = np.concatenate([[0], edges]), np.concatenate([edges, [len(keys)]])
    roots = np.stack([lo, hi, lo, hi, np.zeros_like(lo)], 1)[hi - lo > 1]
    waiting = [(0, roots)] if len(roots) else []
    while waiting:
        depth, pairs = waiting.pop()
        area = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
        small = area <= leaf if depth < _BITS else np.ones(len(pairs), bool)
        for part in _chunks(pairs[small], area[small], at_once):
            _compare(keys, order, part, most, side, links)
        pairs = pairs[~small]
        if not len(pairs):
            continue
        if len(pairs) > at_once:
            waiting += [(depth, pairs[at_once:]), (depth, pairs[:at_once])]
            continue
        bit = np.uint64(_BITS - 1 - depth)
        ones = np.concatenate([[0], np.cumsum((keys >> bit) & np.uint64(1)).astype(np.int64)])
        lo1, hi1, lo2, hi2, apart = pairs.T
        mid1, mid2 = hi1 - (ones[hi1] - ones[lo1]), hi2 - (ones[hi2] - ones[lo2])
        twin = lo1 == lo2
        below = [
            np.stack([lo1, mid1, lo2, mid2, apart], 1),
            np.stack([mid1, hi1, mid2, hi2, apart], 1),
            np.stack([lo1, mid1, mid2, hi2, apart + 1], 1),
            np.stack([mid1, hi1, lo2, mid2, apart + 1], 1)[~twin],
        ]
        pairs = np.concatenate(below)
        pairs = pairs[(pairs[:, 4] <= most) & (pairs[:, 0] < pairs[:, 1]) & (pairs[:, 2] < pairs[:, 3])]
        pairs = pairs[(pairs[:, 0] != pairs[:, 2]) | (pairs[:, 1] - pairs[:, 0] > 1)]
        if len(pairs):
            waiting.append((depth + 1, pairs))
    root = np.empty(len(keys), np.int64)
    root[order] = order[links.root]
    return root


def _chunks(pairs: np.ndarray, area: np.ndarray, most: int):
    ends = np.cumsum(area)
    start = 0
    while start < len(pairs):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right")))
        yield pairs[start:stop]
        start = stop


def _compare(keys, order, pairs, most, side, links) -> None:
    lo1, hi1, lo2, hi2, _ = pairs.T
    n1, n2 = hi1 - lo1, hi2 - lo2
    area = n1 * n2
    owner = np.repeat(np.arange(len(pairs)), area)
    within = np.arange(area.sum()) - np.repeat(np.cumsum(area) - area, area)
    one, other = lo1[owner] + within // n2[owner], lo2[owner] + within % n2[owner]
    wanted = links.root[one] != links.root[other]
    if side is not None:
        wanted &= side[order[one]] != side[order[other]]
    one, other = one[wanted], other[wanted]
    near = np.bitwise_count(keys[one] ^ keys[other]) <= most
    links.add(one[near], other[near])


# Blocks of neighbouring bits: values within four bits of each other agree in at least one of five.
_HOT = 4096
_PART = 2048


def _blocks(most: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of `most` + 1 blocks that make up the fingerprint."""
    width, more = divmod(_BITS, most + 1)
    out, high = [], _BITS
    for i in range(most + 1):
        size = width + (i < more)
        high -= size
        out.append((high, size))
    return out


def near_links(prints: DataFrame, most: int = 4) -> DataFrame:
    """Links (`one`, `other`) that connect all distinct `fingerprint`s within `most` bits of each other.

    Values that close agree in one of `most` + 1 blocks of bits, so the trie join runs on the values that
    share a block, many blocks side by side in a task. Values that share a block too often are dealt into parts and
    each pair of parts is joined by itself, so no group is larger than two parts. A class of m values gives m - 1
    links per group, not all its pairs.
    """
    spark = prints.sparkSession
    shards = prints.select(
        "fingerprint",
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(i).alias("block"),
                        F.shiftrightunsigned(F.shiftleft("fingerprint", _BITS - low - size), _BITS - size)
                        .cast("int")
                        .alias("value"),
                    )
                    for i, (low, size) in enumerate(_blocks(most))
                )
            )
        ).alias("shard"),
    ).select("fingerprint", "shard.block", "shard.value")
    hot = landed(
        shards.groupBy("block", "value")
        .count()
        .where(F.col("count") > _HOT)
        .select("block", "value", F.ceil(F.col("count") / _PART).cast("int").alias("parts")),
        "simhash-hot",
    )
    part = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    meets = F.explode(F.when(F.col("parts") > 1, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.lit(0))))
    dealt = (
        shards.join(hot, ["block", "value"], "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", part)
        .withColumn("meets", meets)
        .select(
            "fingerprint",
            "block",
            "value",
            "part",
            F.least("part", "meets").alias("first"),
            F.greatest("part", "meets").alias("second"),
        )
    )
    n_rows = (most + 1) * prints.count()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_rows // 500_000)

    def join(batches):
        tables = [batch for batch in batches if batch.num_rows]
        if not tables:
            return
        table = pa.Table.from_batches(tables)
        keys = [table.column(name).to_numpy() for name in ("block", "value", "first", "second")]
        values = table.column("fingerprint").to_numpy().view(np.uint64)
        order = np.lexsort(keys[::-1])
        changes = np.any([key[order][1:] != key[order][:-1] for key in keys], axis=0)
        groups = np.empty(len(order), np.int64)
        groups[order] = np.concatenate([[0], np.cumsum(changes)])
        side = np.where(keys[2] == keys[3], np.arange(len(order)) + (1 << 31), table.column("part").to_numpy())
        root = trie_self_join(values, most, groups, side)
        linked = np.flatnonzero(root != np.arange(len(root)))
        values = values.view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(values[linked]), pa.array(values[root[linked]])], ["one", "other"]
        )

    return dealt.repartition(tasks, "block", "value", "first", "second").mapInArrow(join, "one long, other long")


def near_duplicates(
    docs: DataFrame,
    most: int = 4,
    words: int = 4,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `fingerprint` (16 hex digits), `component_id`.

    Documents whose fingerprints differ in at most `most` bits are linked; `component_id` is the smallest
    id that can be reached. Texts without words, null and empty ones too, have fingerprint zero and are
    linked like any other. Copies are one fingerprint in the join. A null id takes part and stays null; a class
    of null ids alone has a null component. Repeated rows stay; no rows give none; other columns are not read.
    """
    prints = landed(fingerprints(docs, id_column, text, words), "simhash-prints")
    return prints.join(classes(prints, most), "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def classes(prints: DataFrame, most: int = 4) -> DataFrame:
    """`fingerprint`, `component` (its smallest fingerprint), `component_id` (its smallest document id)."""
    distinct = landed(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    # The links are read once, by the first round: not a table of their own.
    linked = components(near_links(distinct.select("fingerprint"), most))
    labelled = distinct.join(linked.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("component")
    )
    smallest = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return labelled.join(smallest, "component").select("fingerprint", "component", "component_id")


def keep_one(docs: DataFrame, most: int = 4, words: int = 4, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, with one row left of every class of near-duplicates.

    The smallest id stays, of equal ids the text with the smallest MD5, of equal rows one; null ids come
    last. Rows that go are found by id and text.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
        F.col(f"`{id_column}`").alias("doc_id"),
        F.md5(body).alias("text_key"),
    )
    prints = landed(fingerprints(docs, id_column, text, words), "simhash-prints")
    members = prints.join(classes(prints, most), "fingerprint").select("component", "doc_id", "text_key")
    members = members.groupBy("component", "doc_id", "text_key").agg(F.count("*").alias("times"))
    entry = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    first = members.groupBy("component").agg(F.min(entry).alias("first"))
    # Ids and texts, not classes, are the keys from here on: no class is large then.
    first = first.select("first.doc_id", "first.text_key", F.lit(True).alias("first"))
    same_text = members["doc_id"].eqNullSafe(first["doc_id"]) & (members["text_key"] == first["text_key"])
    members = landed(
        members.join(first, same_text, "left").select(
            members["doc_id"], members["text_key"], "times", F.coalesce("first", F.lit(False)).alias("stays")
        ),
        "simhash-members",
    )
    going, repeated = members.where("not stays"), members.where("stays and times > 1")

    def same(keys):
        return rows["doc_id"].eqNullSafe(keys["doc_id"]) & (rows["text_key"] == keys["text_key"])

    gone = going.select("doc_id", "text_key")
    if repeated.isEmpty():
        # Both sides grow with the corpus: never a copy of one in every task.
        return rows.join(gone.hint("merge"), same(gone), "left_anti").select("row.*")
    several = landed(repeated.select("doc_id", "text_key"), "simhash-repeated")
    single = rows.join(gone.union(several), same(gone.union(several)), "left_anti").select("row")
    once = rows.join(several, same(several), "left_semi").groupBy("doc_id", "text_key").agg(F.first("row").alias("row"))
    return single.union(once.select("row")).select("row.*")
