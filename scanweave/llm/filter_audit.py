"""How filters act on each other: what every order of them removes, from one pass over the documents."""

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

FILTERS = "ABCDE"
_ORDERS = ["".join(order) for order in permutations(FILTERS)]
_STEPS = len(_ORDERS) * len(FILTERS)
# Bits of a field of a wide counter. A field counts documents, so it stays below the number of all rows.
_FIELD = 64
_FIELDS = _STEPS + 1
_BYTES = _FIELDS * _FIELD // 8
_DUPLICATE = 1 << FILTERS.index("E")
_KINDS = ("documents", "good", "toxic")


def wide_outcomes(mask: int) -> int:
    """The wide integer of a document that fails the filters of `mask`.

    Field 5 * order + step is 1 where that step of that order removes the document, the last field is 1.
    """
    fails = {letter for i, letter in enumerate(FILTERS) if mask >> i & 1}
    wide = 1 << _STEPS * _FIELD
    for i, order in enumerate(_ORDERS):
        step = next((s for s, letter in enumerate(order) if letter in fails), None)
        if step is not None:
            wide |= 1 << (i * len(FILTERS) + step) * _FIELD
    return wide


_WIDE = [wide_outcomes(mask) for mask in range(1 << len(FILTERS))]


def _text_mask(body: bytes, characters: int) -> int:
    """Bits of the filters that look at one text only."""
    words = body.split()
    capitals = len(body) - len(body.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return (
        (len(words) < 100)
        | (100 * len(set(words)) < 80 * len(words)) << 1
        | (100 * capitals > 10 * characters) << 2
        | (len(body.translate(None, b"#$%&*|")) < len(body)) << 3
    )


def _marked(batches):
    for batch in batches:
        texts = batch.column(2)
        sizes = pc.utf8_length(texts).to_pylist()
        bodies = texts.cast(pa.binary()).to_pylist()
        masks = pa.array([_text_mask(body, n) for body, n in zip(bodies, sizes)], pa.int32())
        marks = pa.array([hashlib.blake2b(body, digest_size=16).digest() for body in bodies], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), masks, marks], ["id", "part", "mask", "mark"])


def failures(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Documents counted by `part`, the `mask` of the filters they fail (A is bit 0), `good` and `toxic`.

    Several rows may hold the same key; their `n` add up. A: under 100 words; B: fewer than 80 different
    words in 100; C: more than 10 capitals A-Z in 100 code points; D: holds one of #$%&*|; E: the same
    text as a document with a smaller id, decided by a 128-bit hash. A null text is an empty one, a null
    part the empty string. Rows that share their id do not make each other fail E; a null id is larger than
    all others and equal to other null ids. Labels that repeat an id count if one of them says so. Repeated rows count
    each; no rows give no rows; other columns are not read, whatever their names; a very long text costs a list of its words.

    The texts stay where they were read; 50 bytes a document are shuffled. Copies share all bits but E, so
    a group of copies is counted on the map side, and its least id decides E for whole counts.
    """
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    # Rows without an id meet no label; their hash spreads them over the tasks of the join.
    known = rows.mapInArrow(_marked, f"id {kind}, part string, mask int, mark binary").withColumn(
        "spread", F.when(F.col("id").isNull(), F.col("mark")).otherwise(F.lit(b""))
    )
    marked = labels.groupBy(F.col(id_column).alias("id"), F.lit(b"").alias("spread")).agg(
        *(F.max(F.coalesce(F.col(of) == 1, F.lit(False))).alias(name) for of, name in (("quality", "good"), ("toxic", "toxic")))
    )
    key = ["mark", "mask", "part", "good", "toxic"]
    joined = known.join(marked, ["id", "spread"], "left").fillna(False, ["good", "toxic"])
    alike = joined.groupBy("id", "spread", *key).agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "n")).alias("first")
    alike = alike.groupBy(*key).agg(F.sum("n").alias("n"), first)
    least = F.min(F.struct("first.no_id", "first.id")).over(Window.partitionBy("mark"))
    kept = F.when(F.struct("first.no_id", "first.id").eqNullSafe(least), F.col("first.n")).otherwise(0)
    later = F.struct(F.col("mask").bitwiseOR(_DUPLICATE).alias("mask"), (F.col("n") - F.col("kept")).alias("n"))
    both = F.explode(F.array(F.struct("mask", F.col("kept").alias("n")), later)).alias("count")
    counted = alike.withColumn("kept", kept).select("part", "good", "toxic", both)
    return counted.select("part", "count.mask", "good", "toxic", "count.n").where("n > 0")


def _packed(total: int) -> bytes:
    return total.to_bytes(_BYTES, "little")


def _rows_of(sums: dict) -> pa.RecordBatch:
    columns = [pa.array(list(sums), pa.string())]
    columns += [pa.array([_packed(sums[part][i]) for part in sums], pa.binary()) for i in range(len(_KINDS))]
    return pa.RecordBatch.from_arrays(columns, ["part", *_KINDS])


def _summed_masks(batches, most_parts: int = 2000):
    """Wide integers of the parts of a task: each row adds `n` times that of its mask."""
    sums: dict[str, list[int]] = {}
    for batch in batches:
        for part, mask, good, toxic, n in zip(*(column.to_pylist() for column in batch.columns)):
            wide = n * _WIDE[mask]
            total = sums.setdefault(part, [0] * len(_KINDS))
            total[0] += wide
            if good:
                total[1] += wide
            if toxic:
                total[2] += wide
        if len(sums) > most_parts:
            yield _rows_of(sums)
            sums = {}
    yield _rows_of(sums)


def _merged(batches):
    """Sums of neighbouring rows of the same part; input sorted by part."""
    part, total = None, []
    for batch in batches:
        for name, *packed in zip(*(column.to_pylist() for column in batch.columns)):
            more = [int.from_bytes(found, "little") for found in packed]
            if name != part:
                if part is not None:
                    yield part, total
                part, total = name, more
            else:
                total = [a + b for a, b in zip(total, more)]
    if part is not None:
        yield part, total


def _merge_again(batches):
    for part, total in _merged(batches):
        yield _rows_of({part: total})


def _fields(total: int) -> np.ndarray:
    return np.frombuffer(_packed(total), "<u8").astype(np.int64)


_RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def _unpacked(batches):
    """The 600 rows of each part."""
    place = {(order, letter): i * 5 + s for i, order in enumerate(_ORDERS) for s, letter in enumerate(order)}
    columns = [field.split()[0] for field in _RESULT.split(", ")]
    for part, totals in _merged(batches):
        fields = [_fields(total) for total in totals]
        removed = fields[0][:_STEPS].reshape(-1, len(FILTERS))
        kept = fields[0][_STEPS] - removed.cumsum(axis=1)
        at = {x: np.array([place[order, x] for order in _ORDERS]) for x in FILTERS}
        # At the first place a filter removes all it fails, at the last place what nothing else fails.
        first = {x: fields[0][next(place[o, x] for o in _ORDERS if o[0] == x)] for x in FILTERS}
        last = {x: fields[0][next(place[o, x] for o in _ORDERS if o[-1] == x)] for x in FILTERS}
        shapley = {x: fields[0][at[x]].sum() for x in FILTERS}
        letters = [letter for order in _ORDERS for letter in order]
        rows = removed.ravel()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part] * _STEPS, pa.string()),
                pa.array([order for order in _ORDERS for _ in FILTERS], pa.string()),
                pa.array(list(range(1, len(FILTERS) + 1)) * len(_ORDERS), pa.int32()),
                pa.array(kept.ravel(), pa.int64()),
                pa.array(rows, pa.int64()),
                pa.array(np.array([first[x] for x in letters]) - rows, pa.int64()),
                pa.array([last[x] for x in letters], pa.int64()),
                pa.array(fields[1][:_STEPS], pa.int64()),
                pa.array(fields[2][:_STEPS], pa.int64()),
                pa.array([shapley[x] for x in letters], pa.int64()),
            ],
            columns,
        )


def audit(counted: DataFrame, lanes: int = 64) -> DataFrame:
    """One row per part, order of the five filters and step, from rows of `failures`.

    `kept` after the step, `removed` by it, `redundant` (fails its filter, removed earlier),
    `unique_fails` (fails its filter only), `good_lost`, `toxic_lost` (removed by it), `shapley` (removed
    by its filter, summed over all orders). No rows give no rows.

    Every mask has a wide integer with a field per step of every order. Tasks sum them by part, so one row per part
    and task is shuffled, however hot a part is; `lanes` tasks a part merge those, one task the rest,
    each as a stream over sorted rows. Fields are 64 bits wide and hold counts of rows, so no sum carries over.
    """
    packed = "part string, " + ", ".join(f"{kind} binary" for kind in _KINDS)
    sums = counted.select("part", "mask", "good", "toxic", "n").mapInArrow(_summed_masks, packed)
    lane = (F.spark_partition_id() % lanes).alias("lane")
    dealt = sums.select("*", lane).repartition("part", "lane").sortWithinPartitions("part").drop("lane")
    merged = dealt.mapInArrow(_merge_again, packed)
    return merged.repartition("part").sortWithinPartitions("part").mapInArrow(_unpacked, _RESULT)


ORACLE = """
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body FROM documents
), split AS (
  SELECT *, list_filter(string_split_regex(body, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
         min(doc_id) OVER (PARTITION BY body) AS first_id
  FROM docs
), failed AS (
  SELECT doc_id, part, list_filter([
    CASE WHEN len(words) < 100 THEN 'A' END,
    CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' END,
    CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body) THEN 'C' END,
    CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' END,
    CASE WHEN coalesce(doc_id > first_id, first_id IS NOT NULL) THEN 'E' END], lambda f: f IS NOT NULL) AS fails
  FROM split
), masks AS (
  SELECT part, fails, count(*) AS n,
         count(*) FILTER (l.doc_id IS NOT NULL AND good) AS good, count(*) FILTER (l.doc_id IS NOT NULL AND bad) AS toxic
  FROM failed LEFT JOIN (
    SELECT doc_id, coalesce(max(quality = 1), false) AS good, coalesce(max(toxic = 1), false) AS bad FROM labels GROUP BY doc_id
  ) l USING (doc_id) GROUP BY part, fails
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x), orders AS (
  SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM orders), counts AS (
  SELECT part, o, step, o[step] AS x,
    sum(n) FILTER (NOT list_has_any(o[1:step], fails)) AS kept,
    sum(n) FILTER (list_contains(fails, o[step]) AND NOT list_has_any(o[1:step - 1], fails)) AS removed,
    sum(n) FILTER (list_contains(fails, o[step]) AND list_has_any(o[1:step - 1], fails)) AS redundant,
    sum(n) FILTER (fails = [o[step]]) AS unique_fails,
    sum(good) FILTER (list_contains(fails, o[step]) AND NOT list_has_any(o[1:step - 1], fails)) AS good_lost,
    sum(toxic) FILTER (list_contains(fails, o[step]) AND NOT list_has_any(o[1:step - 1], fails)) AS toxic_lost
  FROM masks, steps GROUP BY part, o, step
)
SELECT part, array_to_string(o, '') AS filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       (sum(coalesce(removed, 0)) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM counts
"""
