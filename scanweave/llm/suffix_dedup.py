"""Removal of byte strings that a document with a smaller id holds as well.

Matches of `GRAM` bytes are found shard by shard. A shard is a few megabytes of whole texts. Of every
`GRAM`-byte string the 16 bytes with the smallest hash are its anchor, so equal strings have equal anchors
wherever they stand, and a run of neighbouring strings shares one. Only strings whose anchor more than one
document has can match; their bytes, the anchor's context, go to the bucket of the anchor. There suffix arrays
and common prefixes over the contexts tell which strings are equal and which document holds each first.
Shards and buckets are merged by sorted keys and binary search.

The whole text of all shards is never compared shard against shard: that would grow with the square of the
input.
"""

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from scanweave.llm.suffix_arrays import common_prefixes, suffix_array
from scanweave.llm.tables import landed

GRAM, ANCHOR = 50, 16
SPREAD = GRAM - ANCHOR + 1
_BASE = 0x9E3779B97F4A7C15
_NO_ID = np.iinfo(np.int64).max
_PLACE_BITS = 40
_SPANS = pa.schema([("shard", pa.int64()), ("spans", pa.binary())])
# Bytes of text from which on shards and buckets grow.
_GROWING = 1 << 30


def _power_table(n: int, base: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Hashes:
    """Hashes of any stretches of a byte array; equal bytes have equal hashes wherever they stand."""

    _up, _down = _power_table(0, _BASE), _power_table(0, _BASE)

    def __init__(self, text: np.ndarray):
        if len(self._up) <= len(text):
            _Hashes._up = _power_table(len(text), _BASE)
            _Hashes._down = _power_table(len(text), pow(_BASE, -1, 1 << 64))
        self.sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((text + np.uint64(1)) * self._up[: len(text)], dtype=np.uint64, out=self.sums[1:])

    def of(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[ends] - self.sums[begins]) * self._down[begins])

    def sliding(self, width: int) -> np.ndarray:
        """Of the stretches of `width` bytes at every place."""
        return _mixed((self.sums[width:] - self.sums[:-width]) * self._down[: len(self.sums) - width])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Contexts:
    """Runs of neighbouring strings with one anchor: where the first begins, how many, in which text."""

    key: np.ndarray  # 47 bits of the anchor's hash
    content: np.ndarray  # hash of all bytes of the run
    first: np.ndarray
    count: np.ndarray
    text: np.ndarray

    def __getitem__(self, which) -> "Contexts":
        return Contexts(*(getattr(self, name)[which] for name in ("key", "content", "first", "count", "text")))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    out = values
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[: len(values) - width + 1], out[width - size :]) if size < width else out


def find_contexts(text: np.ndarray, ends: np.ndarray, block: int = 1 << 16) -> Contexts:
    """All contexts of a shard; `ends` has the end of every text in it."""
    n = len(text)
    parts = []
    for low in range(0, max(n - GRAM + 1, 0), block):
        high = min(low + block, n - GRAM + 1)  # strings begin at low to high - 1
        part = text[low : high + GRAM - 1]
        hashes = _Hashes(part)
        anchors = hashes.sliding(ANCHOR)
        # The smallest hash, the first of those that tie.
        marked = (anchors & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(anchors), dtype=np.uint64)
        anchor = (_sliding_least(marked, SPREAD) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # No string reaches across the end of a text.
        steps = np.zeros(high - low + 1, np.int64)
        near = ends[np.searchsorted(ends, low, "right") : np.searchsorted(ends, high + GRAM)]
        np.add.at(steps, np.clip(near - GRAM + 1 - low, 0, high - low), 1)
        np.add.at(steps, np.clip(near - low, 0, high - low), -1)
        whole = np.cumsum(steps[:-1]) == 0
        edge = np.ones(high - low, bool)
        edge[1:] = (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1])
        begins = np.flatnonzero(edge)
        counts = np.diff(np.concatenate([begins, [high - low]]))
        begins, counts = begins[whole[begins]], counts[whole[begins]]
        parts.append(
            (
                anchors[anchor[begins]] >> np.uint64(17),
                hashes.of(begins, begins + counts + GRAM - 1),
                begins + low,
                counts,
            )
        )
    if not parts:
        return Contexts(*(np.zeros(0, kind) for kind in (np.uint64, np.uint64, np.int64, np.int64, np.int64)))
    key, content, first, count = (np.concatenate(column) for column in zip(*parts))
    return Contexts(key, content, first, count, np.searchsorted(ends, first, "right"))


def _pack(keys: np.ndarray) -> bytes:
    """48-bit numbers, six bytes each."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def merged_spans(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of stretches as separate stretches in order."""
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    new = np.ones(len(begins), bool)
    new[1:] = begins[1:] > ends[:-1]
    heads = np.flatnonzero(new)
    tails = np.concatenate([heads[1:], [len(begins)]]) - 1 if len(heads) else heads
    return begins[heads], ends[tails]


def _pairs(begins: np.ndarray, ends: np.ndarray) -> bytes:
    return np.stack((begins, ends), axis=1).astype("<i8").tobytes()


def _blobs(raw: bytes, edges: np.ndarray) -> pa.Array:
    """The stretches of `raw` between the edges as binary values."""
    edges = pa.py_buffer(np.ascontiguousarray(edges, np.int32))
    return pa.Array.from_buffers(pa.binary(), edges.size // 4 - 1, [None, edges, pa.py_buffer(raw)])


def _joined(column) -> tuple[bytes, np.ndarray]:
    """All binary values of a column one after the other, and their lengths."""
    values = column.to_pylist()
    return b"".join(values), np.array([len(value) for value in values], np.int64)


def _groups(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before it."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.any([column[1:] != column[:-1] for column in columns], axis=0)
    return new


def shards(docs: DataFrame, id_column: str, text: str, shard_bytes: int) -> DataFrame:
    """Written table of about `shard_bytes` of whole texts a row: `shard`, `ids`, `sizes`, `body` (compressed)."""
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("body"),
    )

    def gather(batches):
        number, ids, bodies, total = TaskContext.get().partitionId() << 32, [], [], 0

        def shard():
            values = [pa.array([number], pa.int64())]
            values += [pa.array([part], pa.list_(pa.int64())) for part in (ids, [len(body) for body in bodies])]
            values.append(pa.array([_squeezed(b"".join(bodies))], pa.binary()))
            return pa.RecordBatch.from_arrays(values, ["shard", "ids", "sizes", "body"])

        for batch in batches:
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bodies and total + len(body) > shard_bytes:
                    yield shard()
                    number, ids, bodies, total = number + 1, [], [], 0
                ids.append(doc_id)
                bodies.append(body)
                total += len(body)
        if bodies:
            yield shard()

    return landed(
        rows.mapInArrow(gather, "shard long, ids array<bigint>, sizes array<bigint>, body binary"), "repeats-shards"
    )


def _squeezed(body: bytes) -> bytes:
    return pa.compress(body, "zstd", asbytes=True)


def _text(body: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(body, size, "zstd", asbytes=True) if size else b"", np.uint8)


def _shard_rows(batches, *more: str):
    """Each shard as (shard, ids, ends, text, further columns); a missing id is larger than all others."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            at = {name: row.column(name)[0] for name in ("shard", "ids", "sizes", "body", *more)}
            ids = np.array([_NO_ID if x is None else x for x in at["ids"].as_py()], np.int64)
            ends = np.cumsum(np.array(at["sizes"].as_py(), np.int64))
            text = _text(at["body"].as_py(), int(ends[-1]))
            yield at["shard"].as_py(), ids, ends, text, *(at[name].as_py() for name in more)


def _anchor_lists(buckets: int):
    """Per shard and bucket: its anchors, whether two of its texts share them, how many contexts they have."""

    def run(batches):
        for shard, _, ends, text in _shard_rows(batches):
            found = find_contexts(text, ends)
            order = np.argsort(found.key)
            new = _groups(found.key[order])
            # Contents count where a key comes again.
            again = np.flatnonzero(~new | ~np.append(new[1:], True))
            part = order[again]
            order[again] = part[np.lexsort((found.content[part], found.key[part]))]
            found = found[order]
            heads = np.flatnonzero(new)
            texts_low, texts_high = (
                f.reduceat(found.text, heads) if len(heads) else heads for f in (np.minimum, np.maximum)
            )
            different = np.add.reduceat(_groups(found.key, found.content).astype(np.int64), heads) if len(heads) else heads
            keys = found.key[heads]
            marked = (keys << np.uint64(1)) | (texts_low != texts_high).astype(np.uint64)
            bucket = (keys % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            starts = np.append(np.flatnonzero(_groups(bucket)), len(order))
            often = different[order] > 1
            several = order[often]
            upto = np.append(0, np.cumsum(often))[starts]
            contexts = np.minimum(different[several], 2**32 - 1).astype("<u4").tobytes()
            if len(order):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[starts[:-1]], pa.int32()),
                        pa.array(np.full(len(starts) - 1, shard), pa.int64()),
                        _blobs(_pack(marked[order]), 6 * starts),
                        _blobs(_pack(keys[several]), 6 * upto),
                        _blobs(contexts, 4 * upto),
                    ],
                    ["bucket", "shard", "anchors", "several", "contexts"],
                )

    return run, "bucket int, shard long, anchors binary, several binary, contexts binary"


def _shared_anchors(most_contexts: int):
    """Per shard: those of its anchors that two texts have; the lowest bit marks anchors with too many contexts."""

    def run(table):
        raw, sizes = _joined(table.column("anchors"))
        marked, row = _unpack(raw), np.repeat(np.arange(len(sizes)), sizes // 6)
        keys = np.sort(marked >> np.uint64(1))
        heads = np.flatnonzero(_groups(keys))
        often = np.diff(np.concatenate([heads, [len(keys)]]))
        keys = keys[heads]
        within = np.unique(marked[(marked & np.uint64(1)) == 1] >> np.uint64(1))
        contexts = often.astype(np.int64)
        several, more = (_joined(table.column(name))[0] for name in ("several", "contexts"))
        np.add.at(contexts, np.searchsorted(keys, _unpack(several)), np.frombuffer(more, "<u4").astype(np.int64) - 1)
        shared = often > 1
        shared[np.searchsorted(keys, within)] = True
        at = np.searchsorted(keys, marked >> np.uint64(1))
        row, at = row[shared[at]], at[shared[at]]
        edges = np.append(np.flatnonzero(_groups(row)), len(row))
        packed = _pack((keys[at] << np.uint64(1)) | (contexts[at] > most_contexts).astype(np.uint64))
        return pa.table({"shard": table.column("shard").take(pa.array(row[edges[:-1]])), "anchors": _blobs(packed, 6 * edges)})

    return run, "shard long, anchors binary"


_SENT = "bucket int, shard long, keys binary, counts binary, places binary, body binary, spans binary"


def _sent(text, begins, bucket, shard, keys, ids, firsts, counts, at_once: int = 1 << 22):
    """Rows of the contexts that begin at `begins` in `text`: one for each bucket and shard, whose contexts stand together, in
    the order of the shard, so that ids and places are small steps."""
    starts = np.append(np.flatnonzero(_groups(bucket, shard)), len(keys))
    heads, sizes = starts[:-1], counts + GRAM - 1
    steps = []
    for part in (ids, firsts):
        step = np.diff(part, prepend=0)
        step[heads] = part[heads]
        steps.append(step.astype("<i8").view(np.uint8).reshape(-1, 8))
    steps = np.concatenate(steps, axis=1)
    upto = np.append(0, np.cumsum(sizes))[starts]
    for _, a, b in _runs(upto[:-1] // at_once):
        low, high = starts[a], starts[b]
        body = memoryview(_taken(text, begins[low:high], sizes[low:high]))
        edges = upto[a : b + 1] - upto[a]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[heads[a:b]], pa.int32()),
                pa.array(shard[heads[a:b]], pa.int64()),
                _blobs(_pack(keys[low:high]), 6 * (starts[a : b + 1] - low)),
                _blobs(counts[low:high].astype(np.uint8).tobytes(), starts[a : b + 1] - low),
                pa.array([_squeezed(steps[i:j].T.tobytes()) for i, j in zip(starts[a:b], starts[a + 1 : b + 1])], pa.binary()),
                pa.array([_squeezed(body[i:j]) for i, j in zip(edges, edges[1:])], pa.binary()),
                pa.array([b""] * (b - a), pa.binary()),
            ],
            ["bucket", "shard", "keys", "counts", "places", "body", "spans"],
        )


def _only_spans(bucket: int, shards, spans: pa.Array) -> pa.RecordBatch:
    nothing = pa.array([b""] * len(spans), pa.binary())
    columns = [pa.array([bucket] * len(spans), pa.int32()), pa.array(shards, pa.int64()), *[nothing] * 4, spans]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "shard", "keys", "counts", "places", "body", "spans"])


def _received(table) -> tuple[np.ndarray, ...]:
    """Shard, key, id, place, count of all contexts of the rows, and their bytes."""
    raw, n = _joined(table.column("counts"))
    counts = np.frombuffer(raw, np.uint8).astype(np.int64)
    edges = np.append(0, np.cumsum(n))
    sizes = np.diff(np.append(0, np.cumsum(counts))[edges]) + (GRAM - 1) * n
    columns = [np.repeat(table.column("shard").to_numpy(), n), _unpack(_joined(table.column("keys"))[0])]
    steps = np.empty((len(counts), 16), np.uint8)
    for part, a, b in zip(table.column("places").to_pylist(), edges.tolist(), edges[1:].tolist()):
        steps[a:b] = _text(part, 16 * (b - a)).reshape(16, b - a).T
    steps = steps.view("<i8")
    filled = np.flatnonzero(n)
    for step in (steps[:, 0], steps[:, 1]):
        total = np.cumsum(step)
        # Every row begins anew.
        columns.append(total - np.repeat(np.append(0, total)[edges[filled]], n[filled]))
    body = np.empty(sizes.sum(), np.uint8)
    upto = np.append(0, np.cumsum(sizes)).tolist()
    for part, a, b in zip(table.column("body").to_pylist(), upto, upto[1:]):
        body[a:b] = _text(part, b - a)
    return (*columns, counts, body)


def _taken(text: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of the stretches, one after the other."""
    ends = np.cumsum(sizes)
    return text[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - sizes), sizes)]


def _send_contexts(buckets: int):
    """What a shard cannot decide alone: the contexts of shared anchors, each once, from its smallest id.

    Equal contexts of larger ids are duplicates right away; their spans go along. Contexts of anchors that
    have too many are cut into single strings, each dealt to a bucket by its own hash.
    """

    def run(batches):
        for shard, ids, ends, text, lists in _shard_rows(batches, "lists"):
            shared = np.sort(np.concatenate([_unpack(raw) for raw in lists or []] or [np.zeros(0, np.uint64)]))
            if not len(shared):
                continue
            found = find_contexts(text, ends)
            order = np.argsort(found.key)
            key = found.key[order]
            at = np.minimum(np.searchsorted(shared, key << np.uint64(1)), len(shared) - 1)
            hit = (shared[at] >> np.uint64(1)) == key
            found, frequent = found[order[hit]], (shared[at[hit]] & np.uint64(1)) == 1
            if frequent.any():
                found = _cut(text, found, frequent)
            doc = ids[found.text]
            order = np.lexsort((found.first, doc, found.content, found.key))
            found, doc = found[order], doc[order]
            heads = np.flatnonzero(_groups(found.key, found.content))
            smallest = np.repeat(doc[heads], np.diff(np.concatenate([heads, [len(doc)]])))
            later = found[doc > smallest]
            spans = _pairs(*merged_spans(later.first, later.first + later.count + GRAM - 1))
            if spans:
                yield _only_spans(shard % buckets, [shard], pa.array([spans], pa.binary()))
            mine, doc = found[doc == smallest], doc[doc == smallest]
            bucket = (mine.key % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((mine.first, bucket))
            mine, doc, bucket = mine[order], doc[order], bucket[order]
            yield from _sent(text, mine.first, bucket, np.full(len(doc), shard), mine.key, doc, mine.first, mine.count)

    return run, _SENT


def _cut(text: np.ndarray, found: Contexts, which: np.ndarray) -> Contexts:
    """The marked contexts as single strings with their own keys."""
    kept, cut = found[~which], found[which]
    sizes = cut.count
    first = np.repeat(cut.first, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    content = []
    for low in range(0, len(first), 1 << 16):
        part = first[low : low + (1 << 16)]
        rows = _taken(text, part, np.full(len(part), GRAM))
        at = np.arange(len(part)) * GRAM
        content.append(_Hashes(rows).of(at, at + GRAM))
    content = np.concatenate(content)
    single = Contexts(
        _mixed(content) >> np.uint64(17), content, first, np.ones(len(first), np.int64), np.repeat(cut.text, sizes)
    )
    return Contexts(
        *(np.concatenate([getattr(kept, n), getattr(single, n)]) for n in ("key", "content", "first", "count", "text"))
    )


def first_holders(text: np.ndarray, begins: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For every string of every context (its first `counts` places), the smallest id whose contexts hold it.

    Suffix array over all contexts, common prefixes of the wanted suffixes next to each other, and the
    smallest id of every run that shares `GRAM` bytes; indexed by place in `text`.
    """
    wanted = np.zeros(len(text), bool)
    wanted[_taken(np.arange(len(text)), begins, counts)] = True
    order = suffix_array(text)
    order = order[wanted[order]]
    before = np.full(len(text), -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = common_prefixes(text, before, begins, counts, GRAM)
    owner = np.zeros(len(text), np.int64)
    owner[_taken(np.arange(len(text)), begins, counts)] = np.repeat(ids, counts)
    out = np.full(len(text), _NO_ID, np.int64)
    heads = np.flatnonzero(shared[order] < GRAM)
    if len(order):
        least = np.minimum.reduceat(owner[order], heads)
        out[order] = np.repeat(least, np.diff(np.concatenate([heads, [len(order)]])))
    return out


def _resolve(last: bool, at_once: int = 1 << 23):
    """Merge what shards sent to a bucket: spans of duplicates per shard.

    Equal contexts are duplicates in all but the smallest id. In the last round, what is left of anchors
    with several contexts goes through suffix arrays, `at_once` bytes of contexts at a time, all contexts
    of an anchor together.
    """

    def run(table):
        shard, key, doc, first, count, text = _received(table)
        sizes = count + GRAM - 1
        begins = np.cumsum(sizes) - sizes
        content = np.zeros(len(key), np.uint64)
        for low in range(0, len(key), 1 << 15):
            part = slice(low, low + (1 << 15))
            base = begins[low]
            hashes = _Hashes(text[base : begins[part][-1] + sizes[part][-1]])
            content[part] = hashes.of(begins[part] - base, begins[part] + sizes[part] - base)
        order = np.lexsort((first, shard, doc, content, key))
        shard, key, doc, first, count, content, begins, sizes = (
            column[order] for column in (shard, key, doc, first, count, content, begins, sizes)
        )
        new = _groups(key, content)
        heads = np.flatnonzero(new)
        same = np.cumsum(new) - 1  # which different context
        smallest = doc[heads][same] if len(heads) else doc
        later = doc > smallest
        spans = [(shard[later], first[later], first[later] + sizes[later])]
        if last:
            spans.append(_by_suffixes(text, key, doc, begins, count, heads, same, later, shard, first, at_once))
        owner, low, high = (np.concatenate(column) for column in zip(*spans))
        # Spans of all shards at once: places stay below 1 << _PLACE_BITS.
        shards, rank = np.unique(owner, return_inverse=True)
        shift = rank.astype(np.int64) << _PLACE_BITS
        low, high = merged_spans(low + shift, high + shift)
        rank = low >> _PLACE_BITS
        low, high = low - (rank << _PLACE_BITS), high - (rank << _PLACE_BITS)
        found = _blobs(_pairs(low, high), 16 * np.searchsorted(rank, np.arange(len(shards) + 1)))
        sent = table.select(["shard", "spans"]).filter(pc.greater(pc.binary_length(table.column("spans")), 0))
        if last:
            return pa.concat_tables([pa.table({"shard": pa.array(shards, pa.int64()), "spans": found}), sent.cast(_SPANS)])
        bucket = table.column("bucket")[0].as_py()
        kept = np.flatnonzero(~later)
        kept = kept[np.lexsort((first[kept], shard[kept]))]
        out = list(_sent(text, begins[kept], np.full(len(kept), bucket), *(x[kept] for x in (shard, key, doc, first, count))))
        out.append(_only_spans(bucket, shards, found))
        out.append(_only_spans(bucket, sent["shard"].combine_chunks(), sent["spans"].combine_chunks()))
        return pa.Table.from_batches(out)

    return run, "shard long, spans binary" if last else _SENT


def _runs(values: np.ndarray):
    heads = np.flatnonzero(_groups(values))
    for a, b in zip(heads, [*heads[1:], len(values)]):
        yield int(values[a]), int(a), int(b)


def _by_suffixes(text, key, doc, begins, count, heads, same, later, shard, first, at_once):
    """Duplicate strings in the different contexts of anchors that have more than one."""
    anchors = _groups(key[heads])
    per_anchor = np.diff(np.concatenate([np.flatnonzero(anchors), [len(heads)]]))
    several = np.repeat(per_anchor, per_anchor) > 1 if len(heads) else anchors
    chosen = heads[several]
    sizes = count[chosen] + GRAM - 1
    holder = np.full(len(heads), -1)
    owner, low = [], []
    # Cut between anchors, at about `at_once` bytes.
    number = np.cumsum(_groups(key[chosen])) - 1
    total = np.bincount(number, sizes) if len(chosen) else np.zeros(0)
    batch = (np.cumsum(total) // at_once).astype(np.int64)[number] if len(chosen) else number
    holder[several] = np.arange(len(chosen))
    mine = np.flatnonzero(~later & several[same]) if len(heads) else heads
    slot = holder[same[mine]]
    for _, a, b in _runs(batch):
        part = chosen[a:b]
        body = _taken(text, begins[part], sizes[a:b])
        at = np.cumsum(sizes[a:b]) - sizes[a:b]
        least = first_holders(body, at, count[part], doc[part])
        rows = mine[(slot >= a) & (slot < b)]
        where = at[holder[same[rows]] - a]
        n = count[rows]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        hit = least[np.repeat(where, n) + step] < np.repeat(doc[rows], n)
        owner.append(np.repeat(shard[rows], n)[hit])
        low.append((np.repeat(first[rows], n) + step)[hit])
    if not owner:
        none = np.zeros(0, np.int64)
        return none, none, none
    owner, low = np.concatenate(owner), np.concatenate(low)
    return owner, low, low + GRAM


def _finish(batches):
    """One row per document: what was removed and the hash of what is left; `kept` is the text itself."""
    for _, ids, ends, text, raw in _shard_rows(batches, "spans"):
        low, high = merged_spans(*np.frombuffer(b"".join(raw or []), "<i8").reshape(-1, 2).T)
        # Cut at the ends of texts: spans of neighbours may touch.
        inner = np.concatenate([low, ends[:-1]])
        inner = np.unique(inner)
        at = np.searchsorted(low, inner, "right") - 1
        inside = (at >= 0) & (inner < (high[np.maximum(at, 0)] if len(high) else 0))
        low2 = inner[inside]
        limit = ends[np.minimum(np.searchsorted(ends, low2, "right"), len(ends) - 1)]
        high2 = np.minimum(high[at[inside]], limit)
        text_of = np.searchsorted(ends, low2, "right")
        starts = np.concatenate([[0], ends[:-1]])
        raw_bytes = text.tobytes()
        edges = np.searchsorted(text_of, np.arange(len(ends) + 1))
        rows = []
        for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
            parts, place, removed = [], a, 0
            for j in range(edges[i], edges[i + 1]):
                parts.append(raw_bytes[place : low2[j]])
                place = int(high2[j])
                removed += place - int(low2[j])
            parts.append(raw_bytes[place:b])
            kept = b"".join(parts)
            doc_id = None if ids[i] == _NO_ID else int(ids[i])
            rows.append((doc_id, b - a, removed, int(edges[i + 1] - edges[i]), hashlib.sha256(kept).hexdigest(), kept))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
        yield pa.RecordBatch.from_arrays(
            columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        )


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shard_bytes: int = 4 << 20,
    most_contexts: int = 50_000,
    fan_in: int = 4096,
    bucket_bytes: int = 4 << 20,
) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256`, `kept` (bytes).

    Every byte goes that a 50-byte string covers which also begins in a document with a smaller id, judged on
    the texts as they came. Ids are whole numbers; a null id is larger than all others, and rows with
    the same id take nothing from each other. A null text is empty; texts under 50 bytes stay whole; no
    rows give none; other columns are not read.

    From a gigabyte on, shards and buckets grow with the root of the texts' bytes, up to four and two times.

    The texts are written once, compressed, and shuffled once, by shard; both joins read that shuffle. Anchors with more than
    `most_contexts` different contexts are cut into single strings, so that no bucket holds a hot one, and more than
    `fan_in` shards are merged in rounds.
    """
    size = F.octet_length(F.col(f"`{text}`").cast("string"))
    total = docs.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0]
    tasks = max(1, -(-total // (16 << 20)))
    # What a shard sends to a bucket is a row: as many as both together.
    grown = max(1.0, (total / _GROWING) ** 0.5)
    shard_bytes, bucket_bytes = int(shard_bytes * min(4.0, grown)), int(bucket_bytes * min(2.0, grown))
    buckets = max(1, min(1 << 20, total // bucket_bytes))
    texts = shards(docs, id_column, text, shard_bytes)

    run, shape = _anchor_lists(int(buckets))
    lists = texts.mapInArrow(run, shape)
    texts = texts.repartition(int(tasks), "shard")
    run, shape = _shared_anchors(most_contexts)
    shared = lists.groupBy("bucket").applyInArrow(run, shape)
    shared = shared.groupBy("shard").agg(F.collect_list("anchors").alias("lists"))

    run, shape = _send_contexts(int(buckets))
    sent = texts.join(shared.hint("shuffle_hash"), "shard", "left").mapInArrow(run, shape)
    n_shards = total // shard_bytes
    while n_shards > fan_in:
        run, shape = _resolve(last=False)
        n_shards = -(-n_shards // fan_in)
        sent = sent.groupBy("bucket", F.pmod(F.xxhash64("shard"), F.lit(n_shards))).applyInArrow(run, shape)
    run, shape = _resolve(last=True)
    spans = sent.groupBy("bucket").applyInArrow(run, shape)
    spans = spans.groupBy("shard").agg(F.collect_list("spans").alias("spans"))
    shape = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return texts.join(spans.hint("shuffle_hash"), "shard", "left").mapInArrow(_finish, shape)


#: DuckDB twin of the registered query, string by string; for small tables.
ORACLE = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 49, 0))) AS i FROM d),
g AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM p),
m AS (SELECT s, min(doc_id) AS first_id FROM g GROUP BY s),
c AS (SELECT doc_id, i FROM g JOIN m USING (s) WHERE first_id < doc_id),
e AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM c),
n AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM e),
s AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM n GROUP BY doc_id, run),
o AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM s),
k AS (SELECT doc_id, count(*) AS spans, sum(b - a) AS removed, max(b) AS upto,
        string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
      FROM o JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed,
  coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(upto, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
