"""Suffix arrays and the removal of repeated byte strings against plain versions."""

import hashlib
from collections import Counter

import cases
import numpy as np
import pyarrow as pa
import pytest
from scanweave.llm import suffix_dedup
from scanweave.llm.suffix_arrays import suffix_array
from scanweave.llm.suffix_dedup import find_contexts, first_holders, merged_spans, remove_repeats


def plain_removal(rows):
    """What the contract says, string by string."""
    smallest = {}
    top = float("inf")
    for doc_id, text, _ in rows:
        body = (text or "").encode()
        for i in range(len(body) - 49):
            gram = body[i : i + 50]
            smallest[gram] = min(smallest.get(gram, top), top if doc_id is None else doc_id)
    out = []
    for doc_id, text, _ in rows:
        body = (text or "").encode()
        gone = bytearray(len(body))
        for i in range(len(body) - 49):
            if smallest[body[i : i + 50]] < (top if doc_id is None else doc_id):
                gone[i : i + 50] = b"\1" * 50
        runs = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, x in zip(body, gone) if not x)
        out.append((doc_id, len(body), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept))
    return Counter(out)


@pytest.mark.parametrize("seed", range(12))
def test_suffix_array(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, 2 + seed % 3, 40 * seed).astype(np.uint8)
    if seed % 2:
        text = np.tile(text[:9], 20)
    if seed % 4 == 2:
        text = (text + 254).astype(np.uint8)
    body = text.tobytes()
    assert suffix_array(text).tolist() == sorted(range(len(body)), key=lambda i: body[i:])


def test_contexts_list_every_string_once():
    texts = [cases.prose(i, 40 + i).encode() for i in range(6)] + [b"short", b"", b"x" * 50, b"ab" * 100]
    text, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    whole = find_contexts(text, ends)
    for block in (64, 100, 1 << 21):
        found = find_contexts(text, ends, block)
        places = sorted(p for f, c in zip(found.first, found.count) for p in range(f, f + c))
        starts = np.concatenate([[0], ends[:-1]])
        assert places == [p for s, e in zip(starts, ends) for p in range(s, max(s, e - 49))]
        key = {p: k for k, f, c in zip(found.key, found.first, found.count) for p in range(f, f + c)}
        assert key == {p: k for k, f, c in zip(whole.key, whole.first, whole.count) for p in range(f, f + c)}


def test_equal_strings_have_equal_anchors():
    common = cases.prose(3, 12).encode()[:50]
    texts = [b"left one " + common + b" right", b"other " * 9 + common + b"!", common]
    text, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    found = find_contexts(text, ends)
    key = {p: k for k, f, c in zip(found.key, found.first, found.count) for p in range(f, f + c)}
    begins = [t.index(common) + s for t, s in zip(texts, [0, *ends[:-1]])]
    assert len({key[b] for b in begins}) == 1


def test_first_holders():
    common = b"0123456789" * 5
    stretches = [b"aa" + common + b"xyz", common + b"q", b"c" * 60]
    text = np.frombuffer(b"".join(stretches), np.uint8)
    sizes = np.array([len(s) for s in stretches])
    begins, counts = np.cumsum(sizes) - sizes, sizes - 49
    least = first_holders(text, begins, counts, np.array([5, 3, 9]))
    assert least[2] == 3 and least[begins[1]] == 3 and least[0] == 5 and least[begins[2]] == 9


def test_merged_spans():
    low, high = merged_spans(np.array([5, 0, 3, 20, 20]), np.array([7, 4, 5, 21, 25]))
    assert (low.tolist(), high.tolist()) == ([0, 20], [7, 25])
    assert [x.tolist() for x in merged_spans(np.zeros(0, np.int64), np.zeros(0, np.int64))] == [[], []]


PASSAGE = cases.prose(21, 30)


def repeated_rows():
    extra = [(i, cases.prose(50 + i, 20) + PASSAGE + cases.prose(80 + i, 20), "a") for i in range(8)]
    extra += [(20, "x" * 200, "a"), (21, "x" * 60, "b"), (22, "ab" * 70, "b"), (23, "b" + "ab" * 30, "a")]
    extra += [(30 + i, PASSAGE[i : i + 50 + i % 3], "a") for i in range(6)]
    extra += [(40, PASSAGE[:49], "a"), (41, PASSAGE[10:59], "a")]
    return cases.odd_rows(extra)


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"shard_bytes": 2000, "bucket_bytes": 20_000},
        {"shard_bytes": 500, "bucket_bytes": 50_000, "most_contexts": 2},
        {"shard_bytes": 5000, "bucket_bytes": 50_000, "fan_in": 4},
    ],
)
def test_removal(spark, options):
    rows = repeated_rows()
    out = remove_repeats(cases.table(spark, rows, 4), **options)
    assert Counter((*r[:5], bytes(r[5])) for r in out.collect()) == plain_removal(rows)


def test_removal_from_nothing(spark):
    assert remove_repeats(cases.table(spark, [])).count() == 0
    rows = [(1, None, "a"), (None, "", "b")]
    out = remove_repeats(cases.table(spark, rows)).collect()
    assert Counter((*r[:5], bytes(r[5])) for r in out) == plain_removal(rows)


def test_a_shard_answers_all_buckets_in_few_batches():
    """Cells of shards and buckets grow with the product of both, so none of them is a batch of its own."""
    bodies = [cases.prose(i, 200).encode() for i in range(30)]
    row = {"shard": [7], "ids": [list(range(30))], "sizes": [[len(b) for b in bodies]]}
    row["body"] = [pa.compress(b"".join(bodies), "zstd", asbytes=True)]
    shard = pa.RecordBatch.from_pydict(row)
    found = list(suffix_dedup._anchor_lists(400)[0](iter([shard])))
    assert len(found) == 1 and found[0].num_rows > 300 and found[0].column("shard").unique().to_pylist() == [7]
    lists = pa.array([found[0].column("anchors").to_pylist()], pa.list_(pa.binary()))
    sent = list(suffix_dedup._send_contexts(400)[0](iter([pa.RecordBatch.from_arrays([*shard.columns, lists], [*row, "lists"])])))
    assert len(sent) <= 3 and sum(b.num_rows for b in sent) > 300


def test_larger_inputs_have_larger_shards_and_buckets(spark, monkeypatch):
    rows = repeated_rows()
    monkeypatch.setattr(suffix_dedup, "_GROWING", 1000)
    sizes, shards = [], suffix_dedup.shards
    monkeypatch.setattr(suffix_dedup, "shards", lambda *given: sizes.append(given[-1]) or shards(*given))
    out = remove_repeats(cases.table(spark, rows, 4), shard_bytes=500, bucket_bytes=2000)
    assert Counter((*r[:5], bytes(r[5])) for r in out.collect()) == plain_removal(rows)
    assert sizes[0] > 500
