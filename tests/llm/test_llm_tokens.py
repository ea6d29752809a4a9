"""Token counts and packing against the tokenizer library on whole texts."""

import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest
from scanweave.llm import packing, token_counts
from scanweave.llm.tokens import IdEncoder, PieceLengths, by_bytes

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
BYTES, WORDS = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "", " ", "\n", "a", "\na", "a\n", "\n\na b", "  a  b", "a  b\tc\n\n d", "a \nb", "<|endoftext|> y<|endoftext|>",
    "it's don't  we'll", "é ́x", "a b  c", "\x1c a \x1c", "日本 語,x. y.", "1.5 2, foo. Bar,\r\nq",
    "a' b's c'd e'll' x*** y%%%\nz!!.", "ƛɏ, ×a ÷b", "a​b c", "x" * 5000 + " y", "é" * 300, "<|ENDOFTEXT|>",
    "H̱ ẖ İ ς Σ", "͸ Ᲊx", "<|startoftext|>a <|endoftext|>",
]


def library(path):
    return tokenizers.Tokenizer.from_file(path)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_as_the_library(text):
    ids = library(BYTES).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(IdEncoder(BYTES).encode(text), "<u2").tolist() == ids
    assert PieceLengths(WORDS).totals([text.encode()]).tolist() == [len(library(WORDS).encode(text, add_special_tokens=False).ids)]


def test_small_memory_gives_the_same_counts():
    texts = [cases.prose(i, 200) for i in range(30)]
    counter = PieceLengths(WORDS, most=20)
    want = [len(e.ids) for e in library(WORDS).encode_batch(texts, add_special_tokens=False)]
    assert [int(counter.totals([t.encode()])[0]) for t in texts] == want


def test_parts_join_to_the_text():
    text = cases.prose(5, 3000).encode()
    parts = token_counts.safe_parts(text, 500)
    assert b"".join(parts) == text and len(parts) > 10
    assert token_counts.safe_parts(b"x" * 2000, 500) == [b"x" * 2000]
    assert list(by_bytes([5, 5, 20, 1], 10)) == [(0, 2), (2, 3), (3, 4)] and list(by_bytes([], 10)) == []


def test_counts(spark):
    rows = cases.odd_rows([(i, text, "c") for i, text in enumerate(ODD)])
    out = token_counts.count_tokens(cases.table(spark, rows), WORDS, limit=100, batch_bytes=1000).collect()
    tokenizer = library(WORDS)

    def want(doc_id, text):
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        return doc_id, len((text or "").encode()), n, n > 100

    assert Counter(map(tuple, out)) == Counter(want(d, t) for d, t, _ in rows)
    assert token_counts.count_tokens(cases.table(spark, []), WORDS).count() == 0


def check_packing(pieces, rows, size=1024):
    tokenizer = library(BYTES)
    want = Counter((d, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])) for d, t, _ in rows)
    by_length = defaultdict(list)
    for (doc_id, ids), n in want.items():
        by_length[doc_id, len(ids)] += [ids] * n
    sequences = defaultdict(list)
    covered = defaultdict(list)
    for p in pieces:
        candidates = by_length[p.doc_id, p.doc_tokens]
        crc = [zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes()) for ids in candidates]
        assert p.ids_crc32 in crc
        sequences[p.sequence_id].append((p.offset, p.length))
        covered[p.doc_id, p.doc_tokens].append((p.start, p.length))
    for key, texts in by_length.items():
        assert sum(n for _, n in covered[key]) == len(texts) * key[1]
        assert Counter(s for s, _ in covered[key])[0] == len(texts)
    total = sum(p.length for p in pieces)
    assert total == sum(key[1] * len(texts) for key, texts in by_length.items())
    lengths = []
    for number in range(len(sequences)):
        at = 0
        for offset, length in sorted(sequences[number]):
            assert offset == at
            at += length
        lengths.append(at)
    assert all(n == size for n in lengths[: total // size])
    assert all(n & (n - 1) == 0 for n in lengths[total // size :])


def test_packing(spark):
    rows = cases.odd_rows([(i, text, "c") for i, text in enumerate(ODD)])
    check_packing(packing.pack(cases.table(spark, rows), BYTES).collect(), rows)


def test_packing_of_one_and_of_nothing(spark):
    assert packing.pack(cases.table(spark, []), BYTES).count() == 0
    rows = [(1, None, None)]
    check_packing(packing.pack(cases.table(spark, rows), BYTES).collect(), rows)


def test_ids_come_along(spark):
    rows = [(1, cases.prose(1, 900), "a"), (2, cases.prose(2, 50), "b")]
    out = packing.pack(cases.table(spark, rows), BYTES, with_ids=True).collect()
    for p in out:
        assert zlib.crc32(np.frombuffer(p.ids, "<u2").astype("<u4").tobytes()) == p.ids_crc32


@pytest.mark.parametrize("start, end, total", [(0, 10, 10), (0, 1024, 1024), (1000, 3000, 3000), (2048, 2049, 2049), (2050, 2051, 2051)])
def test_cuts_are_gapless(start, end, total):
    found = packing.cuts(start, end, total, 1024)
    assert [a for a, *_ in found] == [start, *[b for _, b, *_ in found[:-1]]] and found[-1][1] == end


def test_windows_keep_the_mixture(spark):
    """After every window each source has had its share, but for less than one document."""
    rows = [(i, cases.prose(i, 60), "a" if i % 4 else "b") for i in range(400)]
    pieces = packing.pack(cases.table(spark, rows), BYTES, window_tokens=4096).collect()
    source = {d: s for d, _, s in rows}
    longest = max(p.doc_tokens for p in pieces)
    totals = Counter()
    for p in pieces:
        totals[source[p.doc_id]] += p.length
    stream = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    share = {s: n / sum(totals.values()) for s, n in totals.items()}
    served, place = Counter(), 0
    for p in stream:
        served[source[p.doc_id]] += p.length
        place += p.length
        if place % 4096 < p.length:
            assert all(abs(served[s] - share[s] * place) <= 4096 * share[s] + 2 * longest for s in share)


def test_given_proportions(spark):
    rows = [(i, cases.prose(i, 60), "ab"[i % 2]) for i in range(200)]
    pieces = packing.pack(cases.table(spark, rows), BYTES, window_tokens=2048, proportions={"a": 3.0, "b": 1.0}).collect()
    first = [p for p in pieces if p.sequence_id < 4]
    tokens = Counter()
    for p in first:
        tokens["ab"[p.doc_id % 2]] += p.length
    assert 2 < tokens["a"] / tokens["b"] < 4.5
    check_packing(pieces, rows)
