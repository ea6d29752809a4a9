"""SimHash classes, the trie join and components against comparing everything with everything."""

import re
from collections import Counter

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F
from scanweave.llm import simhash_dedup
from scanweave.llm.components import components
from scanweave.llm.simhash_dedup import keep_one, near_duplicates, near_links, simhash, trie_self_join

xxhash = pytest.importorskip("xxhash")


def plain_simhash(text: str, words: int = 4) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    found = re.findall("[^\x20\x09-\x0d]+", lower)
    parts = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or ([" ".join(found)] if found else [])
    values = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def plain_classes(values: list[int], most: int) -> list[int]:
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= most:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(values))]


def same_partition(a, b) -> bool:
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


@pytest.mark.parametrize("text", ["", "  ", "A", "a B c", "A b c d", "É é X y z w", cases.prose(1, 500)])
def test_fingerprint(text):
    assert simhash(text.encode(), 4, at_once=7) == plain_simhash(text)


def clouds(seed: int, n: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (n, 9)).astype(np.uint64)
    return np.unique(np.concatenate([centres, *(centres ^ np.bitwise_xor.reduce(flips[:, :k], axis=1) for k in (1, 3, 4, 5, 9))]))


@pytest.mark.parametrize("leaf", [1, 8, 256])
def test_trie_join(leaf):
    values = clouds(leaf, 40)
    assert same_partition(trie_self_join(values, 4, leaf=leaf).tolist(), plain_classes(values.tolist(), 4))
    assert len(trie_self_join(values[:0], 4)) == 0 and trie_self_join(values[:1], 4).tolist() == [0]


def test_trie_join_of_groups_and_sides():
    values = np.concatenate([clouds(1, 20)] * 2)
    groups = np.repeat([0, 1], len(values) // 2)
    found = trie_self_join(values, 4, groups)
    assert not set(found[groups == 0]) & set(found[groups == 1])
    side = np.zeros(len(values), np.int64)
    assert trie_self_join(values, 4, groups, side).tolist() == list(range(len(values)))


@pytest.mark.parametrize("hot, part", [(4096, 2048), (5, 3)])
def test_links_connect_all_classes(spark, monkeypatch, hot, part):
    monkeypatch.setattr(simhash_dedup, "_HOT", hot)
    monkeypatch.setattr(simhash_dedup, "_PART", part)
    values = clouds(3, 60)
    prints = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fingerprint long")
    links = [(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in near_links(prints, 4).collect()]
    at = {int(v): i for i, v in enumerate(values)}
    # Links lead to the class, not to a pair within the distance; as classes they say the same.
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = find(at[a]), find(at[b])
        root[max(x, y)] = min(x, y)
    assert same_partition([find(i) for i in range(len(values))], plain_classes(values.tolist(), 4))


def test_components(spark):
    rng = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7)]
    found = dict(components(spark.createDataFrame(links, "one long, other long")).collect())
    nodes = sorted({n for link in links if link[0] != link[1] for n in link})
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert found == {n: find(n) for n in nodes}
    assert components(spark.createDataFrame([], "one long, other long")).count() == 0


def near_rows():
    base = cases.prose(11, 400).split(" ")
    near = [(i, " ".join(base[:i] + ["changed"] + base[i + 1 :]), "a") for i in range(1, 12)]
    return cases.odd_rows(near)


def plain_near(rows, most=4):
    values = [plain_simhash(t or "") for _, t, _ in rows]
    root = plain_classes(values, most)
    smallest = {}
    for (doc_id, _, _), r in zip(rows, root):
        if doc_id is not None:
            smallest[r] = min(smallest.get(r, doc_id), doc_id)
    return [(d, f"{v:016x}", smallest.get(r)) for (d, _, _), v, r in zip(rows, values, root)], root


def test_near_duplicates(spark):
    rows = near_rows()
    want, _ = plain_near(rows)
    assert Counter(map(tuple, near_duplicates(cases.table(spark, rows)).collect())) == Counter(want)
    assert near_duplicates(cases.table(spark, [])).count() == 0


def test_one_stays_of_each_class(spark):
    rows = near_rows()
    want, root = plain_near(rows)
    docs = cases.table(spark, rows)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    out = [(r.doc_id, r.text) for r in kept.collect()]
    by_row = {}
    for (d, t, _), r in zip(rows, root):
        by_row[d, t] = r
    assert Counter(by_row[key] for key in out) == Counter(set(root))
    for d, t in out:
        ids = [x for (x, _, _), r in zip(rows, root) if r == by_row[d, t] and x is not None]
        assert d == (min(ids) if ids else None)
    assert keep_one(cases.table(spark, [])).count() == 0
    only = cases.table(spark, [r for r in rows if r[0] not in (None, 102)])
    assert only.where(F.col("doc_id").isNotNull()).count() > keep_one(only).count() > 0


def test_tables_read_once_are_not_written(spark, monkeypatch):
    rows = near_rows()
    root = plain_near(rows)[1]
    written = []

    def recorded(df, purpose, land=simhash_dedup.landed):
        written.append(purpose)
        return land(df, purpose)

    monkeypatch.setattr(simhash_dedup, "landed", recorded)
    # Without and with a row that comes twice.
    single, twice = list(dict.fromkeys(rows)), [*rows, rows[0], rows[0]]
    assert keep_one(cases.table(spark, single)).count() == len(set(plain_near(single)[1]))
    assert keep_one(cases.table(spark, twice)).count() == len(set(root))
    assert set(written) <= {"simhash-prints", "simhash-distinct", "simhash-hot", "simhash-members", "simhash-repeated"}
