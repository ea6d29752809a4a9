"""Benchmark decontamination and surrogates against plain versions."""

import random
import re
from collections import Counter, defaultdict

import cases
import pytest
from pyspark.sql import functions as F
from scanweave.llm import decontaminate, surrogates
from scanweave.llm.decontaminate import contaminated


def plain_leaks(rows, items, similarity=0.8):
    def grams(text):
        words = re.findall(r"[^\W_]+", (text or "").lower())
        return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]

    out = []
    for doc_id, text, _ in rows:
        mine, found = grams(text), []
        for item_id, body in items:
            theirs = Counter(grams(body))
            n = sum(theirs.values())
            best = 0
            for start in range(len(mine) - n + 1 if n else 0):
                shared = sum((Counter(mine[start : start + n]) & theirs).values())
                best = max(best, shared / (2 * n - shared))
            if best >= similarity - 1e-9:
                found.append((item_id, round(best, 9)))
        out.append((doc_id, tuple(sorted(found))))
    return Counter(out)


ITEMS = [(i, cases.prose(200 + i, 15 + 4 * i).replace("\n", " ")) for i in range(8)]


def leak_rows():
    quoted = ITEMS[5][1]
    words = quoted.split(" ")
    changed = " ".join(words[:16] + ["other"] + words[17:])
    extra = [
        (1, f"{cases.prose(1, 40)} {ITEMS[0][1]} {cases.prose(2, 40)}", "a"),
        (2, quoted.replace("k", "K").replace("o", "O"), "a"),
        (3, f"start {changed} end", "a"),
        (4, " ".join(words[: len(words) // 2]), "a"),
        (5, ITEMS[2][1] + " " + ITEMS[3][1], "a"),
        (6, f"start {' '.join(words[:30] + ['one', 'two'] + words[30:])} end", "a"),
    ]
    return cases.odd_rows(extra)


def test_leaks(spark):
    rows = leak_rows()
    items = [*ITEMS, (50, None), (51, ""), (52, "too short"), (53, ITEMS[4][1]), (54, "same " * 9)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = cases.table(spark, rows)
    out = contaminated(docs, benchmark).collect()
    got = Counter((r.row.doc_id, tuple(sorted((x.item_id, round(x.similarity, 9)) for x in r.leaks))) for r in out)
    assert got == plain_leaks(rows, items)
    assert {r.row.doc_id for r in out if r.leaks} >= {1, 2, 5}
    assert out[0].row.asDict().keys() == set(docs.columns)


def test_leaks_of_texts_shorter_than_the_item_and_of_short_items(spark):
    words = re.findall(r"\w+", ITEMS[7][1])
    n = len(words) - 4
    texts = [words[:-1], words[1:-2], words[: len(words) // 2], ["so"] * 60 + "Yes, it was".split(), ["it", "was", "yes"]]
    rows = [(i, " ".join(text), "a") for i, text in enumerate(texts)]
    benchmark = spark.createDataFrame([(7, " ".join(words)), (60, "yes it was")], "item_id long, text string")
    out = contaminated(cases.table(spark, rows), benchmark).collect()
    got = {r.row.doc_id: [(x.item_id, x.start, x.n_words, round(x.similarity, 9)) for x in r.leaks] for r in out}
    assert got == {
        0: [(7, 0, len(words) - 1, round((n - 1) / n, 9))],
        1: [(7, 0, len(words) - 3, round((n - 3) / n, 9))],
        2: [],
        3: [(60, 60, 3, 1.0)],
        4: [],
    }


@pytest.mark.parametrize("refrain, length", [(14, 132), (24, 224), (4, 40)])
def test_refrains_that_differ(spark, refrain, length):
    """Item and text differ in one shingle that both repeat; fingerprints of plain counts lie far apart there."""
    items, rows = [], []
    for i in range(60):
        base = " ".join(f"w{i}x{k}" for k in range(length - refrain))
        items.append((i, base + f" la{i}" * refrain))
        rows.append((i, f"{cases.prose(i, 30)} {base}" + f" li{i}" * refrain, "a"))
    want = plain_leaks(rows, items)
    assert all(found for _, found in want)
    out = contaminated(cases.table(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert Counter((r.row.doc_id, tuple((x.item_id, round(x.similarity, 9)) for x in r.leaks)) for r in out) == want


def test_weighted_features(spark):
    rows = [([5, 7, 5, 5, 9, 7],), ([3, 1, 2],), ([],), ([4, 4],)]
    out = spark.createDataFrame(rows, "h array<long>").select("h", decontaminate.weighted_features(F.col("h")).alias("f")).collect()
    for h, f in out:
        assert len(f) == len(set(f)) == len(h) and set(h) <= set(f)
    assert {r.f[-1] for r in out if r.h == [4, 4]} <= {x for r in out for x in r.f}


def test_windows_without_a_rare_shingle_are_not_similar(spark):
    """Of any multiset at the least similarity, one member at least is a rare shingle of the item."""
    rng = random.Random(2)
    items = [(i, [rng.choice(range(12)) for _ in range(rng.randint(1, 20))]) for i in range(60)]
    frame = spark.createDataFrame([(i, len(h), h) for i, h in items], "item_id int, n int, hashes array<long>")
    rare = defaultdict(set)
    for row in decontaminate.rare_shingles(frame, 0.8).collect():
        rare[row.item_id].add(row.hash)
    for i, hashes in items:
        for _ in range(200):
            other = list(hashes)
            for _ in range(rng.randint(0, 4)):
                other[rng.randrange(len(other))] = rng.choice(range(14))
            shared = sum((Counter(other) & Counter(hashes)).values())
            if shared / (2 * len(hashes) - shared) >= 0.8 - 1e-9:
                assert rare[i] & set(other)


def test_few_items_are_tried(spark):
    """Of very many items of one size with a common opening, a window is compared with those it shares rare words with."""
    opening = " ".join(f"common{k}" for k in range(20))
    bodies = [f"{opening} {' '.join(f'own{i}x{k}' for k in range(40))}" for i in range(400)]
    benchmark = spark.createDataFrame(list(enumerate(bodies)), "item_id int, text string")
    items = decontaminate.item_shingles(benchmark)
    windows = items.select(F.lit("t").alias("text_key"), "n", F.col("item_id").alias("start"), "hashes", "fingerprint")
    rare = decontaminate.rare_shingles(items, 0.8)
    pairs = windows.select("start", F.explode("hashes").alias("hash"), "n").join(rare, ["n", "hash"]).select("start", "item_id").distinct()
    assert pairs.count() == 400
    near = decontaminate._near_items(windows, items, 0.8, 23).collect()
    assert {(r.start, r.item_id) for r in near} == {(i, i) for i in range(400)}


def test_no_leaks_without_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = cases.table(spark, cases.odd_rows())
    assert contaminated(docs, none).where(F.size("leaks") > 0).count() == 0
    some = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert contaminated(cases.table(spark, []), some).count() == 0


PRIVATE = [
    "mail Ana.Ruiz+x@Mail5.example.com or ana.ruiz+x@mail5.example.com, bob_7@firm.co.uk.",
    "call +1 (743) 555-3824, +1-743-555-3824 or +1 743 555 3824; (212) 867-5309.",
    "card 4785380592391139 and 4539 5787 6362 1486, hosts 152.143.123.131, 10.2.33.4, 192.168.7.8 and 999.1.1.1",
    "Mrs. Anna Schmidt met Mr Schmidt; MRS. X; Frau Müller, Herr Karl Weiß. Госпожа Анна Петрова",
    "id 123-45-6789, year 2024, 1.5 million, 12345678, a@b, @home",
    "éa.50@mail1.example.org",
]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def replaced(spark, rows, key="k1"):
    return surrogates.replace_personal_data(cases.table(spark, rows), key)


@pytest.fixture(scope="module")
def done(spark):
    rows = cases.odd_rows([(i, text, "p") for i, text in enumerate([*PRIVATE, *PRIVATE])])
    return rows, replaced(spark, rows).collect()


def test_only_entities_change(done):
    rows, out = done
    new = {(r.row.doc_id, r.row.text) for r in out}
    old = {d: t for d, t, _ in rows if d is not None}
    assert len(out) == len(rows)
    for r in out:
        if r.row.doc_id is None or r.row.doc_id >= 100:
            assert not r.mentions
            continue
        text = r.row.text
        for m in r.mentions:
            assert m.match not in text and m.replacement in text
        back = text
        for m in r.mentions:
            back = back.replace(m.replacement, m.match)
        assert back == old[r.row.doc_id]
    assert {(d, t) for d, t, _ in rows if d is None or d >= 100} <= new


def test_kinds_and_forms(done):
    _, out = done
    mentions = {(m.kind, m.match): m.replacement for r in out for m in r.mentions}
    kinds = Counter(kind for kind, _ in mentions)
    assert kinds == {"email": 4, "phone": 4, "card": 2, "ip": 3, "name": 5, "ssn": 1}
    shape = lambda s: re.sub(r"[0-9]", "0", s)
    for (kind, match), new in mentions.items():
        assert new != match
        if kind in ("phone", "card", "ssn", "ip"):
            assert shape(new) == shape(match)
        if kind == "card":
            assert luhn(re.sub(r"\D", "", match)) == luhn(re.sub(r"\D", "", new)) and new[0] == match[0]
        if kind == "email":
            assert len(new) == len(match) and new.count("@") == 1
    digits = lambda s: re.sub(r"\D", "", s)
    us = {digits(mentions["phone", p]) for p in ("+1 (743) 555-3824", "+1-743-555-3824", "+1 743 555 3824")}
    assert len(us) == 1 and us.pop()[4:7] == "555"
    assert mentions["email", "Ana.Ruiz+x@Mail5.example.com"].lower() == mentions["email", "ana.ruiz+x@mail5.example.com"]
    assert mentions["ip", "10.2.33.4"].startswith("10.") and mentions["ip", "192.168.7.8"].startswith("192.168.")
    assert mentions["name", "Anna Schmidt"].split()[0] in surrogates.GIVEN["f", "latin"]
    assert mentions["name", "Karl Weiß"].split()[0] in surrogates.GIVEN["m", "latin"]
    assert mentions["name", "Анна Петрова"].split()[0] in surrogates.GIVEN["f", "cyrillic"]
    assert mentions["name", "Anna Schmidt"].split()[1] == mentions["name", "Schmidt"]


FORMS = {
    "call +33 1 23 45 67 89 or": ["+33 1 23 45 67 89"],
    "call +61 2 9876 5432, now": ["+61 2 9876 5432"],
    "Tel. 030 1234567.": ["030 1234567"],
    "Tel. 0171/1234567 and 0049 30 1234567": ["0171/1234567", "0049 30 1234567"],
    "ring 020 7946 0958; 01 23 45 67 89": ["020 7946 0958", "01 23 45 67 89"],
    "log +1 (843) 555-7672 170.106.47.218 end": ["+1 (843) 555-7672", "170.106.47.218"],
    "dial 555 123 4567 x": ["555 123 4567"],
    "Mr O'Brien said": ["O'Brien"],
    "Dr Smith, Prof. Jones": ["Smith", "Jones"],
    "Monsieur Jean-Luc Picard est": ["Jean-Luc Picard"],
    "Mrs McDonald's house": ["McDonald"],
    "Herr Hans Peter Müller kam": ["Hans Peter Müller"],
    "Herr Prof. Dr. Weber kam": ["Weber"],
    "Frau Anna von der Leyen sprach": ["Anna von der Leyen"],
    "Mr J. R. Ewing left": ["J. R. Ewing"],
    "Mr Drake left": ["Drake"],
    "Mrs. Anna Schmidt met him. Schmidt, and Anna Schmidt; Schmidtke": ["Anna Schmidt", "Schmidt", "Anna Schmidt"],
    "from 01.02.2024 12:30 to 31.12.1999, 0.25 2024, 1 000 000, 2024-01-02 10": [],
    "0123 4567 8901 2345": ["0123 4567 8901 2345"],
    "odd \uffff mark, Mr Smith and Smith \uffff": ["Smith"],
}


def test_forms_found(spark):
    """Each form by itself: what is found, and that nothing else of the text changes."""
    texts = list(FORMS)
    out = replaced(spark, [(i, text, "p") for i, text in enumerate(texts)]).collect()
    assert {r.row.doc_id: [m.match for m in r.mentions] for r in out} == {i: FORMS[t] for i, t in enumerate(texts)}
    for r in out:
        text, rest = texts[r.row.doc_id], r.row.text
        for m in r.mentions:
            before, _, text = text.partition(m.match)
            assert rest.startswith(before + m.replacement) and m.replacement != m.match
            rest = rest.removeprefix(before + m.replacement)
        assert rest == text
    new = {m.match: m.replacement for r in out for m in r.mentions}
    assert new["+33 1 23 45 67 89"].startswith("+33 ") and new["030 1234567"].startswith("0")
    assert new["O'Brien"][1] == "'" and new["O'Brien"][2].isupper()
    assert new["Anna Schmidt"].split()[1] == new["Schmidt"]
    assert new["Weber"].isalpha() and new["Jean-Luc Picard"].split()[0] in surrogates.GIVEN["m", "latin"]


def test_whole_result_by_plain_python(spark):
    """Texts rebuilt from the entities' replacements alone, found by the same patterns in Python's regex."""
    import regex

    pattern = regex.compile(surrogates.ENTITY)
    texts = [*PRIVATE, *FORMS, "Dr. Anna Weiß (a@b.org) rief an. Weiß: 10.1.2.3", cases.prose(5, 400)]
    out = {r.row.doc_id: r for r in replaced(spark, [(i, t, "p") for i, t in enumerate(texts)]).collect()}
    known = {(m.kind, m.match): m.replacement for r in out.values() for m in r.mentions if m.kind != "name"}
    for i, text in enumerate(texts):
        own = {m.match: m.replacement for m in out[i].mentions if m.kind == "name"}
        forms = sorted(own, key=len, reverse=True)
        bare = regex.compile(r"(?<![\p{L}\p{M}\p{N}])(?:" + "|".join(map(regex.escape, forms or ["\ufffe"])) + r")(?![\p{L}\p{M}\p{N}]|['’-]\p{Lu})")
        parts, end = [], 0
        for found in pattern.finditer(text):
            gap = text[end : found.start()]
            parts.append(gap if "\uffff" in gap else bare.sub(lambda m: own[m[0]], gap))
            parts.append(own.get(found[0]) or next(new for (_, match), new in known.items() if match == found[0]))
            end = found.end()
        gap = text[end:]
        parts.append(gap if "\uffff" in gap else bare.sub(lambda m: own[m[0]], gap))
        assert out[i].row.text == "".join(parts)


def test_long_text_with_many_entities(spark):
    lines = [f"Mr Na{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}m wrote u{i}@host.example; call +33 1 23 45 {i % 90 + 10} 89." for i in range(4000)]
    body = "\n".join(lines) + "\n" + cases.prose(3, 60_000) + "0" * 200_000
    (out,) = replaced(spark, [(1, body, "p")]).collect()
    assert len(out.mentions) == 12_000
    back = out.row.text
    assert back.count("\n") == body.count("\n") and "u17@host.example" not in back


def test_same_key_same_replacement(spark, done):
    rows, out = done
    again = replaced(spark, rows).collect()
    assert Counter(r.row.text for r in out) == Counter(r.row.text for r in again)
    other = replaced(spark, rows, "k2").collect()
    assert Counter(r.row.text for r in out) != Counter(r.row.text for r in other)


def test_different_entities_stay_different(spark):
    """So many short addresses that keyed replacements must meet."""
    values = [(f"{a}.{b}.{c}.{d}",) for a in (1, 2) for b in range(1, 10) for c in range(1, 10) for d in range(1, 10)]
    entities = spark.createDataFrame(values, "value string").withColumn("kind", F.lit("ip"))
    tried = entities.select(surrogates.surrogate(F.col("kind"), F.col("value"), F.lit(0), "k").alias("s"))
    assert tried.distinct().count() < len(values)
    out = surrogates.assign_surrogates(entities, "k").collect()
    assert len({r.surrogate for r in out}) == len(out) == len(values)
    assert not {r.surrogate for r in out} & {v for v, in values}


def test_nothing_to_replace(spark):
    assert replaced(spark, []).count() == 0
    rows = [(1, None, "a"), (2, "", "a"), (3, "no data", None)]
    assert {(r.row.doc_id, r.row.text) for r in replaced(spark, rows).collect()} == {(d, t) for d, t, _ in rows}


def test_entities_without_free_replacements_settle(spark):
    """Other scripts, no letter at all, and forms with fewer replacements than entities."""
    emails = ["用户@例子.中国", "用户@example.com", "-@example.com", "a@example.com", "e@example.com", "i@example.com"]
    emails += [f"{c}@example.org" for c in "aeiou"]
    hosts = [f"192.168.{c}.{d}" for c in range(10) for d in range(10)]
    rows = [(i, f"from {x} on", "p") for i, x in enumerate(emails + hosts)]
    out = replaced(spark, rows).collect()
    new = {m.match: m.replacement for r in out for m in r.mentions}
    assert new.keys() == {*emails, *hosts}
    assert len(set(new.values())) == len(new) and not new.keys() & set(new.values())
    assert all(new[e].count("@") == 1 for e in emails)
    assert all(new[h].startswith("192.168.") for h in hosts)


def test_every_kind_widens(spark):
    values = {"email": "-@example.com", "ip": "192.168.1.1", "phone": "12345", "card": "4111111111111", "ssn": "123456789", "name": "m|li"}
    rows = [(kind, value, n) for kind, value in values.items() for n in (0, 19)]
    table = spark.createDataFrame(rows, "kind string, value string, n int")
    out = table.select("kind", "n", surrogates.surrogate(F.col("kind"), F.col("value"), F.col("n"), "k").alias("s")).collect()
    size = {(r.kind, r.n): len(r.s) for r in out}
    for kind in ("email", "ip", "phone", "ssn", "name"):
        assert size[kind, 19] > size[kind, 0]
    assert size["card", 19] == size["card", 0] == 13
