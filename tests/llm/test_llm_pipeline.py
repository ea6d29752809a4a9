"""The pipeline stage by stage, each against the plain version of its operator on its own input."""

import re
import sys
from collections import Counter
from pathlib import Path

import cases
import pytest
from pyspark.sql import functions as F
from scanweave.llm import line_crf, surrogates
from scanweave.llm.tables import landed, read_table
from test_llm_leaks_and_privacy import plain_leaks
from test_llm_near_duplicates import plain_classes, plain_simhash
from test_llm_tokens import check_packing

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
NAMES = ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]


@pytest.fixture(scope="module")
def steps(spark):
    docs = read_table(spark, FOLDER, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(landed(stage(spark, out[-1], FOLDER), f"test-{name}"))
    return out


def rows(df):
    return [(r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect()]


def test_stages(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    assert all(step.columns == steps[0].columns and step.dtypes == steps[0].dtypes for step in steps[:-1])


def test_quality_keeps_what_the_model_accepts(spark, steps):
    docs = steps[0]
    model = line_crf.fit(docs, read_table(spark, FOLDER, "labels"))
    texts = rows(docs)
    scores = line_crf.document_scores([(t or "").encode() for _, t, _ in texts], model)
    assert Counter(rows(steps[1])) == Counter(row for row, score in zip(texts, scores) if score >= 0.3)
    good = {r.doc_id for r in read_table(spark, FOLDER, "labels").where("quality = 1").collect()}
    before, after = {d for d, *_ in texts}, {d for d, *_ in rows(steps[1])}
    assert len(good & after) >= 0.98 * len(good & before)


def test_one_document_of_each_class_is_left(steps):
    texts = rows(steps[1])
    classes = plain_classes([plain_simhash(t or "") for _, t, _ in texts], 4)
    smallest = {}
    for (doc_id, *_), c in zip(texts, classes):
        smallest[c] = min(smallest.get(c, doc_id), doc_id)
    assert sorted(d for d, *_ in rows(steps[2])) == sorted(smallest.values())


def test_no_leak_is_left_and_no_clean_document_lost(spark, steps):
    items = [tuple(r) for r in read_table(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
    clean = {doc_id for (doc_id, found) in plain_leaks(rows(steps[2]), items) if not found}
    assert {d for d, *_ in rows(steps[3])} == clean


def test_personal_data_is_replaced(steps):
    before, after = ({r.doc_id: r for r in step.collect()} for step in (steps[3], steps[4]))
    assert before.keys() == after.keys()
    pattern = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|\+1 \(\d{3}\) 555-\d{4}|(?<![\d.])\d{16}(?!\d)|(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d)")
    changed = 0
    for doc_id, old in before.items():
        new = after[doc_id]
        found = set(pattern.findall(old.text))
        changed += bool(found)
        assert not any(entity in new.text for entity in found)
        assert pattern.sub("#", new.text) == pattern.sub("#", old.text)
        assert (new.lang, new.source, new.n_chars) == (old.lang, old.source, len(new.text))
    assert changed
    assert surrogates.TYPES[0] == "email"


def test_everything_left_is_packed(steps):
    check_packing(steps[5].collect(), rows(steps[4]))


def test_run_gives_the_last_stage(spark, steps):
    assert Counter(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == Counter(map(tuple, steps[-1].collect()))


@pytest.mark.parametrize("given", [cases.odd_rows(), []], ids=["odd rows", "no rows"])
def test_stages_take_odd_tables(spark, given):
    docs = cases.table(spark, given).withColumn("n_chars", F.length("text").cast("long"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = landed(stage(spark, docs, FOLDER), f"odd-{name}")
        if name != "packing":
            assert docs.columns == columns
    assert (docs.count() > 0) == bool(given)
