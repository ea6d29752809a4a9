"""The interval join on blocks of rows."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from scanweave.constants import DATE_PARTS
from scanweave.operators.interval_join import hot_keys, interval_join
from scanweave.schemas import BRONZE
from scanweave.sources import loads
from scanweave.sources.messages import text_messages
from scanweave.sources.tables import read_declared
from scanweave.streaming.monitor import await_all, rows_in_state
from scanweave.streaming.sinks import ONCE, deal_pairs
from scanweave.streaming.tracking import TrackingSettings, start_landed_match, start_shared_ingest, start_tracking
from test_matching import AFTER, BEFORE, START, brute_force, pairs, rows
from test_streams import arrive, bag, found, pax


def sides(spark, many):
    left, right = (rows(many, seed=5), rows(many // 2, seed=6))
    left += [("crowd", many + n, START + timedelta(seconds=n)) for n in range(1500)] + [(None, 1, START), ("crowd", 2, None)]
    right += [("crowd", many + n, START + timedelta(hours=2, seconds=n)) for n in range(700)]
    frames = [
        spark.createDataFrame(side, f"key string, {name}_id long, {name}_time timestamp")
        for side, name in ((left, "left"), (right, "right"))
    ]
    return left, right, frames


@pytest.mark.parametrize("dealt", [False, True], ids=["plain", "hot key dealt"])
def test_joined_blocks_equal_brute_force(spark, dealt):
    left, right, frames = sides(spark, 300)
    known = ([row for row in left if None not in row], right)
    options = {"hot": hot_keys(frames[0], ["key"], 0.1), "spread": 3, "spread_right": 2} if dealt else {}
    options["deal"] = deal_pairs("left_time", 2)
    result = interval_join(*frames, ["key"], "left_time", "right_time", BEFORE, AFTER, blocks=True, **options)
    assert pairs(result) == brute_force(*known)
    assert result.where((F.dayofmonth("left_time") != F.col("day")) | F.col("day").isNull()).count() == 0


def crowd(folder):
    at = datetime(2026, 5, 20, 12)
    bags = [bag(f"b{n}", "CROWD1", f"{at + timedelta(seconds=n):%H:%M:%S}") for n in range(600)]
    boardings = [pax(f"p{n}", "CROWD1", f"{at + timedelta(seconds=n):%H:%M:%S}") for n in range(300)]
    arrive(folder, 0, (bags, boardings))
    return Counter((f"b{n}", f"p{m}") for n in range(600) for m in range(300))


def test_a_crowded_key_is_in_state_as_blocks(spark, tmp_path):
    expected = crowd(tmp_path)
    settings = TrackingSettings(str(tmp_path / "lake"), str(tmp_path / "checkpoints"), ONCE, state_partitions=2)
    sources = [text_messages(spark, str(tmp_path / side)) for side in ("bag", "pax")]
    queries = start_tracking(*sources, settings)
    await_all(queries.values())
    assert Counter(found(spark, settings)) == expected
    joined = [n for step, n in rows_in_state(queries["valid"]).items() if "join" in step.lower()]
    assert 0 < sum(joined) < 60  # of 600 scans, and 300 boardings in two cells each


def test_pairs_of_a_learnt_hot_key_are_dealt_before_they_are_expanded(spark, tmp_path):
    expected = crowd(tmp_path)
    settings = TrackingSettings(
        str(tmp_path / "lake"), str(tmp_path / "checkpoints"), ONCE, state_partitions=2, learn_share=0.1, spread=4, files_per_day=2
    )
    sources = [text_messages(spark, str(tmp_path / side)) for side in ("bag", "pax")]
    await_all(start_shared_ingest(*sources, settings).values())
    query = start_landed_match(spark, settings)
    await_all([query])
    assert Counter(found(spark, settings)) == expected
    steps = query._jsq.explainInternal(False).splitlines()
    expanded = next(n for n, line in enumerate(steps) if "Generate" in line)
    assert expanded < next(n for n, line in enumerate(steps) if "Exchange" in line)
    assert len(list((tmp_path / "lake" / "valid_data").rglob("*.parquet"))) <= 2


def test_large_files_are_loaded_without_a_shuffle(spark, tmp_path, monkeypatch):
    names = [field.name for field in BRONZE if field.name not in DATE_PARTS]
    matched = spark.range(40).select(
        *(F.lit(START).alias(name) if name.endswith("_time") else F.col("id").cast("string").alias(name) for name in names),
        *(F.lit(value).alias(name) for name, value in zip(DATE_PARTS, (2026, 5, 20))),
    )
    for _ in range(2):
        matched.coalesce(1).write.mode("append").partitionBy(*DATE_PARTS).parquet(str(tmp_path / "landed"))
    files = {}
    for name, size in (("merged", 1 << 40), ("copied", 1)):
        monkeypatch.setattr(loads, "LARGE_FILE", size, raising=False)
        loads.load_listed_files(spark, str(tmp_path / "landed"), str(tmp_path / name), str(tmp_path / f"{name}-ledger"), BRONZE)
        assert read_declared(spark, str(tmp_path / name), BRONZE).count() == 80
        files[name] = len(list((tmp_path / name).rglob("*.parquet")))
    assert files == {"merged": 1, "copied": 2}
    monkeypatch.undo()
    assert [loads._large(n << 20, count) for n, count in ((1, 4), (1, 5), (20, 5), (0, 1))] == [True, False, True, False]


def test_dealt_pairs_are_spread_over_more_tasks_than_cores(spark):
    """Few tasks would each hold several busy days; a day still has few files."""
    hours = F.make_interval(hours=F.col("id").cast("int"))
    pairs = spark.range(24 * 20).select("id", (F.lit(START) + hours).alias("left_time"))
    dealt = deal_pairs("left_time", 4)(pairs).withColumn("task", F.spark_partition_id())
    found = Counter((row.year, row.month, row.day) for row in dealt.select(*DATE_PARTS, "task").distinct().collect())
    assert len(found) in (20, 21) and max(found.values()) <= 4
    assert dealt.select("task").distinct().count() > 2 * spark.sparkContext.defaultParallelism
