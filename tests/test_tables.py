import os
import subprocess
import sys
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from scanweave.constants import DATE_PARTS
from scanweave.operators.quality import CONFORMED_LOCATOR, NotNull, QualityGateError, published_checks
from scanweave.plans.batch_run import Lake, load_bronze, run_batch, run_batch_published
from scanweave.schemas import BRONZE, COLUMN_COMMENTS
from scanweave.session import session_conf
from scanweave.sources import files
from scanweave.sources.messages import text_messages
from scanweave.sources.tables import (
    attach,
    current_path,
    load_new_files,
    publish,
    read_current,
    read_declared,
    rebuild,
    with_descriptions,
    write_partitioned,
)


ROOT = Path(__file__).resolve().parents[1]


def landed(spark, locators, day=1):
    rows = ", ".join(
        f"('{p}', 'AC1', 'T{i}', 'B', 'G', timestamp '2026-05-0{day} 10:00:00', "
        f"timestamp '2026-05-0{day} 11:00:00', 2026, 5, {day})"
        for i, p in enumerate(locators)
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(BRONZE.names)})")


def test_incremental_load_takes_each_file_once(spark, tmp_path):
    lake = Lake(str(tmp_path))
    write_partitioned(landed(spark, ["ABC123"]), lake.landed)
    assert [load_bronze(spark, lake).count() for _ in range(2)] == [1, 1]
    write_partitioned(landed(spark, ["ABC124"], day=2), lake.landed)
    bronze = load_bronze(spark, lake)
    assert bronze.count() == 2
    assert {(r.year, r.month, r.day) for r in bronze.collect()} == {(2026, 5, 1), (2026, 5, 2)}


def test_rewritten_file_of_the_same_name_is_skipped(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def load():
        load_new_files(spark, source, target, checkpoint, BRONZE, max_files=1).awaitTermination()
        return read_declared(spark, target, BRONZE).count()

    write_partitioned(landed(spark, ["ABC123"]), source)
    assert load() == 1
    file = next((tmp_path / "in").rglob("*.parquet"))
    bigger = tmp_path / "bigger"
    landed(spark, ["X", "Y", "Z"]).drop(*DATE_PARTS).coalesce(1).write.parquet(str(bigger))
    content = next(bigger.glob("*.parquet")).read_bytes()
    file.write_bytes(content)
    file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    assert load() == 1


def test_load_matches_columns_by_name(spark, tmp_path):
    (tmp_path / "in").mkdir()
    landed(spark, ["ABC123"]).selectExpr(
        "pnr_locator as PNR_Locator", "cast(flight_number as binary) as FLIGHT_NUMBER", "1 as extra",
        "year", "month", "day",
    ).write.partitionBy(*DATE_PARTS).parquet(str(tmp_path / "in/day1"))
    row = read_declared(spark, str(tmp_path / "in/day1"), BRONZE).first()
    assert (row.pnr_locator, row.flight_number, row.bag_tag_number, row.day) == ("ABC123", "AC1", None, 1)
    assert "extra" not in row


def test_day_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(landed(spark, ["A", "B"]).unionByName(landed(spark, ["C"], day=2)), path)
    day = read_declared(spark, path, BRONZE).filter("day = 2 AND pnr_locator = 'C'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "EqualTo(pnr_locator,C)" in plan
    assert day.count() == 1


def test_declared_table_is_created_once_and_reads_streamed_files(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for day in (1, 2):
        write_partitioned(landed(spark, ["ABC123"], day=day), lake.landed)
        assert load_bronze(spark, lake, name="bronze_declared").count() == day
    assert spark.table("bronze_declared").filter("day = 2").first().pnr_locator == "ABC123"
    comments = {c.name: c.description for c in spark.catalog.listColumns("bronze_declared")}
    assert comments["pnr_locator"] == COLUMN_COMMENTS["pnr_locator"] and comments["day"] is None


def test_descriptions_survive_a_rebuild(spark, tmp_path):
    table = rebuild(with_descriptions(landed(spark, ["A"]), COLUMN_COMMENTS), str(tmp_path / "t"))
    assert table.schema["bag_tag_number"].metadata["comment"] == COLUMN_COMMENTS["bag_tag_number"]


def test_rebuild_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    rebuild(landed(spark, ["A", "B"]), path)
    assert rebuild(landed(spark, ["C"]), path).count() == 1
    assert read_current(spark, path, BRONZE).first().pnr_locator == "C"


def test_a_failed_rebuild_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    rebuild(landed(spark, ["A", "B"]), path)
    broken = landed(spark, ["C", "D"]).withColumn("pnr_locator", F.raise_error(F.col("pnr_locator")).cast("string"))
    with pytest.raises(Exception, match="USER_RAISED_EXCEPTION|raise_error"):
        rebuild(broken, path)
    assert sorted(row.pnr_locator for row in read_current(spark, path).collect()) == ["A", "B"]


@pytest.mark.parametrize("days", [8, 11 * 365])
def test_files_are_not_skipped_for_their_age(spark, tmp_path, days):
    lake = Lake(str(tmp_path / "lake"))
    write_partitioned(landed(spark, ["ABC123"]), lake.landed)
    assert load_bronze(spark, lake).count() == 1
    write_partitioned(landed(spark, ["ABC124"], day=2), str(tmp_path / "late"))
    files.move_backdated(spark, str(tmp_path / "late"), lake.landed, timedelta(days=days))
    assert load_bronze(spark, lake).count() == 2


@pytest.mark.parametrize("days", [8, 11 * 365])
def test_old_messages_are_read(spark, tmp_path, days):
    for name, age in (("new", timedelta()), ("old", timedelta(days=days))):
        spark.createDataFrame([(name,)], "value string").coalesce(1).write.text(str(tmp_path / name))
        files.move_backdated(spark, str(tmp_path / name), str(tmp_path / "in"), age)
        query = (
            text_messages(spark, str(tmp_path / "in")).writeStream.format("parquet")
            .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    assert {row.value for row in spark.read.parquet(str(tmp_path / "out")).collect()} == {"new", "old"}


def test_publish_moves_a_name(spark, tmp_path):
    for version, locators in enumerate((["A"], ["B", "C"])):
        path = str(tmp_path / f"v{version}")
        rebuild(landed(spark, locators), path)
        publish(spark, "published_name", current_path(spark, path), "it's current")
        assert spark.table("published_name").count() == len(locators)


def test_published_names_are_described(spark, tmp_path):
    rebuild(landed(spark, ["A"]), str(tmp_path / "t"))
    publish(spark, "described_name", current_path(spark, str(tmp_path / "t")), "it's current")
    details = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED described_name").collect()}
    assert details["Comment"] == "it's current"


def test_batch_run_and_gate(spark, tmp_path):
    lake = Lake(str(tmp_path))
    built = run_batch(landed(spark, ["ABC123", "ABC124"]), lake)
    assert (built.silver.count(), built.gold.count()) == (2, 1)
    # a lower-case locator is legal but is upper-cased in silver, so the literal relationship fails
    with pytest.raises(QualityGateError, match="relationship_silver"):
        run_batch(landed(spark, ["abc123"]), lake)
    assert read_current(spark, lake.silver).count() == 2
    # with conformed parents it holds
    run_batch(landed(spark, ["abc123"]), lake, published_checks(CONFORMED_LOCATOR))
    assert [row.pnr_locator for row in read_current(spark, lake.silver).collect()] == ["ABC123"]


def test_publication_keeps_the_old_tables_when_a_check_fails(spark, tmp_path):
    lake = Lake(str(tmp_path))
    names = ("silver_gate", "gold_gate")
    run_batch_published(landed(spark, ["ABC123"]), lake, *names)
    with pytest.raises(QualityGateError):
        run_batch_published(landed(spark, ["abc124"]), lake, *names)
    assert [row.pnr_locator for row in spark.table("silver_gate").collect()] == ["ABC123"]
    run_batch_published(landed(spark, ["abc124"]), lake, *names, checks=[NotNull("gold", "flight_number")])
    assert [row.pnr_locator for row in spark.table("silver_gate").collect()] == ["ABC124"]


def test_published_names_outlive_the_session(spark, tmp_path):
    """A session of its own process, with a catalog of its own, finds the names."""
    lake = Lake(str(tmp_path))
    run_batch_published(landed(spark, ["ABC123"]), lake, "silver_kept", "gold_kept")
    code = (
        "import sys; from scanweave.session import build_session; from scanweave.sources.tables import attach\n"
        "spark = build_session('later', 'local[1]')\n"
        "assert not spark.catalog.tableExists('gold_kept')\n"
        "assert attach(spark, sys.argv[1]) == ['gold_kept', 'silver_kept']\n"
        "print('found', spark.table('silver_kept').first().pnr_locator, spark.table('gold_kept').count())"
    )
    done = subprocess.run(
        [sys.executable, "-c", code, lake.names], capture_output=True, text=True, timeout=300, cwd=ROOT,
        env={**os.environ, "PYTHONPATH": str(ROOT)},
    )
    assert "found ABC123 1" in done.stdout, done.stderr[-2000:]
    assert attach(spark, str(tmp_path / "nowhere")) == []


def test_a_hot_day_is_split_over_files(spark, tmp_path):
    path = tmp_path / "t"
    hot = spark.range(40000).selectExpr("uuid() AS pnr_locator", "2026 AS year", "5 AS month", "1 AS day")
    cold = spark.range(10).selectExpr("uuid() AS pnr_locator", "2026 AS year", "5 AS month", "2 AS day")
    with session_conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB"):
        write_partitioned(hot.unionByName(cold.repartition(8)), str(path))
    files = {day: len(list((path / f"year=2026/month=5/day={day}").glob("*.parquet"))) for day in (1, 2)}
    assert files[1] > 1 and files[2] == 1
    assert spark.read.parquet(str(path)).count() == 40010


def test_batch_command(spark, tmp_path):
    from scanweave.__main__ import main

    lake = Lake(str(tmp_path))
    write_partitioned(landed(spark, ["ABC123", "ABC124"]), lake.landed)
    main(["batch", "--base", lake.base, "--publish", "silver_cli", "gold_cli"])
    assert spark.table("gold_cli").first().total_bags_tracked == 2
    write_partitioned(landed(spark, ["abc125"], day=2), lake.landed)
    with pytest.raises(QualityGateError):
        main(["batch", "--base", lake.base])
    assert read_current(spark, lake.silver).count() == 2
    main(["batch", "--base", lake.base, "--conform-parents"])
    assert read_current(spark, lake.silver).count() == 3


def test_partition_columns_are_discovered_as_integers(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(landed(spark, ["A"]), path)
    assert dict(spark.read.parquet(path).dtypes)["month"] == "int"
