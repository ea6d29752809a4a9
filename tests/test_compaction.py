"""Packing small files: same rows, fewer files, one version for every reader."""

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from scanweave.sources import compaction, snapshots
from scanweave.sources.compaction import compact, file_listing, first_fit
from scanweave.sources.snapshots import CommitConflict, expire, snapshot
from scanweave.sources.tables import make_current, read_current, rebuild, stage

PARTS = ("year", "month", "day")


@given(st.lists(st.integers(0, 120), max_size=60))
def test_first_fit(sizes):
    bins = first_fit(sizes, 100)
    held = {}
    for size, number in zip(sizes, bins):
        held.setdefault(number, []).append(size)
    assert sorted(held) == list(range(len(held)))
    assert all(sum(one) <= 100 or len(one) == 1 or sum(s > 0 for s in one) == 1 for one in held.values())
    # Two bins that would go into one are never left.
    loads = sorted(sum(one) for one in held.values())
    assert len(loads) < 2 or loads[0] + loads[1] > 100


def written(spark, path, days=4, files=6, shift=0):
    rows = spark.range(2400).select(
        F.col("id"), F.concat(F.lit("x"), F.col("id") + shift).alias("v"), F.lit(2026).alias("year"), F.lit(5).alias("month"),
        F.when(F.col("id") % days > 0, (F.col("id") % days).cast("int")).alias("day"),
    )
    return rebuild(rows.repartition(files, "id"), path, PARTS)


def content(df):
    return sorted(map(str, df.select("id", "v", *PARTS).collect()))


def files_of(spark, path, at):
    return {r["slice"]: r.n for r in file_listing(spark, path, at).groupBy("slice").agg(F.count("*").alias("n")).collect()}


def test_same_rows_in_fewer_files(spark, tmp_path):
    path = f"{tmp_path}/t"
    written(spark, path)
    before = snapshot(spark, str(tmp_path))
    want = content(read_current(spark, path))
    done = compact(spark, path)
    assert done.files == {f"2026-5-{day}": (6, 1) for day in (1, 2, 3, "none")}
    assert files_of(spark, path, done.at) == dict.fromkeys(done.files, 1)
    assert files_of(spark, path, before) == dict.fromkeys(done.files, 6)
    assert content(read_current(spark, path)) == content(read_current(spark, path, at=before)) == want
    # A day is read from its own folder only.
    one_day = read_current(spark, path).where("day = 2")
    assert content(one_day) == [row for row in want if "day=2" in row]
    # There is nothing left to do, and retention keeps what is current.
    assert compact(spark, path).files == {}
    expire(spark, str(tmp_path), keep=1)
    assert content(read_current(spark, path)) == want


def test_files_are_bounded(spark, tmp_path):
    path = f"{tmp_path}/t"
    written(spark, path, days=2, files=8)
    sizes = [r.length for r in file_listing(spark, path, snapshot(spark, str(tmp_path))).collect()]
    room = max(sizes) * 2
    done = compact(spark, path, target_bytes=room)
    assert done.files and all(after == 4 for _, after in done.files.values())
    after = file_listing(spark, path, done.at).collect()
    assert len(after) == 8 and all(r.length <= room for r in after)


def test_a_folder_that_gains_little_is_left(spark, tmp_path):
    path = f"{tmp_path}/t"
    written(spark, path)
    at = snapshot(spark, str(tmp_path))
    assert compact(spark, path, target_bytes=1).files == {} and snapshot(spark, str(tmp_path)) == at


def test_a_rebuild_replaces_compacted_folders(spark, tmp_path):
    path = f"{tmp_path}/t"
    written(spark, path)
    compact(spark, path)
    new = written(spark, path, shift=5)
    assert content(read_current(spark, path)) == content(new)
    assert snapshot(spark, str(tmp_path)).slices("t") == {}


def test_overtaken_by_a_rebuild(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    written(spark, path)

    def late(*arguments, **options):
        monkeypatch.setattr(compaction, "commit", snapshots.commit)
        written(spark, path, shift=9)
        return snapshots.commit(*arguments, **options)

    monkeypatch.setattr(compaction, "commit", late)
    with pytest.raises(CommitConflict):
        compact(spark, path)
    assert "v='x9'" in content(read_current(spark, path))[0]


def test_killed_before_the_commit(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    written(spark, path)
    at, want = snapshot(spark, str(tmp_path)), content(read_current(spark, path))

    def killed(*_, **__):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(compaction, "commit", killed)
        with pytest.raises(RuntimeError):
            compact(spark, path)
    assert snapshot(spark, str(tmp_path)) == at and content(read_current(spark, path)) == want


def test_no_table_or_no_rows(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        compact(spark, f"{tmp_path}/t")
    empty = spark.createDataFrame([], "id long, v string, year int, month int, day int")
    make_current(spark, stage(empty, f"{tmp_path}/t", PARTS))
    assert compact(spark, f"{tmp_path}/t").files == {}
