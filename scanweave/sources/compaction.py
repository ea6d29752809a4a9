"""Small files of a table's partition folders packed into larger ones, without readers noticing."""

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from scanweave.constants import DATE_PARTS
from scanweave.sources import files
from scanweave.sources.snapshots import Snapshot, commit, folder_and_name, snapshot
from scanweave.sources.tables import held_slices, slice_label, stage

TARGET_BYTES = 256 << 20


class Compacted(NamedTuple):
    """Slices that were written anew, with their number of files before and after."""

    files: dict[str, tuple[int, int]]
    at: Snapshot


def first_fit(sizes: Sequence[int], room: int) -> list[int]:
    """The bin of every size, larger sizes first, each in the first bin with room for it.

    A size beyond `room` has a bin of its own. Bins too full for the smallest size are not looked at again.
    """
    least, open_bins, bins, out = min(sizes, default=0), [], 0, [0] * len(sizes)
    for at in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        for place, (number, left) in enumerate(open_bins):
            if sizes[at] <= left:
                break
        else:
            place, number, left = len(open_bins), bins, max(room, sizes[at])
            open_bins.append((number, left))
            bins += 1
        out[at] = number
        open_bins[place] = (number, left - sizes[at])
        if left - sizes[at] < least:
            del open_bins[place]
    return out


def packing_plan(listing: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """`slice`, `file` and `bin` for every file of a listing (`slice`, `file`, `length`).

    One task packs the files of one slice, by name and size alone; nothing is opened.
    """

    def pack(listed):
        listed = listed.sort_values("file")
        return listed.assign(bin=first_fit(listed["length"].tolist(), target_bytes))[["slice", "file", "bin"]]

    return listing.groupBy("slice").applyInPandas(pack, "slice string, file string, bin int")


def file_listing(spark: SparkSession, path: str, at: Snapshot, partition_by: Sequence[str] = DATE_PARTS) -> DataFrame:
    """`slice`, `file` and `length` of the files that readers of a table see in a snapshot."""
    found = [spark.createDataFrame([], "slice string, file string, length long")]
    for folder, mine in held_slices(path, at, partition_by):
        listed = spark.read.format("binaryFile").load(folder)
        if set(partition_by) <= set(listed.columns):  # a table without rows has no partition folders
            found.append(
                listed.where(mine).select(
                    slice_label(partition_by).alias("slice"), F.col("_metadata.file_path").alias("file"), "length"
                )
            )
    return reduce(DataFrame.unionByName, found)


def compact(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str] = DATE_PARTS,
    target_bytes: int = TARGET_BYTES,
    most_left: float = 0.5,
) -> Compacted:
    """Write partition folders anew whose files, first-fit packed by size, are at most `most_left` as many as now.

    The rows of a bin become one file, of about `target_bytes` at most unless one file was larger. The new files lie beside
    the old ones and become current in one step with the next snapshot, so a reader sees the old files of a folder or the new
    ones; readers of earlier snapshots keep theirs until `expire`. Other folders are neither read nor written. A compaction
    killed earlier leaves the table as it was; one overtaken by a rebuild of the table raises `CommitConflict`. A rebuild
    replaces compacted folders too. Names published over a rebuilt table go on reading its files as they were written.
    """
    base, name = folder_and_name(path)
    at = snapshot(spark, base)
    if name not in at.tables and not at.slices(name):
        raise FileNotFoundError(f"no version of {path} is current")
    # A row per file, read twice.
    planned = stage(packing_plan(file_listing(spark, path, at, partition_by), target_bytes), f"{path}-plans")
    plan = planned.table
    gains = (
        plan.groupBy("slice")
        .agg(F.count("*").alias("files"), F.count_distinct("bin").alias("bins"))
        .where(F.col("bins") <= most_left * F.col("files"))
        .orderBy("slice")
        .collect()  # one row per folder that gains
    )
    if not gains:
        files.remove(spark, f"{planned.path}/{planned.version}")
        return Compacted({}, at)
    starts, total = [], 0
    for row in gains:
        starts.append((row["slice"], total))
        total += row["bins"]
    places = plan.join(spark.createDataFrame(starts, "slice string, start int"), "slice").select(
        "file", (F.col("start") + F.col("bin")).alias("place")
    )
    chosen = slice_label(partition_by).isin([row["slice"] for row in gains])
    rows = [
        spark.read.parquet(folder).where(mine & chosen).select("*", F.col("_metadata.file_path").alias("file"))
        for folder, mine in held_slices(path, at, partition_by)
    ]
    placed = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), rows).join(places, "file")
    packed = stage(placed.repartitionById(total, F.col("place")).drop("file", "place"), path, partition_by)
    files.remove(spark, f"{planned.path}/{planned.version}")
    versions = {f"{name}:{row['slice']}": packed.version for row in gains}
    # The whole table is named too, so that a rebuild meanwhile is noticed.
    whole = {name: at.tables[name]} if name in at.tables else {}
    after = commit(spark, base, whole | versions, since=at)
    return Compacted({row["slice"]: (row["files"], row["bins"]) for row in gains}, after)
