"""Parquet tables: partitioned writes, declared reads, rebuilds, names and descriptions."""

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from scanweave.constants import DATE_PARTS
from scanweave.sources.messages import NO_AGE_LIMIT
from scanweave.sources.snapshots import VERSION_PREFIX, Snapshot, commit, folder_and_name, snapshot


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = DATE_PARTS,
    mode: str = "append",
    together: bool = True,
) -> None:
    """Parquet by partition folders.

    The rebalance hint brings rows of a folder together, so tasks do not each write a file into
    every folder; AQE splits a folder that is much larger than the rest and merges small ones. Rows that come
    by folder already are written as they are, not `together`.
    """
    if together:
        df = df.hint("rebalance", *(F.col(name) for name in partition_by))
    df.write.mode(mode).partitionBy(*partition_by).option("compression", "snappy").parquet(path)


def read_declared(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Columns by name, ignoring case: absent ones are NULL, undeclared ones ignored, binary read as
    text. Partition columns come from the folder names."""
    return spark.read.schema(schema).parquet(path)


def create_table_if_absent(
    spark: SparkSession,
    name: str,
    schema: StructType,
    path: str,
    partition_by: Sequence[str] = DATE_PARTS,
    comment: str = "",
) -> None:
    """Declare a Parquet table over `path` unless the name exists.

    Declare it before streaming files into `path` (over a folder that already holds a streaming
    sink's log, the catalog keeps no column list), and refresh the name after each load.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet "
        f"PARTITIONED BY ({', '.join(partition_by)}) LOCATION '{path}' COMMENT {_quoted(comment)}"
    )


def load_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: StructType,
    partition_by: Sequence[str] = DATE_PARTS,
    max_files: int | None = None,
) -> StreamingQuery:
    """Append every file below `source` that no earlier run has loaded, then stop.

    A file is known by its path, so a rewritten file of the same name is skipped. No file is skipped
    for its age; the driver remembers one path per file below `source`. `max_files` cuts a large backlog into batches that are
    committed one by one. Rows are rebalanced by partition on the way, which merges the many small
    files a short trigger leaves.
    """
    options = {"maxFileAge": NO_AGE_LIMIT}
    if max_files:
        options["maxFilesPerTrigger"] = str(max_files)
    arrived = spark.readStream.schema(schema).options(**options).parquet(source)
    together = arrived.hint("rebalance", *(F.col(name) for name in partition_by))
    return (
        together.writeStream.outputMode("append")
        .format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .trigger(availableNow=True)
        .start()
    )


class Staged(NamedTuple):
    """A complete new version of the table at `path` that no reader sees yet."""

    path: str
    version: str
    table: DataFrame


def stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> Staged:
    """Write a new version beside the current one.

    No shuffle: a table derived row by row keeps the layout of its input. If the write fails, readers
    keep the version they have; what it left behind is never read.
    """
    version = f"{VERSION_PREFIX}{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{path}/{version}")
    return Staged(path, version, read_declared(df.sparkSession, f"{path}/{version}", df.schema))


def make_current(
    spark: SparkSession,
    *staged: Staged,
    names: Mapping[str, Mapping[str, str]] | None = None,
    since: Snapshot | None = None,
) -> Snapshot:
    """Let readers see the staged versions of the tables of one folder, all at once (see `commit`)."""
    bases = {folder_and_name(one.path)[0] for one in staged}
    if len(bases) != 1:
        raise ValueError(f"tables of one folder become current together, not of {sorted(bases)}")
    versions = {folder_and_name(one.path)[1]: one.version for one in staged}
    return commit(spark, *bases, versions, names, since)


def current_path(spark: SparkSession, path: str, at: Snapshot | None = None) -> str:
    """Folder of a rebuilt table's version in a snapshot of its folder, by default the latest."""
    base, name = folder_and_name(path)
    found = (at or snapshot(spark, base)).tables.get(name)
    if not found:
        raise FileNotFoundError(f"no version of {path} is current")
    return f"{path}/{found}"


def slice_label(partition_by: Sequence[str] = DATE_PARTS) -> Column:
    """Name of the slice a row lies in, from its partition columns alone."""
    return F.concat_ws("-", *(F.coalesce(F.col(name).cast("string"), F.lit("none")) for name in partition_by))


def held_slices(path: str, at: Snapshot, partition_by: Sequence[str] = DATE_PARTS) -> list[tuple[str, Column]]:
    """Folders of a table in a snapshot, each with the predicate on partition columns that says which of its rows count.

    A slice with a version of its own takes the place of that part of the whole table.
    """
    _, name = folder_and_name(path)
    whole, slices, label = at.tables.get(name), at.slices(name), slice_label(partition_by)
    found = [(f"{path}/{whole}", ~label.isin(list(slices)) if slices else F.lit(True))] if whole else []
    for version in sorted(set(slices.values())):
        found.append((f"{path}/{version}", label.isin([piece for piece, of in slices.items() if of == version])))
    return found


def read_current(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    at: Snapshot | None = None,
    partition_by: Sequence[str] = DATE_PARTS,
) -> DataFrame:
    """The current version of a rebuilt table; a failed rebuild or check leaves it as it was.

    Tables read at the same snapshot belong together, whatever becomes current meanwhile. Folders that were
    compacted are read from their own version.
    """
    base, name = folder_and_name(path)
    at = at or snapshot(spark, base)
    if not at.slices(name):
        folder = current_path(spark, path, at)
        return read_declared(spark, folder, schema) if schema else spark.read.parquet(folder)
    held = held_slices(path, at, partition_by)
    schema = schema or spark.read.parquet(held[0][0]).schema
    return reduce(DataFrame.unionByName, (read_declared(spark, folder, schema).where(mine) for folder, mine in held))


def rebuild(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace the table at `path` and return it as written; superseded versions stay until `expire`."""
    staged = stage(df, path, partition_by)
    make_current(df.sparkSession, staged)
    return staged.table


def publish(spark: SparkSession, name: str, path: str, comment: str = "") -> None:
    """Point `name` at the table in `path`, in one catalog step. The table must hold files.

    The session's catalog may end with the session; names that became current with their tables
    (`make_current`) are given to any later session by `attach`.
    """
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} COMMENT {_quoted(comment)} AS SELECT * FROM parquet.`{path}`"
    )


def named(register: str, name: str, path: str, comment: str = "") -> dict[str, dict[str, str]]:
    """The entry of a published name for `make_current`; `register` is a folder beside the table's."""
    return {f"{folder_and_name(register)[1]}/{name}": {"table": folder_and_name(path)[1], "comment": comment}}


def attach(spark: SparkSession, register: str) -> list[str]:
    """Give this session all names of `register`, over the tables of one snapshot; returns them."""
    base, folder = folder_and_name(register)
    at, attached = snapshot(spark, base), []
    for entry, kept in sorted(at.names.items()):
        where, _, name = entry.partition("/")
        if where == folder:
            publish(spark, name, current_path(spark, f"{base}/{kept['table']}", at), kept["comment"])
            attached.append(name)
    return attached


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "\\'") + "'"


def with_descriptions(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column descriptions; they are stored with the table and shown by DESCRIBE."""
    known = {name.lower(): text for name, text in comments.items()}
    for name in df.columns:
        if name.lower() in known:
            df = df.withMetadata(name, df.schema[name].metadata | {"comment": known[name.lower()]})
    return df


def describe_schema(schema: StructType, comments: Mapping[str, str]) -> StructType:
    """The schema with column descriptions, for `create_table_if_absent`."""
    described = StructType()
    for field in schema.fields:
        text = comments.get(field.name)
        metadata = {"comment": text} if text else None
        described.add(field.name, field.dataType, field.nullable, metadata)
    return described
