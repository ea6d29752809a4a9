"""Reading inputs and cutting lineage for the operators of this subpackage."""

from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from scanweave.session import scratch_folder


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Folders written since the innermost `landed_alone` of this thread began; None outside of one.
_created: ContextVar[list[str] | None] = ContextVar("created", default=None)


def landed(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of `df` as a written table below the shared checkpoint folder.

    Later jobs read files instead of repeating the work, also after executors are lost, and Spark
    knows the size of the table when it chooses a join.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark, purpose)
    created = _created.get()
    if created is not None:
        created.append(folder)
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def landed_alone(spark: SparkSession, make, purpose: str) -> DataFrame:
    """What `make` returns as a written table, without the tables that were written on the way to it.

    Each call keeps its own list of folders, so calls in several threads leave each other's tables alone.
    """
    on_the_way: list[str] = []
    token = _created.set(on_the_way)
    try:
        done = landed(make(), purpose)
    finally:
        _created.reset(token)
    *others, own = on_the_way
    for folder in others:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if _created.get() is not None:
        _created.get().append(own)
    return done
