"""Message sources and decoding. Every source yields a `value` column; decoding does not care which."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from scanweave.constants import LOCATOR_COLUMN
from scanweave.schemas import event_schema


# Longer than any file can be old: files are never skipped because newer ones exist.
NO_AGE_LIMIT = "36500d"


# Most messages of a topic in one batch, unless the caller says otherwise: the first batch of a long backlog is bounded too.
MOST_OFFSETS = "5000000"


def topic_messages(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options: str
) -> DataFrame:
    """Stream of one topic. Needs the Kafka connector package on the session.

    `starting` counts on the first run only; later runs resume from the checkpoint. Offsets that
    have expired are skipped instead of failing the query. A batch takes at most `MOST_OFFSETS` messages
    (`maxOffsetsPerTrigger`).
    """
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": MOST_OFFSETS,
    }
    return spark.readStream.format("kafka").options(**(settings | options)).load()


def text_messages(spark: SparkSession, path: str, streaming: bool = True) -> DataFrame:
    """One message per line, as a stream of new files, however old, or as a static read."""
    reader = spark.readStream.option("maxFileAge", NO_AGE_LIMIT) if streaming else spark.read
    return reader.text(path)


def decode_events(
    messages: DataFrame, kind: str, keep_raw: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """Message bytes to event columns, with the locator trimmed.

    A broken message gives a row of NULLs, a broken field a NULL field; undeclared fields are
    dropped. `keep_raw` adds the message text as `raw_value`, so dead letters keep their payload; `keep` names
    further columns of the messages to keep.
    The parsed struct is expanded by a generator, which later filters are not pushed through:
    each message is parsed once.
    """
    text = F.col("value").cast("string")
    parsed = F.inline(F.array(F.from_json(text, event_schema(kind))))
    kept = [*keep, *([text.alias("raw_value")] if keep_raw else [])]
    return messages.select(*kept, parsed).withColumn(LOCATOR_COLUMN, F.trim(LOCATOR_COLUMN))
