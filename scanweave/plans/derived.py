"""Messages derived from the `events` table, so that every query works on given data.

Each event becomes a baggage or passenger message with the faults a real feed shows: missing, empty
and placeholder locators, stray spaces, mixed case and repeated deliveries. All steps are narrow
and deterministic, and the same on a static and a streaming read.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scanweave.constants import BAGGAGE, PASSENGER
from scanweave.functions import padded
from scanweave.schemas import event_schema
from scanweave.sources.messages import NO_AGE_LIMIT

# Event types of each stream and the identifiers events are mapped to.
EVENT_TYPES = {BAGGAGE: ("view", "click", "error"), PASSENGER: ("signup", "purchase")}
FLIGHTS = ("AC800", "AC412", "AC109", "ac992 ")
BELTS = ("T1_SORT_BELT_4", "T1_SORT_BELT_7", "T3_SORT_BELT_1")
GATES = ("GATE_E73", "GATE_D22", "GATE_F14")
AIRLINE = "AC"
COPIES = 3

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    """The same table as a file stream. The pattern accepts a single file as well as a folder."""
    schema = events(spark, folder).schema
    return spark.readStream.schema(schema).option("maxFileAge", NO_AGE_LIMIT).parquet(f"{folder}/events.parque[t]")


def _pick(number: Column, choices: tuple[str, ...]) -> Column:
    options = F.array(*(F.lit(choice) for choice in choices))
    return F.get(options, F.pmod(number, F.lit(len(choices))).cast("int"))


def _locator() -> Column:
    user = F.col("user_id")
    kind = F.pmod(user, F.lit(20))
    return (
        F.when(kind == 0, F.lit(None))
        .when(kind == 1, F.lit(""))
        .when(kind == 2, F.lit("UNKNOWN"))
        .when(kind == 3, F.lit("unknown"))
        .when(kind == 4, F.concat(F.lit(" p"), padded(user, 5), F.lit(" ")))
        .otherwise(F.concat(F.lit("P"), padded(user, 5)))
    )


def messages(source: DataFrame, kind: str) -> DataFrame:
    """JSON messages of one stream kind: `value`."""
    event_schema(kind)  # rejects unknown kinds
    user, event = F.col("user_id"), F.col("event_id")
    fields = {
        "event_id": event.cast("string"),
        "airline_code": F.lit(AIRLINE),
        "pnr_locator": _locator(),
        "flight_number": _pick(user, FLIGHTS),
        "event_timestamp": F.date_format(F.col("ts").cast("timestamp"), ISO_MICROS),
        "event_type": F.col("event_type"),
    }
    if kind == BAGGAGE:
        fields["bag_tag_number"] = F.concat(
            F.lit("0014"), padded(user * 3 + F.pmod(event, F.lit(3)), 6)
        )
        fields["location_id"] = _pick(event, BELTS)
    else:
        fields["gate_id"] = _pick(event, GATES)
    body = F.to_json(F.struct(*(value.alias(name) for name, value in fields.items())))
    deliveries = F.when(F.pmod(event, F.lit(10)) == 0, F.lit(COPIES)).otherwise(F.lit(1))
    own = source.filter(F.col("event_type").isin(*EVENT_TYPES[kind]))
    return own.select(body.alias("value"), deliveries.alias("n")).select(
        "value", F.explode(F.array_repeat(F.lit(True), F.col("n"))).alias("_delivery")
    ).select("value")
