"""Declared schemas. Streams and the landing table are never inferred."""

from pyspark.sql.types import StructField, StructType, IntegerType, StringType, TimestampType

from scanweave.constants import BAGGAGE, DATE_PARTS, PASSENGER


def _texts(*names: str) -> list[StructField]:
    return [StructField(name, StringType()) for name in names]


def _times(*names: str) -> list[StructField]:
    return [StructField(name, TimestampType()) for name in names]


DATE_PART_FIELDS = [StructField(name, IntegerType()) for name in DATE_PARTS]

# Names and types of event and landing columns.
BAGGAGE_EVENT = StructType(
    _texts("event_id", "airline_code", "bag_tag_number", "pnr_locator", "flight_number")
    + _times("event_timestamp")
    + _texts("location_id")
)
PASSENGER_EVENT = StructType(
    _texts("event_id", "airline_code", "pnr_locator", "flight_number")
    + _times("event_timestamp")
    + _texts("gate_id")
)
JOINED = StructType(
    _texts("pnr_locator", "flight_number", "bag_tag_number", "baggage_location", "passenger_gate")
    + _times("baggage_time", "passenger_time")
)
BRONZE = StructType(JOINED.fields + DATE_PART_FIELDS)

_BY_KIND = {BAGGAGE: BAGGAGE_EVENT, PASSENGER: PASSENGER_EVENT}


def event_schema(kind: str) -> StructType:
    """Schema of one stream kind; an unknown kind is an error, not an empty schema."""
    if kind not in _BY_KIND:
        raise ValueError(f"unknown stream kind {kind!r}; expected one of {sorted(_BY_KIND)}")
    return _BY_KIND[kind]


def dead_letter_schema(kind: str) -> StructType:
    return StructType(event_schema(kind).fields + _texts("error_reason") + DATE_PART_FIELDS)


# Table and column descriptions.
BRONZE_COMMENT = "Bag scans matched with boardings of the same booking and flight, one row per pair."
SILVER_COMMENT = "Matched pairs in clean spelling, with the minutes between scan and boarding."
GOLD_COMMENT = "Bags, passengers and delays per flight and gate."
COLUMN_COMMENTS = {
    "pnr_locator": "Booking code, six characters.",
    "bag_tag_number": "Number printed on the bag's tag.",
    "baggage_time": "Time of the bag scan.",
    "passenger_time": "Time of the boarding.",
}
