"""Fixed values of the data model: names, limits and labels that results depend on."""

from datetime import timedelta

# Stream kinds.
BAGGAGE = "BAGGAGE"
PASSENGER = "PASSENGER"

# The locator contract.
LOCATOR_COLUMN = "pnr_locator"
LOCATOR_LENGTH = 6
LOCATOR_PLACEHOLDERS = ("", "unknown")
REASON_LOCATOR = "FAILED_PNR_CONTRACT"
REASON_EVENT_TIME = "MISSING_EVENT_TIME"

# Event identity, allowed lateness and the match interval.
EVENT_TIME = "event_timestamp"
EVENT_KEYS = ("event_id", "event_timestamp")
MATCH_KEYS = ("pnr_locator", "flight_number")
LATENESS = "2 hours"
MATCH_BEFORE = timedelta(hours=3)
MATCH_AFTER = timedelta(hours=1)

# Folders, partition columns, trigger.
VALID_FOLDER = "valid_data"
BAGGAGE_DEAD_FOLDER = "dlq/baggage"
PASSENGER_DEAD_FOLDER = "dlq/passenger"
DATE_PARTS = ("year", "month", "day")
TRIGGER = "60 seconds"

# A scan is late when more than this many seconds after boarding.
LATE_AFTER_SECONDS = 60
