"""Messages derived from given events stay distinct at any size of the ids."""

import json

from scanweave.constants import BAGGAGE
from scanweave.functions import padded
from scanweave.plans import derived


def test_padding_never_cuts(spark):
    numbers = [0, 7, 99_999, 100_000, 149_999, 1_000_002, 12_345_678_901]
    rows = spark.createDataFrame([(n,) for n in numbers], "n long").select(padded("n", 5).alias("text")).collect()
    assert [row.text for row in rows] == ["00000", "00007", "99999", "100000", "149999", "1000002", "12345678901"]


def test_large_ids_share_no_locator_or_tag(spark):
    users = [*range(5, 40), *range(99_990, 100_040), *range(149_990, 150_040), *range(999_990, 1_000_040), 14_999, 1_499]
    events = spark.createDataFrame([(3 * n + 1, user, "view") for n, user in enumerate(users)], "event_id long, user_id long, event_type string")
    events = events.selectExpr("*", "timestamp '2024-01-01' AS ts")
    seen = [json.loads(row.value) for row in derived.messages(events, BAGGAGE).collect()]
    by_event = {int(m["event_id"]): m for m in seen}
    locators, tags = {}, {}
    for n, user in enumerate(users):
        message = by_event[3 * n + 1]
        tags.setdefault(message["bag_tag_number"], set()).add(user)
        if user % 20 > 3:
            locators.setdefault(message["pnr_locator"].strip().upper(), set()).add(user)
    assert all(len(owners) == 1 for owners in (*locators.values(), *tags.values()))
