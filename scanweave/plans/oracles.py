"""The registered queries in ANSI SQL over the same tables, written without Spark's helpers."""

# Fixed values below (identifiers, placeholders, limits) equal those in `constants` and `derived`.


def _padded(number: str, width: int) -> str:
    """Leading zeros up to the width; longer numbers stay whole."""
    digits = f"CAST({number} AS VARCHAR)"
    return f"(repeat('0', greatest(0, {width} - length({digits}))) || {digits})"


_EVENTS = f"""
delivered AS (
  SELECT e.*, unnest(range(CASE WHEN event_id % 10 = 0 THEN 3 ELSE 1 END)) AS delivery
  FROM events e
),
decoded AS (
  SELECT event_type IN ('view', 'click', 'error') AS is_bag, user_id,
    CAST(event_id AS VARCHAR) AS event_id,
    'AC' AS airline_code,
    '0014' || {_padded('user_id * 3 + event_id % 3', 6)} AS bag_tag_number,
    trim(CASE user_id % 20
      WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'UNKNOWN' WHEN 3 THEN 'unknown'
      WHEN 4 THEN ' p' || {_padded('user_id', 5)} || ' '
      ELSE 'P' || {_padded('user_id', 5)} END, ' ') AS pnr_locator,
    CASE user_id % 4 WHEN 0 THEN 'AC800' WHEN 1 THEN 'AC412' WHEN 2 THEN 'AC109'
      ELSE 'ac992 ' END AS flight_number,
    ts AS event_timestamp,
    CASE event_id % 3 WHEN 0 THEN 'T1_SORT_BELT_4' WHEN 1 THEN 'T1_SORT_BELT_7'
      ELSE 'T3_SORT_BELT_1' END AS location_id,
    CASE event_id % 3 WHEN 0 THEN 'GATE_E73' WHEN 1 THEN 'GATE_D22'
      ELSE 'GATE_F14' END AS gate_id
  FROM delivered
),
judged AS (
  SELECT *, coalesce(length(pnr_locator) = 6 AND lower(pnr_locator) <> 'unknown', false) AS ok
  FROM decoded
)"""

_BAG = "event_id, airline_code, bag_tag_number, pnr_locator, flight_number, event_timestamp, location_id"
_PAX = "event_id, airline_code, pnr_locator, flight_number, event_timestamp, gate_id"
_DAY = """CAST(year({0}) AS INTEGER) AS year, CAST(month({0}) AS INTEGER) AS month,
  CAST(day({0}) AS INTEGER) AS day"""
_DAY_OF_EVENT = _DAY.format("event_timestamp")

_MATCH = """
  SELECT p.pnr_locator, p.flight_number, b.bag_tag_number, b.location_id AS baggage_location,
    p.gate_id AS passenger_gate, b.event_timestamp AS baggage_time,
    p.event_timestamp AS passenger_time
  FROM {bags} b JOIN {pax} p
    ON b.pnr_locator = p.pnr_locator AND b.flight_number = p.flight_number
   AND b.event_timestamp BETWEEN p.event_timestamp - INTERVAL 3 HOUR
                             AND p.event_timestamp + INTERVAL 1 HOUR"""

_MATCHED = f"""{_EVENTS},
bags AS (SELECT DISTINCT {_BAG} FROM judged WHERE is_bag AND ok),
pax AS (SELECT DISTINCT {_PAX} FROM judged WHERE NOT is_bag AND ok),
matched AS ({_MATCH.format(bags="bags", pax="pax")}
),
bronze AS (SELECT *, {_DAY.format("baggage_time")} FROM matched)"""

_CROWD = """SELECT * REPLACE (
    CASE WHEN CAST(event_id AS BIGINT) % 3 = 0 THEN 'CROWD1' ELSE pnr_locator END AS pnr_locator,
    CASE WHEN CAST(event_id AS BIGINT) % 3 = 0 THEN 'AC800' ELSE flight_number END AS flight_number) FROM """

_CROWDED = f"""WITH {_MATCHED}, crowd_bags AS ({_CROWD} bags), crowd_pax AS ({_CROWD} pax)
{_MATCH.format(bags="crowd_bags", pax="crowd_pax")}"""

_SILVER = f"""{_MATCHED},
conformed AS (
  SELECT upper(trim(pnr_locator, ' ')) AS pnr_locator, upper(trim(flight_number, ' ')) AS flight_number,
    upper(trim(bag_tag_number, ' ')) AS bag_tag_number,
    upper(trim(baggage_location, ' ')) AS baggage_location,
    upper(trim(passenger_gate, ' ')) AS passenger_gate,
    baggage_time, passenger_time, year, month, day,
    date_diff('second', passenger_time, baggage_time) AS secs
  FROM bronze WHERE pnr_locator IS NOT NULL AND bag_tag_number IS NOT NULL
),
silver AS (
  SELECT * EXCLUDE (secs), round(secs / 60.0::DOUBLE, 6) AS scan_to_board_interval_minutes,
    coalesce(secs > 60, false) AS is_late_baggage_scan
  FROM conformed
)"""

_GOLD = f"""{_SILVER},
per_gate AS (
  SELECT flight_number, passenger_gate,
    count(DISTINCT pnr_locator) AS total_passengers_processed,
    count(DISTINCT bag_tag_number) AS total_bags_tracked,
    CAST(sum(secs) AS DOUBLE) / count(secs) / 60 AS avg_bag_scan_to_boarding_duration,
    max(round(secs / 60.0::DOUBLE, 6)) AS max_bag_scan_delay,
    count(*) FILTER (WHERE secs > 60) AS total_late_bags,
    max(baggage_time) AS last_processed_at
  FROM conformed GROUP BY flight_number, passenger_gate
),
gold AS (
  SELECT *, CASE WHEN total_bags_tracked > 0 THEN CAST(round(
      CAST(CAST(total_late_bags AS DOUBLE) / total_bags_tracked AS DECIMAL(18, 6)) * 100, 2
    ) AS DOUBLE) ELSE 0 END AS baggage_mishandle_rate_percentage
  FROM per_gate
)"""


def _dead(is_bag: bool) -> str:
    columns, side = (_BAG, "is_bag") if is_bag else (_PAX, "NOT is_bag")
    return f"""WITH {_EVENTS}
SELECT {columns}, 'FAILED_PNR_CONTRACT' AS error_reason, {_DAY_OF_EVENT}
FROM judged WHERE {side} AND NOT ok"""


def _report() -> str:
    missing = "SELECT '{0}' AS test, count(*) AS failures FROM {1} WHERE {2} IS NULL"
    checks = [
        missing.format("not_null_silver_pnr_locator", "silver", "pnr_locator"),
        missing.format("not_null_silver_bag_tag_number", "silver", "bag_tag_number"),
        missing.format("not_null_gold_flight_number", "gold", "flight_number"),
        missing.format("not_null_gold_total_bags_tracked", "gold", "total_bags_tracked"),
        """SELECT 'relationship_silver_pnr_locator_bronze_pnr_locator', count(*)
           FROM silver ANTI JOIN bronze USING (pnr_locator) WHERE pnr_locator IS NOT NULL""",
        """SELECT 'accepted_values_silver_is_late_baggage_scan', count(DISTINCT is_late_baggage_scan)
           FROM silver WHERE is_late_baggage_scan NOT IN (true, false)""",
    ]
    return f"WITH {_GOLD}\n" + "\nUNION ALL\n".join(checks)


_DAMAGED = """SELECT * REPLACE (CASE WHEN right(bag_tag_number, 1) <> '0' THEN pnr_locator END AS pnr_locator,
    CASE WHEN flight_number <> 'AC109' THEN flight_number END AS flight_number) FROM """


def _side_by_side(state: str, rows: str) -> str:
    """Silver and gold agree: the same counts from the rows of one run."""
    return f"""SELECT '{state}' AS state, flight_number, passenger_gate,
      count(DISTINCT bag_tag_number) AS silver_bags, count(*) FILTER (WHERE is_late_baggage_scan) AS silver_late,
      count(DISTINCT bag_tag_number) AS gold_bags, count(*) FILTER (WHERE is_late_baggage_scan) AS gold_late
      FROM silver WHERE {rows} GROUP BY flight_number, passenger_gate"""


def all_oracles() -> dict[str, str]:
    gold = f"WITH {_GOLD} SELECT * FROM gold"
    matched = f"WITH {_MATCHED} SELECT * FROM matched"
    bronze = f"WITH {_MATCHED} SELECT * FROM bronze"
    silver = f"WITH {_SILVER} SELECT * FROM silver"
    unmatched = "pnr_locator, bag_tag_number, baggage_time, passenger_time"
    return {
        "json_decode": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
            FROM events""",
        "message_decode_baggage": f"WITH {_EVENTS} SELECT {_BAG} FROM decoded WHERE is_bag",
        "message_decode_passenger": f"WITH {_EVENTS} SELECT {_PAX} FROM decoded WHERE NOT is_bag",
        "contract_valid_baggage": f"WITH {_EVENTS} SELECT {_BAG} FROM judged WHERE is_bag AND ok",
        "contract_valid_passenger": f"""WITH {_EVENTS}
            SELECT {_PAX} FROM judged WHERE NOT is_bag AND ok""",
        "contract_dead_letter_baggage": _dead(True),
        "contract_dead_letter_passenger": _dead(False),
        "contract_foreign_json": """SELECT props AS raw_value, CAST(NULL AS VARCHAR) AS event_id,
            CAST(NULL AS VARCHAR) AS airline_code, CAST(NULL AS VARCHAR) AS bag_tag_number,
            CAST(NULL AS VARCHAR) AS pnr_locator, CAST(NULL AS VARCHAR) AS flight_number,
            CAST(NULL AS TIMESTAMP) AS event_timestamp, CAST(NULL AS VARCHAR) AS location_id,
            'FAILED_PNR_CONTRACT' AS error_reason FROM events""",
        "contract_malformed_text": """SELECT text AS raw_value, CAST(NULL AS VARCHAR) AS event_id,
            CAST(NULL AS VARCHAR) AS airline_code, CAST(NULL AS VARCHAR) AS pnr_locator,
            CAST(NULL AS VARCHAR) AS flight_number, CAST(NULL AS TIMESTAMP) AS event_timestamp,
            CAST(NULL AS VARCHAR) AS gate_id, 'FAILED_PNR_CONTRACT' AS error_reason
            FROM documents""",
        "contract_missing_time": f"""SELECT CAST(o_orderkey AS VARCHAR) AS event_id,
            CAST(NULL AS VARCHAR) AS airline_code,
            'C' || {_padded('o_custkey', 5)} AS pnr_locator,
            CAST(NULL AS VARCHAR) AS flight_number, CAST(NULL AS TIMESTAMP) AS event_timestamp,
            o_orderpriority AS gate_id, 'MISSING_EVENT_TIME' AS error_reason
            FROM orders WHERE o_orderstatus = 'P'""",
        "dead_letter_summary": f"""WITH {_EVENTS},
            dead AS (SELECT 'FAILED_PNR_CONTRACT' AS error_reason, {_DAY_OF_EVENT}
              FROM judged WHERE NOT ok)
            SELECT error_reason, year, month, day, count(*) AS dead_letters
            FROM dead GROUP BY ALL""",
        "partition_columns_events": f"SELECT event_id, ts, {_DAY.format('ts')} FROM events",
        "partition_columns_orders": f"""SELECT o_orderkey, o_orderdate,
            {_DAY.format('o_orderdate')} FROM orders""",
        "dedupe_baggage": f"WITH {_MATCHED} SELECT * FROM bags",
        "dedupe_passenger": f"WITH {_MATCHED} SELECT * FROM pax",
        "interval_join_scans": matched,
        "interval_join_hot_keys": _CROWDED,
        "stream_interval_join_hot_keys": _CROWDED,
        "interval_join_shipments": """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
            l_shipdate, o_orderdate, o_orderpriority
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             AND l_shipdate BETWEEN o_orderdate - INTERVAL 30 DAY AND o_orderdate + INTERVAL 90 DAY""",
        "silver_tracking": silver,
        "late_flag_boundary": """WITH boarded AS (
              SELECT event_id, ts AS passenger_time, unnest([0, 59999999, 60000000, 60500000,
                61000000, -60000000, NULL]::BIGINT[]) AS offset_micros FROM events),
            scanned AS (SELECT *, passenger_time + to_microseconds(offset_micros) AS baggage_time
              FROM boarded)
            SELECT *, round(date_diff('second', passenger_time, baggage_time) / 60.0::DOUBLE, 6)
                AS scan_to_board_interval_minutes,
              coalesce(date_diff('second', passenger_time, baggage_time) > 60, false)
                AS is_late_baggage_scan
            FROM scanned""",
        "gold_performance": gold,
        "gold_ranked": f"""{gold} ORDER BY baggage_mishandle_rate_percentage DESC,
            flight_number, passenger_gate""",
        "check_not_null_silver": f"""WITH {_SILVER} SELECT pnr_locator, bag_tag_number, baggage_time
            FROM ({_DAMAGED} silver) WHERE pnr_locator IS NULL""",
        "check_not_null_messages": f"""WITH {_EVENTS} SELECT event_id, pnr_locator, flight_number
            FROM decoded WHERE is_bag AND pnr_locator IS NULL""",
        "check_relationship_silver": f"""WITH {_SILVER} SELECT {unmatched}
            FROM silver ANTI JOIN bronze USING (pnr_locator)""",
        "check_relationship_conformed": f"""WITH {_SILVER} SELECT {unmatched} FROM silver s
            WHERE NOT EXISTS (SELECT 1 FROM bronze b
              WHERE b.day <= 15 AND upper(trim(b.pnr_locator, ' ')) = s.pnr_locator)""",
        "check_relationship_documents": """SELECT doc_id, count(*) AS failing_rows
            FROM documents ANTI JOIN labels USING (doc_id)
            WHERE doc_id IS NOT NULL GROUP BY doc_id""",
        "check_accepted_values_late_flag": f"""WITH {_SILVER}
            SELECT is_late_baggage_scan, count(*) AS failing_rows FROM silver
            WHERE is_late_baggage_scan NOT IN (false) GROUP BY 1""",
        "check_accepted_values_orders": """SELECT o_orderstatus, count(*) AS failing_rows FROM orders
            WHERE o_orderstatus NOT IN ('F', 'P') GROUP BY 1""",
        "check_not_null_gold": f"""WITH {_SILVER}, lost AS ({_DAMAGED} silver)
            SELECT flight_number, passenger_gate, count(DISTINCT bag_tag_number) AS total_bags_tracked
            FROM lost WHERE flight_number IS NULL GROUP BY ALL""",
        "check_report": _report(),
        "file_round_trip": _dead(True),
        "partition_pruned_read": f"""SELECT error_reason, year, month, day,
            count(*) AS dead_letters FROM ({_dead(False)})
            WHERE year = 2024 AND month = 1 AND day <= 15 GROUP BY ALL""",
        "columns_by_name": """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
            CAST(NULL AS VARCHAR) AS absent FROM events""",
        "incremental_bronze": bronze,
        "declared_table": bronze,
        "full_rebuild": silver,
        "failed_rebuild": silver,
        "gold_from_parts": gold,
        "killed_rebuild": f"WITH {_SILVER} {_side_by_side('after the kill', 'day <= 15')}"
        f" UNION ALL {_side_by_side('after the next run', 'true')}",
        "retained_snapshots": f"""WITH {_SILVER} SELECT CAST(snapshot AS INTEGER) AS snapshot, count(*) AS silver_rows,
            CAST(2 AS INTEGER) AS versions
            FROM silver JOIN (VALUES (3, 21), (4, 31)) AS kept(snapshot, last_day) ON day <= last_day GROUP BY snapshot""",
        "compacted_silver": f"""WITH {_SILVER} SELECT state, year, month, day, count(*) AS n_rows,
            count(DISTINCT bag_tag_number) AS bags, true AS bounded
            FROM silver CROSS JOIN (VALUES ('before'), ('after')) AS s(state) GROUP BY state, year, month, day""",
        "backdated_arrival": bronze,
        "killed_load": bronze,
        "published_tables": gold,
        "stream_dedupe": f"WITH {_MATCHED} SELECT * FROM bags",
        "stream_interval_join": matched,
        "stream_interval_join_resumed": matched,
        "stream_hot_keys_learnt": matched.replace(
            "FROM events e",
            """FROM (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 AND day(ts) > 10 THEN 25 ELSE user_id END AS user_id)
              FROM events) e""",
        ),
        "stream_idle_input": f"WITH {_MATCHED} SELECT * FROM matched WHERE day(passenger_time) <= 15",
        "stream_late_rows": f"""WITH {_EVENTS} SELECT DISTINCT {_BAG} FROM judged
            WHERE is_bag AND ok AND NOT (day(event_timestamp) <= 10 AND user_id % 20 = 7)""",
        "stream_dead_letter_baggage": _dead(True),
        "stream_dead_letter_passenger": _dead(False),
        "stream_shared_split": f"""WITH {_EVENTS}, dated AS (
              SELECT CASE WHEN ok THEN 'valid' ELSE 'dead' END AS output, {_DAY_OF_EVENT}
              FROM judged WHERE NOT is_bag)
            SELECT output, year, month, day, count(*) AS messages FROM dated GROUP BY ALL""",
        "replayed_messages": bronze.replace(
            "AND lower(pnr_locator) <> 'unknown', false) AS ok",
            "AND lower(pnr_locator) <> 'unknown' OR length(pnr_locator) = 7, false) AS ok",
        ),
        "killed_split": f"""WITH {_EVENTS}, dated AS (
              SELECT CASE WHEN ok THEN 'valid' ELSE 'dead' END AS output, {_DAY_OF_EVENT}
              FROM judged WHERE NOT is_bag)
            SELECT state, output, year, month, day, count(*) AS messages
            FROM dated JOIN (VALUES ('after the kill', 15), ('after the next run', 31)) AS kept(state, last_day)
              ON day <= last_day GROUP BY ALL""",
        "end_to_end": gold,
        "end_to_end_read_once": gold,
    }
