"""The registered queries: each takes a session and a table folder and returns a DataFrame."""

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, StructField, StructType, StringType, TimestampType

from scanweave.constants import BAGGAGE, DATE_PARTS, EVENT_TIME, MATCH_KEYS, PASSENGER
from scanweave.functions import padded
from scanweave.operators import quality
from scanweave.operators.contract import STRICT_CONTRACT, Contract, summarise_dead_letters
from scanweave.operators.dedupe import drop_repeats
from scanweave.operators.interval_join import hot_keys, interval_join, match_scans
from scanweave.operators.tables import performance, ranked, tracking, with_date_parts, with_lateness
from scanweave.plans import batch_run, derived, incremental, replay
from scanweave.schemas import (
    BAGGAGE_EVENT,
    BRONZE,
    DATE_PART_FIELDS,
    dead_letter_schema,
)
from scanweave.session import prepare, scratch_folder, session_conf
from scanweave.sources import compaction, files, loads, snapshots, tables
from scanweave.sources.messages import decode_events, text_messages
from scanweave.streaming.monitor import await_all
from scanweave.streaming.sinks import ONCE, deal_pairs, read_committed, start_partitioned_sink, start_shared_split, write_dated
from scanweave.streaming.tracking import (
    TrackingSettings,
    ingest,
    start_landed_match,
    start_shared_ingest,
    start_tracking,
)

Query = Callable[[SparkSession, str], DataFrame]
_REGISTERED: dict[str, Query] = {}

# Scan-minus-boarding offsets around the lateness limit, in microseconds.
_BOUNDARY_OFFSETS = (0, 59_999_999, 60_000_000, 60_500_000, 61_000_000, -60_000_000)


def comparable(df: DataFrame) -> DataFrame:
    """Zone-less times and plain doubles, so that values compare across engines."""
    plain = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, TimestampType):
            plain[field.name] = F.col(field.name).cast("timestamp_ntz")
        elif isinstance(field.dataType, DecimalType):
            plain[field.name] = F.col(field.name).cast("double")
    return df.withColumns(plain) if plain else df


def registered(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(query(prepare(spark), folder))

    _REGISTERED[query.__name__] = run
    return query


def all_queries() -> dict[str, Query]:
    return dict(_REGISTERED)


# --- shared relations ---------------------------------------------------------------------------


def _split(spark, folder, kind):
    return ingest(derived.messages(derived.events(spark, folder), kind), kind)


def _matched(spark, folder, **options):
    events = derived.events(spark, folder)
    valid = [ingest(derived.messages(events, kind), kind).valid for kind in (BAGGAGE, PASSENGER)]
    return match_scans(*valid, **options)


def _bronze(spark, folder):
    return with_date_parts(_matched(spark, folder), "baggage_time")


def _silver(spark, folder):
    return tracking(_bronze(spark, folder))


def _dead(spark, folder, kind):
    return with_date_parts(_split(spark, folder, kind).dead, EVENT_TIME)


def _stored_bronze(spark, base, folder):
    path = f"{base}/bronze"
    tables.write_partitioned(_bronze(spark, folder), path)
    return tables.read_declared(spark, path, BRONZE)


def _state_partitions(spark):
    return spark.sparkContext.defaultParallelism


# --- decoding and contract ----------------------------------------------------------------------


@registered
def json_decode(spark, folder):
    parsed = F.from_json("props", "k bigint")
    return derived.events(spark, folder).select("event_id", parsed["k"].alias("k"))


def _decoded(spark, folder, kind):
    return decode_events(derived.messages(derived.events(spark, folder), kind), kind)


@registered
def message_decode_baggage(spark, folder):
    return _decoded(spark, folder, BAGGAGE)


@registered
def message_decode_passenger(spark, folder):
    return _decoded(spark, folder, PASSENGER)


@registered
def contract_valid_baggage(spark, folder):
    return _split(spark, folder, BAGGAGE).valid


@registered
def contract_valid_passenger(spark, folder):
    return _split(spark, folder, PASSENGER).valid


@registered
def contract_dead_letter_baggage(spark, folder):
    return _dead(spark, folder, BAGGAGE)


@registered
def contract_dead_letter_passenger(spark, folder):
    return _dead(spark, folder, PASSENGER)


@registered
def contract_foreign_json(spark, folder):
    """JSON of another shape: no declared field is found, every message is a dead letter."""
    foreign = derived.events(spark, folder).select(F.col("props").alias("value"))
    return ingest(foreign, BAGGAGE, keep_raw=True).dead


@registered
def contract_malformed_text(spark, folder):
    """Whole documents as messages: none is JSON, each is quarantined with its text."""
    texts = spark.read.parquet(f"{folder}/documents.parquet").select(F.col("text").alias("value"))
    return ingest(texts, PASSENGER, keep_raw=True).dead


@registered
def contract_missing_time(spark, folder):
    """Order messages under the strict contract; pending orders have no event time."""
    locator = F.concat(F.lit("C"), padded("o_custkey", 5))
    time = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", derived.ISO_MICROS))
    body = F.struct(
        F.col("o_orderkey").cast("string").alias("event_id"),
        locator.alias("pnr_locator"),
        F.coalesce(time, F.lit("pending")).alias("event_timestamp"),
        F.col("o_orderpriority").alias("gate_id"),
    )
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    return ingest(orders.select(F.to_json(body).alias("value")), PASSENGER, STRICT_CONTRACT).dead


@registered
def dead_letter_summary(spark, folder):
    both = _dead(spark, folder, BAGGAGE).select("error_reason", *DATE_PARTS).unionByName(
        _dead(spark, folder, PASSENGER).select("error_reason", *DATE_PARTS)
    )
    return summarise_dead_letters(both)


@registered
def partition_columns_events(spark, folder):
    return with_date_parts(derived.events(spark, folder).select("event_id", "ts"), "ts")


@registered
def partition_columns_orders(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    return with_date_parts(orders.select("o_orderkey", "o_orderdate"), "o_orderdate")


# --- dedupe and join ----------------------------------------------------------------------------


@registered
def dedupe_baggage(spark, folder):
    return drop_repeats(_split(spark, folder, BAGGAGE).valid)


@registered
def dedupe_passenger(spark, folder):
    return drop_repeats(_split(spark, folder, PASSENGER).valid)


@registered
def interval_join_scans(spark, folder):
    return _matched(spark, folder)


def _crowded(valid):
    """A third of the events under one locator and flight, at every size of the table."""
    crowd = F.pmod(F.col("event_id").cast("long"), F.lit(3)) == 0
    return valid.withColumns(
        {
            name: F.when(crowd, F.lit(value)).otherwise(F.col(name))
            for name, value in zip(MATCH_KEYS, ("CROWD1", "AC800"))
        }
    )


@registered
def interval_join_hot_keys(spark, folder):
    """A join with a passenger who holds a third of both sides, dealt over a grid of lanes."""
    scans, boardings = (_crowded(_split(spark, folder, kind).valid) for kind in (BAGGAGE, PASSENGER))
    hot = hot_keys(scans, MATCH_KEYS, 0.1)
    return match_scans(scans, boardings, hot=hot, spread=4, spread_right=3, blocks=True)


@registered
def interval_join_shipments(spark, folder):
    """Line items shipped from 30 days before to 90 days after their order's date."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority"
    )
    items = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"
    )
    return interval_join(
        items,
        orders,
        keys=["l_orderkey"],
        left_time="l_shipdate",
        right_time="o_orderdate",
        before=timedelta(days=30),
        after=timedelta(days=90),
    )


# --- cleansed and performance tables ------------------------------------------------------------


@registered
def silver_tracking(spark, folder):
    return _silver(spark, folder)


@registered
def late_flag_boundary(spark, folder):
    """Every event as a boarding with scans around the limit, and one boarding without a scan time."""
    offsets = F.array(*(F.lit(micros) for micros in _BOUNDARY_OFFSETS), F.lit(None)).cast("array<long>")
    boarded = derived.events(spark, folder).select(
        "event_id",
        F.col("ts").cast("timestamp").alias("passenger_time"),
        F.explode(offsets).alias("offset_micros"),
    )
    scanned = F.timestamp_micros(F.unix_micros("passenger_time") + F.col("offset_micros"))
    return with_lateness(boarded.withColumn("baggage_time", scanned))


@registered
def gold_performance(spark, folder):
    return performance(_silver(spark, folder))


@registered
def gold_ranked(spark, folder):
    return ranked(performance(_silver(spark, folder)))


# --- checks -------------------------------------------------------------------------------------


def _damaged(silver):
    """Silver as a faulty run could leave it: some locators and gates lost."""
    return silver.withColumns(
        {
            "pnr_locator": F.when(~F.col("bag_tag_number").endswith("0"), F.col("pnr_locator")),
            "flight_number": F.when(F.col("flight_number") != "AC109", F.col("flight_number")),
        }
    )


@registered
def check_not_null_silver(spark, folder):
    silver = {"silver": _damaged(_silver(spark, folder))}
    missing = quality.NotNull("silver", "pnr_locator").failing(silver)
    return missing.select("pnr_locator", "bag_tag_number", "baggage_time")


@registered
def check_not_null_messages(spark, folder):
    """The same check on decoded messages, where locators are missing."""
    decoded = {"messages": _decoded(spark, folder, BAGGAGE)}
    missing = quality.NotNull("messages", "pnr_locator").failing(decoded)
    return missing.select("event_id", "pnr_locator", "flight_number")


@registered
def check_relationship_silver(spark, folder):
    bronze = _stored_bronze(spark, scratch_folder(spark, "relationship"), folder)
    check = quality.Relationship("silver", "pnr_locator", "bronze", "pnr_locator")
    failing = check.failing({"silver": tracking(bronze), "bronze": bronze})
    return failing.select("pnr_locator", "bag_tag_number", "baggage_time", "passenger_time")


@registered
def check_relationship_conformed(spark, folder):
    """Against parent values conformed like the child; the parents lack the month's second half."""
    bronze = _stored_bronze(spark, scratch_folder(spark, "relationship"), folder)
    check = quality.Relationship(
        "silver", "pnr_locator", "bronze", "pnr_locator", conform=quality.CONFORMED_LOCATOR
    )
    failing = check.failing({"silver": tracking(bronze), "bronze": bronze.filter("day <= 15")})
    return failing.select("pnr_locator", "bag_tag_number", "baggage_time", "passenger_time")


@registered
def check_relationship_documents(spark, folder):
    """Documents no label refers to, as failing child values with their row counts."""
    relations = {
        "documents": spark.read.parquet(f"{folder}/documents.parquet"),
        "labels": spark.read.parquet(f"{folder}/labels.parquet"),
    }
    return quality.Relationship("documents", "doc_id", "labels", "doc_id").failing_values(relations)


@registered
def check_accepted_values_late_flag(spark, folder):
    """Late flags where only punctual scans are accepted."""
    silver = {"silver": _silver(spark, folder)}
    return quality.AcceptedValues("silver", "is_late_baggage_scan", (False,)).failing(silver)


@registered
def check_accepted_values_orders(spark, folder):
    """Order states outside the closed ones, with their row counts."""
    orders = {"orders": spark.read.parquet(f"{folder}/orders.parquet")}
    return quality.AcceptedValues("orders", "o_orderstatus", ("F", "P")).failing(orders)


@registered
def check_not_null_gold(spark, folder):
    """Indicators of a silver table that has lost some flights."""
    gold = {"gold": performance(_damaged(_silver(spark, folder)))}
    flights = quality.NotNull("gold", "flight_number").failing(gold)
    bags = quality.NotNull("gold", "total_bags_tracked").failing(gold)
    wanted = ["flight_number", "passenger_gate", "total_bags_tracked"]
    return flights.select(*wanted).unionByName(bags.select(*wanted))


@registered
def check_report(spark, folder):
    base = scratch_folder(spark, "check-report")
    bronze = _stored_bronze(spark, base, folder)
    return batch_run.build_tables(bronze, f"{base}/silver", f"{base}/gold").report


# --- files and tables ---------------------------------------------------------------------------


@registered
def file_round_trip(spark, folder):
    path = f"{scratch_folder(spark, 'round-trip')}/dead"
    tables.write_partitioned(_dead(spark, folder, BAGGAGE), path)
    return tables.read_declared(spark, path, dead_letter_schema(BAGGAGE))


@registered
def partition_pruned_read(spark, folder):
    """One reason and half a month of the quarantine; other days' folders are not opened."""
    path = f"{scratch_folder(spark, 'pruned')}/dead"
    tables.write_partitioned(_dead(spark, folder, PASSENGER), path)
    stored = tables.read_declared(spark, path, dead_letter_schema(PASSENGER))
    return summarise_dead_letters(stored.filter("year = 2024 AND month = 1 AND day <= 15"))


@registered
def columns_by_name(spark, folder):
    """Files whose columns differ in case and number from the declared schema."""
    path = f"{scratch_folder(spark, 'by-name')}/events"
    derived.events(spark, folder).select(
        F.col("event_id").cast("string").alias("EVENT_ID"),
        F.col("event_type").cast("binary").alias("Event_Type"),
        F.col("value").alias("undeclared"),
    ).write.parquet(path)
    declared = StructType(
        [StructField(name, StringType()) for name in ("event_id", "event_type", "absent")]
    )
    return tables.read_declared(spark, path, declared)


@registered
def incremental_bronze(spark, folder):
    """Two arrivals, three loads: each file is loaded once, the last load finds nothing."""
    lake = batch_run.Lake(scratch_folder(spark, "incremental"))
    matched = tables.rebuild(_bronze(spark, folder), f"{lake.base}/matched")
    early = F.col("day") <= 15
    for arrival in (matched.filter(early), matched.filter(~early)):
        tables.write_partitioned(arrival, lake.landed)
        batch_run.load_bronze(spark, lake)
    return batch_run.load_bronze(spark, lake)


@registered
def declared_table(spark, folder):
    """A described table, declared before the files it holds are loaded, and read by name."""
    lake = batch_run.Lake(scratch_folder(spark, "declared"))
    tables.write_partitioned(_bronze(spark, folder), lake.landed)
    return batch_run.load_bronze(spark, lake, name="bronze_" + lake.base.rsplit("-", 1)[-1])


@registered
def full_rebuild(spark, folder):
    """Silver rebuilt twice in place: the second run replaces the first."""
    base = scratch_folder(spark, "rebuild")
    bronze = _stored_bronze(spark, base, folder)
    for _ in range(2):
        silver = tables.rebuild(tracking(bronze), f"{base}/silver", partition_by=DATE_PARTS)
    return silver


@registered
def published_tables(spark, folder):
    """All six checks before publication; gold is read through its name as a later session finds it."""
    lake = batch_run.Lake(scratch_folder(spark, "published"))
    bronze = _stored_bronze(spark, lake.base, folder)
    token = lake.base.rsplit("-", 1)[-1]
    checks = quality.published_checks(quality.CONFORMED_LOCATOR)
    batch_run.run_batch_published(bronze, lake, f"silver_{token}", f"gold_{token}", checks)
    spark.sql(f"DROP VIEW gold_{token}")
    tables.attach(spark, lake.names)
    return spark.table(f"gold_{token}")


@registered
def failed_rebuild(spark, folder):
    """A run whose checks fail, after one that passed: readers keep the first run's silver."""
    lake = batch_run.Lake(scratch_folder(spark, "failed-rebuild"))
    bronze = _stored_bronze(spark, lake.base, folder)
    batch_run.run_batch(bronze, lake, quality.published_checks(quality.CONFORMED_LOCATOR))
    try:
        batch_run.run_batch(bronze.filter("day > 15"), lake, [quality.AcceptedValues("gold", "flight_number", ())])
    except quality.QualityGateError:
        return tables.read_current(spark, lake.silver)
    raise AssertionError("the second run should have failed its check")


class _Killed(RuntimeError):
    """Ends a job where a query wants it to end."""


def _side_by_side(spark, lake, state):
    """Late rows and bags per gate by silver itself and by gold, both as one snapshot names them."""
    at = snapshots.snapshot(spark, lake.base)
    keys = ["flight_number", "passenger_gate"]
    silver = tables.read_current(spark, lake.silver, at=at).groupBy(*keys).agg(
        F.count_distinct("bag_tag_number").alias("silver_bags"), F.count_if("is_late_baggage_scan").alias("silver_late")
    )
    gold = tables.read_current(spark, lake.gold, at=at).select(
        *keys, F.col("total_bags_tracked").alias("gold_bags"), F.col("total_late_bags").alias("gold_late")
    )
    return silver.join(gold, keys, "full").withColumn("state", F.lit(state))


@registered
def killed_rebuild(spark, folder):
    """Silver and gold as readers find them after a run that ends between its tables and their commit, and after
    the next run: both times both tables are of one run."""
    lake = batch_run.Lake(scratch_folder(spark, "killed-rebuild"))
    bronze = _stored_bronze(spark, lake.base, folder)
    checks = quality.published_checks(quality.CONFORMED_LOCATOR)
    batch_run.run_batch(bronze.filter("day <= 15"), lake, checks)
    batch_run.build_tables(bronze, lake.silver, lake.gold, checks)  # both are written, neither is current
    killed = _side_by_side(spark, lake, "after the kill")
    batch_run.run_batch(bronze, lake, checks)
    return killed.unionByName(_side_by_side(spark, lake, "after the next run"))


@registered
def retained_snapshots(spark, folder):
    """Rows of silver per snapshot after four runs that keep two: the versions of the first two are gone."""
    lake = batch_run.Lake(scratch_folder(spark, "retained"))
    bronze = _stored_bronze(spark, lake.base, folder)
    checks = quality.published_checks(quality.CONFORMED_LOCATOR)
    for day in (7, 14, 21, 31):
        batch_run.run_batch(bronze.filter(F.col("day") <= day), lake, checks, keep=2)
    found = []
    for number in snapshots.numbers(spark, lake.base):
        at = snapshots.snapshot(spark, lake.base, number)
        rows = tables.read_current(spark, lake.silver, at=at).agg(F.count("*").alias("silver_rows"))
        versions = len(files.names(spark, lake.silver))
        found.append(rows.select(F.lit(number).alias("snapshot"), "silver_rows", F.lit(versions).alias("versions")))
    return reduce(DataFrame.unionByName, found)


@registered
def compacted_silver(spark, folder):
    """Rows and files of silver per day, in the snapshot before its small files were packed, read after it, and in the one
    after it. The table was written with up to eight files a day."""
    lake = batch_run.Lake(scratch_folder(spark, "compacted"))
    silver = tracking(_stored_bronze(spark, lake.base, folder))
    dealt = silver.repartition(8, "pnr_locator", "bag_tag_number", "baggage_time")
    tables.make_current(spark, tables.stage(dealt, lake.silver, DATE_PARTS))
    before = snapshots.snapshot(spark, lake.base)
    compaction.compact(spark, lake.silver, most_left=0.99)
    after = snapshots.snapshot(spark, lake.base)
    found = []
    for state, at in (("before", before), ("after", after)):
        rows = tables.read_current(spark, lake.silver, at=at).groupBy(*DATE_PARTS).agg(
            F.count("*").alias("n_rows"), F.count_distinct("bag_tag_number").alias("bags")
        )
        listed = compaction.file_listing(spark, lake.silver, at).groupBy("slice").agg(F.count("*").alias("files"))
        held = rows.withColumn("slice", tables.slice_label()).join(listed, "slice")
        one_file = (F.col("files") == 1) if state == "after" else (F.col("files") <= 8)
        found.append(held.select(F.lit(state).alias("state"), *DATE_PARTS, "n_rows", "bags", one_file.alias("bounded")))
    return reduce(DataFrame.unionByName, found)


@registered
def killed_load(spark, folder):
    """Two arrivals; the load of the second is killed once its rows are staged and some of them moved. The next load
    completes it: every file is in bronze once."""
    lake = batch_run.Lake(scratch_folder(spark, "killed-load"))
    matched = tables.rebuild(_bronze(spark, folder), f"{lake.base}/matched")
    early = F.col("day") <= 15
    tables.write_partitioned(matched.where(early), lake.landed)
    batch_run.load_bronze(spark, lake)
    tables.write_partitioned(matched.where(~early), lake.landed)

    def killed(*given):
        loads.move_files(*given)
        raise _Killed("between the move and the ledger")

    try:
        loads.load_listed_files(spark, lake.landed, lake.bronze, lake.load_ledger, BRONZE, move=killed)
    except _Killed:
        return batch_run.load_bronze(spark, lake)
    raise AssertionError("the load should have been killed")


@registered
def gold_from_parts(spark, folder):
    """Gold after a day that arrives late and more rows for a day that is there: two days of thirty are worked out again."""
    lake = batch_run.Lake(scratch_folder(spark, "gold-parts"))
    matched = tables.rebuild(_bronze(spark, folder), f"{lake.base}/matched")
    later = (F.col("day") == 10) | ((F.col("day") == 20) & (F.hour("baggage_time") >= 12))
    tables.write_partitioned(matched.where(~later), lake.bronze)
    incremental.refresh_gold(spark, lake)
    tables.write_partitioned(matched.where(later), lake.bronze)
    return incremental.refresh_gold(spark, lake).gold


@registered
def backdated_arrival(spark, folder):
    """Files that arrive with times long before those already loaded are loaded all the same."""
    lake = batch_run.Lake(scratch_folder(spark, "backdated"))
    matched = tables.rebuild(_bronze(spark, folder), f"{lake.base}/matched")
    early = F.col("day") <= 15
    tables.write_partitioned(matched.filter(early), lake.landed)
    batch_run.load_bronze(spark, lake)
    tables.write_partitioned(matched.filter(~early), f"{lake.base}/delayed")
    files.move_backdated(spark, f"{lake.base}/delayed", lake.landed, timedelta(days=4015))
    batch_run.load_bronze(spark, lake)
    return tables.read_declared(spark, lake.bronze, BRONZE)


# --- streams ------------------------------------------------------------------------------------


def _stream_messages(spark, folder, kind):
    return derived.messages(derived.stream_events(spark, folder), kind)


def _drained(spark, stream, time_column, base, schema):
    """Run a stream over everything there is now and return what its sink holds. Without a time column it has its date parts."""
    with session_conf(spark, spark__sql__shuffle__partitions=str(_state_partitions(spark))):
        query = start_partitioned_sink(
            with_date_parts(stream, time_column) if time_column else stream, f"{base}/out", f"{base}/checkpoint", trigger=ONCE
        )
    await_all([query])
    return tables.read_declared(spark, f"{base}/out", schema)


_dated_pairs = deal_pairs("baggage_time")


def _dated(schema):
    return StructType(schema.fields + DATE_PART_FIELDS)


@registered
def stream_dedupe(spark, folder):
    valid = ingest(_stream_messages(spark, folder, BAGGAGE), BAGGAGE).valid
    base = scratch_folder(spark, "stream-dedupe")
    kept = _drained(spark, drop_repeats(valid), EVENT_TIME, base, _dated(BAGGAGE_EVENT))
    return kept.drop(*DATE_PARTS)


@registered
def stream_interval_join(spark, folder):
    valid = [
        ingest(_stream_messages(spark, folder, kind), kind).valid for kind in (BAGGAGE, PASSENGER)
    ]
    base = scratch_folder(spark, "stream-join")
    matched = _drained(spark, match_scans(*valid, deal=_dated_pairs), None, base, BRONZE)
    return matched.drop(*DATE_PARTS)


@registered
def stream_interval_join_hot_keys(spark, folder):
    """The stream join with a passenger who holds a third of both sides, dealt over a grid of lanes."""
    scans = _crowded(_split(spark, folder, BAGGAGE).valid)
    hot = hot_keys(scans, MATCH_KEYS, 0.1)
    valid = [
        _crowded(ingest(_stream_messages(spark, folder, kind), kind).valid)
        for kind in (BAGGAGE, PASSENGER)
    ]
    base = scratch_folder(spark, "stream-hot")
    joined = match_scans(*valid, hot=hot, spread=2, spread_right=2, deal=_dated_pairs)
    return _drained(spark, joined, None, base, BRONZE).drop(*DATE_PARTS)


def _arrive(rows, base, kind):
    """Add rows, as message text, to the files a text stream of this kind reads."""
    derived.messages(rows, kind).write.mode("append").text(f"{base}/{kind.lower()}")


@registered
def stream_late_rows(spark, folder):
    """Two runs on one checkpoint. Some early events arrive with the second run only: they are
    behind the watermark of the first and are dropped."""
    base = scratch_folder(spark, "stream-late")
    events = derived.events(spark, folder)
    early = F.dayofmonth("ts") <= 15
    delayed = (F.dayofmonth("ts") <= 10) & (F.pmod("user_id", F.lit(20)) == 7)
    for arrival in (events.filter(early & ~delayed), events.filter(~early | delayed)):
        _arrive(arrival, base, BAGGAGE)
        valid = ingest(text_messages(spark, f"{base}/baggage"), BAGGAGE).valid
        kept = _drained(spark, drop_repeats(valid), EVENT_TIME, base, _dated(BAGGAGE_EVENT))
    return kept.drop(*DATE_PARTS)


@registered
def stream_interval_join_resumed(spark, folder):
    """The join over two arrivals: the second run matches against state the first one kept."""
    base = scratch_folder(spark, "stream-resumed")
    events = derived.events(spark, folder)
    early = F.dayofmonth("ts") <= 15
    for arrival in (events.filter(early), events.filter(~early)):
        valid = []
        for kind in (BAGGAGE, PASSENGER):
            _arrive(arrival, base, kind)
            valid.append(ingest(text_messages(spark, f"{base}/{kind.lower()}"), kind).valid)
        matched = _drained(spark, match_scans(*valid, deal=_dated_pairs), None, base, BRONZE)
    return matched.drop(*DATE_PARTS)


def _stream_dead(spark, folder, kind):
    dead = ingest(_stream_messages(spark, folder, kind), kind).dead
    base = scratch_folder(spark, "stream-dead")
    return _drained(spark, dead, EVENT_TIME, base, dead_letter_schema(kind))


@registered
def stream_dead_letter_baggage(spark, folder):
    return _stream_dead(spark, folder, BAGGAGE)


@registered
def stream_dead_letter_passenger(spark, folder):
    return _stream_dead(spark, folder, PASSENGER)


@registered
def stream_shared_split(spark, folder):
    """Rows per output of a stream that is read and parsed once for both."""
    base = scratch_folder(spark, "shared-split")
    query = start_shared_split(
        _stream_messages(spark, folder, PASSENGER),
        PASSENGER,
        f"{base}/valid",
        f"{base}/dead",
        f"{base}/checkpoint",
        trigger=ONCE,
    )
    await_all([query])
    counted = []
    for output in ("valid", "dead"):
        rows = tables.read_declared(spark, f"{base}/{output}", dead_letter_schema(PASSENGER))
        counted.append(rows.groupBy(*DATE_PARTS).count().withColumn("output", F.lit(output)))
    return counted[0].unionByName(counted[1]).withColumnRenamed("count", "messages")


@registered
def stream_idle_input(spark, folder):
    """Boardings stop at mid-month while scans go on. Scans move the watermark of the silent input, so boardings of the days
    since, which arrive after that, are late and match nothing."""
    base = scratch_folder(spark, "stream-idle")
    events, day = derived.events(spark, folder), F.dayofmonth("ts")
    arrivals = [
        {BAGGAGE: day <= 15, PASSENGER: day <= 15},
        {BAGGAGE: day > 15, PASSENGER: F.lit(False)},
        {BAGGAGE: F.lit(False), PASSENGER: (day > 15) & (day <= 25)},
    ]
    for arrival in arrivals:
        valid = []
        for kind, here in arrival.items():
            _arrive(events.where(here), base, kind)
            valid.append(ingest(text_messages(spark, f"{base}/{kind.lower()}"), kind).valid)
        joined = match_scans(*valid, idle_after=timedelta(hours=6), deal=_dated_pairs)
        matched = _drained(spark, joined, None, base, BRONZE)
    return matched.drop(*DATE_PARTS)


@registered
def stream_hot_keys_learnt(spark, folder):
    """Three arrivals; from the second on a passenger holds a third of both sides. The job finds out while it runs, and deals
    that passenger's scans from the next epoch on."""
    lake = batch_run.Lake(scratch_folder(spark, "learnt"))
    settings = replace(_tracking_settings(spark, lake), learn_share=0.1, spread=4)
    crowd = (F.pmod("event_id", F.lit(3)) == 0) & (F.dayofmonth("ts") > 10)
    events = derived.events(spark, folder).withColumn("user_id", F.when(crowd, F.lit(25)).otherwise(F.col("user_id")))
    day = F.dayofmonth("ts")
    for arrival in (day <= 10, (day > 10) & (day <= 20), day > 20):
        for kind in (BAGGAGE, PASSENGER):
            _arrive(events.where(arrival), lake.base, kind)
        sources = [text_messages(spark, f"{lake.base}/{kind.lower()}") for kind in (BAGGAGE, PASSENGER)]
        await_all(start_shared_ingest(*sources, settings).values())
        await_all([start_landed_match(spark, settings)])
    return tables.read_declared(spark, settings.valid_path, BRONZE).drop(*DATE_PARTS)


@registered
def replayed_messages(spark, folder):
    """Bronze after quarantined messages were decoded again under a contract that takes locators of seven characters,
    twice: the second replay finds nothing left."""
    lake = batch_run.Lake(scratch_folder(spark, "replay"))
    settings = replace(_tracking_settings(spark, lake), keep_raw=True)
    streams = (_stream_messages(spark, folder, kind) for kind in (BAGGAGE, PASSENGER))
    await_all(start_shared_ingest(*streams, settings).values())
    await_all([start_landed_match(spark, settings)])
    batch_run.load_bronze(spark, lake)
    later = Contract(length=7, placeholders=("",))
    for _ in range(2):
        replay.replay(spark, settings, later)
    return batch_run.load_bronze(spark, lake)


@registered
def killed_split(spark, folder):
    """Messages per output as readers find them after a batch that ends between its two writes, and after the next run:
    first the batch is in neither output, then it is complete in both."""
    base = scratch_folder(spark, "killed-split")
    commits, early = f"{base}/commits", F.dayofmonth("ts") <= 15
    events = derived.events(spark, folder)

    def run(write=write_dated):
        messages = text_messages(spark, f"{base}/passenger")
        outputs = (f"{base}/valid", f"{base}/dead", f"{base}/checkpoint")
        await_all([start_shared_split(messages, PASSENGER, *outputs, trigger=ONCE, commits=commits, write=write)])

    def killed(rows, path):
        if "/valid/" in path:
            raise _Killed("between the writes")
        write_dated(rows, path)

    def found(state):
        for output in ("valid", "dead"):
            rows = read_committed(spark, f"{base}/{output}", commits, dead_letter_schema(PASSENGER))
            counted = rows.groupBy(*DATE_PARTS).agg(F.count("*").alias("messages"))
            yield counted.withColumns({"output": F.lit(output), "state": F.lit(state)})

    _arrive(events.where(early), base, PASSENGER)
    run()
    _arrive(events.where(~early), base, PASSENGER)
    try:
        run(killed)
    except StreamingQueryException:
        # Written down now: what is read later would be what the next run leaves.
        before = tables.rebuild(reduce(DataFrame.unionByName, found("after the kill")), f"{base}/found")
    else:
        raise AssertionError("the batch should have ended between its writes")
    run()
    return reduce(DataFrame.unionByName, [before, *found("after the next run")])


def _tracking_settings(spark, lake):
    return TrackingSettings(
        base=lake.base,
        checkpoints=f"{lake.base}/checkpoints",
        trigger=ONCE,
        state_partitions=_state_partitions(spark),
    )


@registered
def end_to_end(spark, folder):
    """Streams to landed files and dead letters, files to bronze, bronze to silver and gold."""
    lake = batch_run.Lake(scratch_folder(spark, "end-to-end"))
    started = start_tracking(
        _stream_messages(spark, folder, BAGGAGE),
        _stream_messages(spark, folder, PASSENGER),
        _tracking_settings(spark, lake),
    )
    await_all(started.values())
    bronze = batch_run.load_bronze(spark, lake)
    return batch_run.build_tables(bronze, lake.silver, lake.gold).gold


@registered
def end_to_end_read_once(spark, folder):
    """The same flow with each stream read and parsed once for valid rows and dead letters."""
    lake = batch_run.Lake(scratch_folder(spark, "read-once"))
    settings = _tracking_settings(spark, lake)
    split = start_shared_ingest(
        _stream_messages(spark, folder, BAGGAGE),
        _stream_messages(spark, folder, PASSENGER),
        settings,
    )
    await_all(split.values())
    await_all([start_landed_match(spark, settings)])
    bronze = batch_run.load_bronze(spark, lake)
    return batch_run.build_tables(bronze, lake.silver, lake.gold).gold
