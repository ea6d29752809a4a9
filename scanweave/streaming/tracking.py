"""The tracking job: two event streams to matched rows and two dead-letter folders."""

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from scanweave.constants import (
    BAGGAGE,
    BAGGAGE_DEAD_FOLDER,
    EVENT_TIME,
    LATENESS,
    MATCH_KEYS,
    PASSENGER,
    PASSENGER_DEAD_FOLDER,
    VALID_FOLDER,
)
from scanweave.operators.contract import LOCATOR_CONTRACT, Contract, Split, split_by_contract
from scanweave.operators.interval_join import LANE, LANES, check_hot_keys, match_scans
from scanweave.operators.tables import with_date_parts
from scanweave.schemas import JOINED, event_schema
from scanweave.session import session_conf
from scanweave.sources.messages import NO_AGE_LIMIT, decode_events
from scanweave.streaming.lanes import BoardingLanes, ScanLanes, seeds
from scanweave.streaming.sinks import EVERY_MINUTE, deal_pairs, start_partitioned_sink, start_shared_split


@dataclass(frozen=True)
class TrackingSettings:
    """Where a tracking job writes and how it runs.

    `state_partitions` is frozen into the checkpoint by the first run; choose it for the cluster,
    not for the day. Unset, the session's shuffle partitions count.

    With `learn_share`, a job that reads each topic once deals keys that hold more than that share of the scans over
    `spread` lanes from when it sees them (see `lanes`). Set it from the first start of a checkpoint on, or never.
    With `idle_after`, an input that falls so far behind the other no longer holds back the state (see `match_scans`).
    """

    base: str
    checkpoints: str
    trigger: dict = field(default_factory=lambda: dict(EVERY_MINUTE))
    contract: Contract = LOCATOR_CONTRACT
    lateness: str = LATENESS
    state_partitions: int | None = None
    keep_raw: bool = False
    thin: bool = True
    files_per_day: int | None = 4
    spread: int = 32
    learn_share: float | None = None
    idle_after: timedelta | None = None

    @property
    def valid_path(self) -> str:
        return f"{self.base}/{VALID_FOLDER}"

    def accepted_path(self, kind: str) -> str:
        """Transit folder between a shared split and the match that follows it."""
        return f"{self.base}/accepted/{kind.lower()}"

    def commits_path(self, kind: str) -> str:
        """Record of the batches complete in both outputs of a shared split (see `read_committed`)."""
        return f"{self.base}/committed/{kind.lower()}"

    @property
    def lanes_path(self) -> str:
        """Hot keys learnt so far and the epochs of their lanes."""
        return f"{self.base}/lanes"

    @property
    def baggage_dead_path(self) -> str:
        return f"{self.base}/{BAGGAGE_DEAD_FOLDER}"

    @property
    def passenger_dead_path(self) -> str:
        return f"{self.base}/{PASSENGER_DEAD_FOLDER}"


def ingest(
    messages: DataFrame, kind: str, contract: Contract = LOCATOR_CONTRACT, keep_raw: bool = False
) -> Split:
    """Decode one stream and split it by the contract."""
    return split_by_contract(decode_events(messages, kind, keep_raw), contract)


def start_tracking(
    baggage_messages: DataFrame,
    passenger_messages: DataFrame,
    settings: TrackingSettings,
    hot: Sequence[Row] = (),
) -> dict[str, StreamingQuery]:
    """Start the three queries: matched rows, baggage dead letters, passenger dead letters.

    The first one reports its valid messages in and matched rows out with each batch (see
    `monitor.observed_rows`), which shows how far repeated boardings multiply scans.

    `hot` (see `hot_keys`) counts on the first start of a checkpoint only.
    """
    spark = baggage_messages.sparkSession
    baggage = ingest(baggage_messages, BAGGAGE, settings.contract, settings.keep_raw)
    passengers = ingest(passenger_messages, PASSENGER, settings.contract, settings.keep_raw)
    rows = F.count(F.lit(1)).alias("rows")
    fixed, spread = _fixed_hot_keys(spark, settings, hot)
    matched = match_scans(
        baggage.valid.observe("valid_baggage", rows),
        passengers.valid.observe("valid_passengers", rows),
        settings.lateness,
        hot=fixed,
        spread=spread,
        thin=settings.thin,
        idle_after=settings.idle_after,
        clocks=(baggage.valid, passengers.valid),
        deal=deal_pairs("baggage_time", settings.files_per_day),
    ).observe("matched", rows)
    outputs = {
        "valid": (matched, settings.valid_path, None),  # dealt already
        "dead_baggage": (with_date_parts(baggage.dead, EVENT_TIME), settings.baggage_dead_path, settings.files_per_day),
        "dead_passenger": (with_date_parts(passengers.dead, EVENT_TIME), settings.passenger_dead_path, settings.files_per_day),
    }
    with _state_partitions(spark, settings):
        return {
            name: start_partitioned_sink(
                output,
                path,
                f"{settings.checkpoints}/{name}",
                trigger=settings.trigger,
                files_per_folder=files_per_day,
            )
            for name, (output, path, files_per_day) in outputs.items()
        }


def start_shared_ingest(
    baggage_messages: DataFrame, passenger_messages: DataFrame, settings: TrackingSettings, hot: Sequence[Row] = ()
) -> dict[str, StreamingQuery]:
    """The first half of a tracking job that reads and parses each topic once instead of twice.

    Per topic, one query writes dead letters and lands the valid rows for `start_landed_match`. With `learn_share`
    it also deals them; `hot` are keys to deal from the beginning.
    """
    deal = {}
    if settings.learn_share:
        check_hot_keys(hot)
        deal[BAGGAGE] = ScanLanes(settings.lanes_path, settings.learn_share, settings.spread, seed=seeds(hot))
        deal[PASSENGER] = BoardingLanes(settings.lanes_path)
    inputs = {
        BAGGAGE: (baggage_messages, settings.baggage_dead_path),
        PASSENGER: (passenger_messages, settings.passenger_dead_path),
    }
    return {
        f"split_{kind.lower()}": start_shared_split(
            messages,
            kind,
            settings.accepted_path(kind),
            dead_path,
            f"{settings.checkpoints}/split_{kind.lower()}",
            contract=settings.contract,
            trigger=settings.trigger,
            keep_raw=settings.keep_raw,
            commits=settings.commits_path(kind),
            deal=deal.get(kind),
        )
        for kind, (messages, dead_path) in inputs.items()
    }


def start_landed_match(
    spark: SparkSession,
    settings: TrackingSettings,
    hot: Sequence[Row] = (),
    clean_up: bool = False,
) -> StreamingQuery:
    """The second half: match the landed valid rows.

    A batch lands only after its dead letters are complete. One the split had to repeat lands under new file names,
    its first files may vanish; its rows are then copies of events seen before, which the dedupe removes.
    `clean_up` deletes landed files once they are matched.
    """
    landed = []
    for kind, lane in ((BAGGAGE, LANE), (PASSENGER, LANES)):
        path, schema = settings.accepted_path(kind), event_schema(kind)
        if settings.learn_share:
            schema = StructType([*schema.fields, StructField(lane, IntegerType())])
        spark.createDataFrame([], schema).write.mode("append").parquet(path)  # the folder must exist
        # Folders appear while the query runs; without partition columns its schema stays fixed.
        options = {"recursiveFileLookup": "true", "maxFileAge": NO_AGE_LIMIT, "ignoreMissingFiles": "true"}
        if clean_up:
            options["cleanSource"] = "delete"
        landed.append(spark.readStream.schema(schema).options(**options).parquet(path))
    fixed, spread = ((), 1) if settings.learn_share else _fixed_hot_keys(spark, settings, hot)
    dealt = bool(settings.learn_share)
    matched = match_scans(
        *landed,
        settings.lateness,
        hot=fixed,
        spread=spread,
        thin=settings.thin,
        dealt=dealt,
        idle_after=settings.idle_after,
        deal=deal_pairs("baggage_time", settings.files_per_day),
    )
    with _state_partitions(spark, settings):
        return start_partitioned_sink(
            matched,
            settings.valid_path,
            f"{settings.checkpoints}/landed_match",
            trigger=settings.trigger,
        )


def _state_partitions(spark: SparkSession, settings: TrackingSettings):
    count = settings.state_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return session_conf(spark, spark__sql__shuffle__partitions=str(count))


def _fixed_hot_keys(
    spark: SparkSession, settings: TrackingSettings, hot: Sequence[Row]
) -> tuple[Sequence[Row], int]:
    """The hot keys and the lanes of the first start, kept beside its checkpoint.

    Rows in state sit in the lanes they were dealt to. A key that turned hot or cold between runs
    would look for its partners in other lanes.
    """
    check_hot_keys(hot)
    path = f"{settings.checkpoints}/hot_keys"
    schema = StructType([JOINED[name] for name in MATCH_KEYS] + [StructField("spread", IntegerType())])
    listed = [(*(key[name] for name in MATCH_KEYS), settings.spread) for key in hot]
    first = spark.createDataFrame(listed, schema).coalesce(1)
    first.write.mode("ignore").parquet(path)  # later starts leave it as it is
    kept = spark.read.schema(schema).parquet(path).collect()
    keys = [Row(**{name: row[name] for name in MATCH_KEYS}) for row in kept]
    return keys, kept[0].spread if kept else settings.spread
