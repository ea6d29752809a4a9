"""Command line: the streaming job, the load of landed files and the batch run, and replays of quarantined messages.

    spark-submit ... -m scanweave stream --servers HOST:PORT --baggage-topic B --passenger-topic P --base PATH
    spark-submit ... -m scanweave batch  --base PATH [--publish SILVER_NAME GOLD_NAME] [--conform-parents]
    spark-submit ... -m scanweave replay --base PATH [--locator-length N] [--placeholders TEXT ...]
"""

import argparse
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import Row

from scanweave.constants import MATCH_KEYS, TRIGGER
from scanweave.operators.contract import LOCATOR_CONTRACT, STRICT_CONTRACT
from scanweave.operators.quality import CONFORMED_LOCATOR, published_checks
from scanweave.plans.batch_run import Lake, load_bronze, run_batch, run_batch_published
from scanweave.plans.replay import replay
from scanweave.session import build_session
from scanweave.sources.messages import MOST_OFFSETS, topic_messages
from scanweave.sources.snapshots import KEPT_SNAPSHOTS
from scanweave.streaming.monitor import await_first_end
from scanweave.streaming.tracking import (
    TrackingSettings,
    start_landed_match,
    start_shared_ingest,
    start_tracking,
)


def _arguments(given: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="scanweave")
    jobs = parser.add_subparsers(dest="job", required=True)

    stream = jobs.add_parser("stream", help="match two topics and quarantine invalid messages")
    stream.add_argument("--servers", required=True)
    stream.add_argument("--baggage-topic", required=True)
    stream.add_argument("--passenger-topic", required=True)
    stream.add_argument("--base", required=True, help="output folder")
    stream.add_argument("--checkpoints", help="default: BASE/checkpoints")
    stream.add_argument("--starting", default="latest", help="offsets of the first run")
    stream.add_argument("--state-partitions", type=int, help="fixed by the first run")
    stream.add_argument("--require-event-time", action="store_true")
    stream.add_argument("--trigger", default=TRIGGER, help="time between batches")
    stream.add_argument("--read-twice", action="store_true", help="no landing of valid rows: read each topic twice")
    stream.add_argument("--max-offsets", help=f"most messages per topic and batch, default {MOST_OFFSETS}")
    stream.add_argument("--hot-keys", nargs="*", default=[], metavar="LOCATOR:FLIGHT", help="fixed by the first run")
    stream.add_argument("--learn-hot-keys", type=float, metavar="SHARE", help="deal keys above this share of the scans, not with --read-twice; as in the first run")
    stream.add_argument("--idle-after", type=float, metavar="HOURS", help="a topic so far behind the other no longer holds back state")
    stream.add_argument("--keep-raw", action="store_true", help="store the text of dead letters")
    stream.add_argument("--keep-accepted", action="store_true", help="keep matched files, for replays")

    again = jobs.add_parser("replay", help="decode quarantined messages again, each once, and match them")
    again.add_argument("--base", required=True, help="output folder of a job with --keep-raw and --keep-accepted")
    again.add_argument("--locator-length", type=int, default=LOCATOR_CONTRACT.length)
    again.add_argument("--placeholders", nargs="*", default=list(LOCATOR_CONTRACT.placeholders))
    again.add_argument("--require-event-time", action="store_true")

    batch = jobs.add_parser("batch", help="load landed files, rebuild silver and gold, check them")
    batch.add_argument("--base", required=True, help="folder the streaming job writes to")
    batch.add_argument("--publish", nargs=2, metavar=("SILVER", "GOLD"), help="publish after checks")
    batch.add_argument("--keep", type=int, default=KEPT_SNAPSHOTS, help="snapshots of silver and gold that stay readable")
    batch.add_argument("--conform-parents", action="store_true", help="cleanse bronze locators in the relationship check")
    return parser.parse_args(given)


def main(given: list[str] | None = None) -> None:
    arguments = _arguments(given)
    spark = build_session(f"scanweave-{arguments.job}")
    if arguments.job == "batch":
        lake = Lake(arguments.base)
        bronze = load_bronze(spark, lake)
        checks = published_checks(CONFORMED_LOCATOR if arguments.conform_parents else None)
        if arguments.publish:
            run_batch_published(bronze, lake, *arguments.publish, checks, arguments.keep)
        else:
            run_batch(bronze, lake, checks, arguments.keep)
        return

    contract = STRICT_CONTRACT if arguments.require_event_time else LOCATOR_CONTRACT
    if arguments.job == "replay":
        later = replace(contract, length=arguments.locator_length, placeholders=tuple(arguments.placeholders))
        print(replay(spark, TrackingSettings(base=arguments.base, checkpoints=""), later))
        return

    settings = TrackingSettings(
        base=arguments.base,
        checkpoints=arguments.checkpoints or f"{arguments.base}/checkpoints",
        trigger={"processingTime": arguments.trigger},
        contract=contract,
        state_partitions=arguments.state_partitions,
        keep_raw=arguments.keep_raw,
        learn_share=arguments.learn_hot_keys,
        idle_after=None if arguments.idle_after is None else timedelta(hours=arguments.idle_after),
    )
    limit = {"maxOffsetsPerTrigger": arguments.max_offsets} if arguments.max_offsets else {}
    hot = [Row(**dict(zip(MATCH_KEYS, key.split(":", 1)))) for key in arguments.hot_keys]
    baggage, passengers = (
        topic_messages(spark, arguments.servers, topic, arguments.starting, **limit)
        for topic in (arguments.baggage_topic, arguments.passenger_topic)
    )
    if arguments.read_twice:
        queries = [*start_tracking(baggage, passengers, settings, hot).values()]
    else:
        queries = [*start_shared_ingest(baggage, passengers, settings, hot).values()]
        queries.append(start_landed_match(spark, settings, hot, clean_up=not arguments.keep_accepted))
    await_first_end(queries)


if __name__ == "__main__":
    main()
