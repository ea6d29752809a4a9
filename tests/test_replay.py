"""Replays of quarantined messages: each once, matched with what was accepted, complete after any stop."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from scanweave.operators.contract import Contract
from scanweave.plans import replay as replays
from scanweave.plans.batch_run import Lake, load_bronze
from scanweave.plans.replay import receipts, replay
from scanweave.sources import files
from scanweave.sources.messages import text_messages
from scanweave.streaming.monitor import await_all
from scanweave.streaming.sinks import ONCE
from scanweave.streaming.tracking import TrackingSettings, start_landed_match, start_shared_ingest
from test_streams import arrive, bag, pax

# Locators of five characters are no longer cut off.
LATER = Contract(length=5)


def run(spark, tmp_path):
    settings = TrackingSettings(
        base=str(tmp_path / "lake"), checkpoints=str(tmp_path / "checkpoints"), trigger=ONCE, state_partitions=2, keep_raw=True
    )
    sources = [text_messages(spark, str(tmp_path / side)) for side in ("bag", "pax")]
    await_all(start_shared_ingest(*sources, settings).values())
    await_all([start_landed_match(spark, settings)])
    return settings


def pairs(spark, settings):
    return sorted((row.bag_tag_number, row.passenger_gate) for row in load_bronze(spark, Lake(settings.base)).collect())


FIRST = (
    [bag("b1", "AAAAAA", "12:00:00"), bag("b2", "SHORT", "12:00:00"), bag("b2", "SHORT", "12:00:00"), bag("b3", "SHORT", None)]
    + [bag("b4", None, "12:00:00"), "not json", bag("b5", "SHORT", "18:00:00")],
    [pax("p1", "AAAAAA", "12:30:00"), pax("p2", "SHORT", "12:10:00"), pax("p3", "ELSE1", "12:10:00")],
)


def test_replay_twice_adds_rows_once(spark, tmp_path):
    arrive(tmp_path, 0, FIRST)
    settings = run(spark, tmp_path)
    assert pairs(spark, settings) == [("b1", "p1")]
    done = replay(spark, settings, LATER)
    assert done == (8, 6, 4, 1)
    assert pairs(spark, settings) == [("b1", "p1"), ("b2", "p2")]
    assert replay(spark, settings, LATER) == (0, 0, 0, 0)
    assert pairs(spark, settings) == [("b1", "p1"), ("b2", "p2")]
    outcomes = {(r.kind, r.outcome): r.n for r in receipts(spark, settings).groupBy("kind", "outcome").agg(F.sum("copies").alias("n")).collect()}
    assert outcomes == {("BAGGAGE", "replayed"): 4, ("BAGGAGE", "still dead"): 2, ("PASSENGER", "replayed"): 2}
    # later arrivals go through the job, and what it quarantines is replayed then, with what was replayed before
    arrive(tmp_path, 1, ([bag("b6", "SHORT", "12:20:00"), bag("b2", "SHORT", "12:00:00")], [pax("p4", "SHORT", "17:30:00")]))
    settings = run(spark, tmp_path)
    assert replay(spark, settings, LATER) == (3, 3, 2, 2)
    assert pairs(spark, settings) == [("b1", "p1"), ("b2", "p2"), ("b5", "p4"), ("b6", "p2")]


def test_replayed_messages_meet_accepted_ones(spark, tmp_path):
    """The text is repaired: one side was quarantined, the other accepted."""
    arrive(tmp_path, 0, ([bag("b1", "AAAAA?", "12:00:00"), bag("b2", "AAAAAA", "12:05:00")], [pax("p1", "AAAAAA", "12:30:00"), pax("p2", "AAAAAA#", "12:40:00")]))
    settings = run(spark, tmp_path)
    # `AAAAA?` has six characters and passes as it is; the longer one is cut
    assert pairs(spark, settings) == [("b2", "p1")]
    done = replay(spark, settings, Contract(), repair=lambda text: F.regexp_replace(text, "#", ""))
    assert done == (1, 1, 1, 1)
    assert pairs(spark, settings) == [("b2", "p1"), ("b2", "p2")]


@pytest.mark.parametrize("step", ["staged half", "ready", "moved"])
def test_a_killed_replay_is_completed(spark, tmp_path, monkeypatch, step):
    arrive(tmp_path, 0, FIRST)
    settings = run(spark, tmp_path)

    class Killed(Exception):
        pass

    def killed(*_, **__):
        raise Killed

    real = files.write_text
    with monkeypatch.context() as patch:
        if step == "staged half":
            patch.setattr(replays, "write_partitioned", killed)
        elif step == "ready":
            patch.setattr(files, "move_files", killed)
        else:
            patch.setattr(files, "write_text", lambda s, path, text: killed() if path.endswith("state.json") else real(s, path, text))
        with pytest.raises(Killed):
            replay(spark, settings, LATER)
        assert receipts(spark, settings).count() == 0
    replay(spark, settings, LATER)
    assert pairs(spark, settings) == [("b1", "p1"), ("b2", "p2")]
    assert receipts(spark, settings).agg(F.sum("copies")).first()[0] == 8
    assert replay(spark, settings, LATER).taken == 0


def test_commands(spark, tmp_path, monkeypatch, capsys):
    """A stream job with the options a replay needs, then the replay."""
    from scanweave import __main__ as command

    seen = []

    def process_all(queries):
        for query in queries:
            query.processAllAvailable()
        for query in queries:
            query.stop()

    def ingest(*given):
        seen.append(given[2])
        return start_shared_ingest(*given)

    monkeypatch.setattr(command, "topic_messages", lambda s, servers, topic, starting, **more: text_messages(s, topic))
    monkeypatch.setattr(command, "await_first_end", process_all)
    monkeypatch.setattr(command, "start_shared_ingest", ingest)
    arrive(tmp_path, 0, FIRST)
    base = str(tmp_path / "lake")
    given = ["stream", "--servers", "none", "--base", base, "--keep-raw", "--keep-accepted", "--state-partitions", "2"]
    given += ["--baggage-topic", str(tmp_path / "bag"), "--passenger-topic", str(tmp_path / "pax"), "--trigger", "1 second"]
    command.main(given + ["--idle-after", "6", "--learn-hot-keys", "0.5", "--max-offsets", "1000"])
    assert (seen[0].idle_after, seen[0].learn_share) == (timedelta(hours=6), 0.5)
    command.main(["replay", "--base", base, "--locator-length", "5"])
    assert "Replayed(taken=8, valid=6, new_events=4, matched=1)" in capsys.readouterr().out
    assert pairs(spark, TrackingSettings(base=base, checkpoints="")) == [("b1", "p1"), ("b2", "p2")]


def test_nothing_quarantined(spark, tmp_path):
    arrive(tmp_path, 0, ([bag("b1", "AAAAAA", "12:00:00")], [pax("p1", "AAAAAA", "12:30:00")]))
    settings = run(spark, tmp_path)
    assert replay(spark, settings, LATER) == (0, 0, 0, 0)
    assert pairs(spark, settings) == [("b1", "p1")] and receipts(spark, settings).count() == 0
