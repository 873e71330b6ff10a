"""The live job's memory of events, tables with snapshots, and deletes as of a time."""

import os
import random
from datetime import datetime

import pandas as pd
from pyspark.sql import functions as F

from postsieve.sources import posts as P
from postsieve.sources.replays import EVENT_KEY, KEY_TYPE, ProcessedEvents, fresh_events
from postsieve.sources.snapshots import Conflict, Snapshots
from postsieve.streaming.live import FeedSet, event_stream, run_live
from tests.posts import event
from workloads import ingest
from workloads.registry import QUERIES

ALL = FeedSet({1: {"filter": {"and": []}}}, {})


def test_live_job_tells_events_by_all_of_their_key(spark, tmp_path):
    """A post made anew after a delete, one under the key of a gate, and creates at other times all stay."""
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    gate = {"collection": "app.bsky.feed.threadgate"}
    made = [({}, 1), ({"operation": "delete"}, 2), ({}, 3), (gate, 4), ({}, 4), ({}, 5)]
    lines = [event({"text": "x"}, n, rkey="k", **more) for more, n in made]
    for name, part in (("a", lines[:3]), ("b", lines[2:]), ("c", lines)):
        (source / f"{name}.json").write_text("\n".join(part))
        run_live(event_stream(spark, str(source)), lambda: ALL, f"{out}/m", f"{out}/d", f"{out}/c", available_now=True).awaitTermination()
    assert spark.read.parquet(f"{out}/m").count() == 5 and spark.read.parquet(f"{out}/d").count() == 1
    assert ProcessedEvents(spark, f"{out}/c-keys").between(0, 10**9).count() == 6


def keys(rows):
    return [("d", "c", str(k), "create", t) for k, t in rows]


def test_batches_are_settled_by_day(spark, tmp_path):
    store, rng, stored = ProcessedEvents(spark, str(tmp_path / "k"), settle=3), random.Random(1), set()
    day = 86_400_000_000
    for batch in range(12):
        new = keys({(rng.randrange(5), rng.choice([0, 1, 5, 40]) * day + rng.randrange(3)) for _ in range(8)})
        frame = spark.createDataFrame(new + new, KEY_TYPE)
        fresh = {tuple(r) for r in fresh_events(frame, store, batch).collect()}
        assert fresh == set(new) - stored
        # A batch that runs again sees what the others stored, not its own rows.
        store.add(frame, batch)
        assert {tuple(r) for r in fresh_events(frame, store, batch).collect()} == fresh
        store.add(frame, batch)
        stored |= set(new)
    assert {tuple(r) for r in store.between(0, 100 * day).collect()} == stored
    _, entry = store.table.latest()
    assert len(entry["batches"]) <= 4 and all(len(sets) < 3 for sets in entry["days"].values())
    assert set(entry["days"]) == {"0", "1", "5", "40"}
    # Only the sets of the range are read, and within them the range reaches the scan.
    sets = store.sets(5 * day, 5 * day + 2)
    assert not any(f"/day={d}" in s for s in sets for d in (0, 1, 40))
    plan = store.between(5 * day, 5 * day + 2)._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThanOrEqual(time_us,{5 * day})" in plan and "day=40" not in plan
    # What no log entry names is deleted; what one names is there.
    held = {f for _, e in [store.table.latest()] for f in [b["folder"] for b in e["batches"].values()] + sum(e["days"].values(), [])}
    left = {p.name for p in (tmp_path / "k" / "data").iterdir()}
    assert {f.split("/")[1] for f in held} <= left and store.table.versions()[0] > 1


def test_keys_of_a_large_batch_are_cut_by_time(spark, tmp_path):
    """No task holds all keys of a batch; files are apart in time, and times many events share are cut too."""
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    store = ProcessedEvents(spark, str(tmp_path / "k"))
    frame = spark.createDataFrame(keys([(k, 7 if k % 2 else k) for k in range(4000)]), KEY_TYPE)
    store.add(frame, 0)
    spark.conf.set(coalesce, "false")  # as if each partition were large
    try:
        store.add(frame, 1)
    finally:
        spark.conf.unset(coalesce)
    small, large = ([p for p in (tmp_path / "k" / s).iterdir() if p.suffix == ".parquet"] for s in store.sets(0, 9, None))
    assert len(small) == 1 and len(large) == 4
    spans = sorted((r["time_us"].min(), r["time_us"].max(), len(r)) for r in map(pd.read_parquet, large))
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:])) and max(n for *_, n in spans) < 2000
    assert {tuple(r) for r in store.between(0, 10**9).collect()} == {tuple(r) for r in frame.collect()}


def test_events_without_a_key_pass(spark, tmp_path):
    store = ProcessedEvents(spark, str(tmp_path / "k"))
    rows = [("d", "c", "1", "create", 5), ("d", None, "1", "create", 5), (None, "c", "1", "create", 5), ("d", "c", "1", "create", None)]
    frame = spark.createDataFrame([*rows, *rows], KEY_TYPE).withColumn("n", F.lit(1))
    store.add(frame, 0)
    assert sorted(fresh_events(frame, store, 1).collect(), key=str) == sorted(frame.where("did IS NULL OR collection IS NULL OR time_us IS NULL").collect(), key=str)
    nameless = frame.where("did IS NULL")
    store.add(nameless, 1)
    assert fresh_events(nameless, store, 2).count() == 2 and set(EVENT_KEY) < set(frame.columns)
    assert fresh_events(frame.limit(0), store, 2).count() == 0


def test_two_writers(spark, tmp_path):
    one, two = Snapshots(spark, str(tmp_path / "t")), Snapshots(spark, str(tmp_path / "t"))
    assert one.latest() == (0, {}) and one.commit(0, {"n": 1}) and not two.commit(0, {"n": 2})
    # The second reads what the first wrote and adds to it.
    def late(entry):
        if entry["n"] == 1:
            one.commit(1, {"n": 5})
        return {"n": entry["n"] + 1}

    assert two.change(late) == {"n": 6} == one.latest()[1]

    def always_late(entry):
        one.commit(one.latest()[0], {"n": 0})
        return entry

    try:
        two.change(always_late, tries=2)
    except Conflict:
        pass
    else:
        raise AssertionError
    assert one.latest()[1] == {"n": 0} and not list((tmp_path / "t" / "drafts").glob("[!.]*"))


def test_deletes_reach_older_rows_alone(spark):
    stored = [("a", "1", 1), ("a", "1", 30), ("a", "1", 20), ("a", "2", 5), ("b", "1", 1), ("a", "1", None), (None, "1", 1), ("c", "1", 9)]
    deletes = [("a", "1", 20), ("a", "1", 3), ("a", "2", 4), ("c", "1", None), ("c", "1", 1), (None, "1", 9)]
    kind = "did string, rkey string, time_us long"
    left = P.apply_deletes(spark.createDataFrame(stored, kind), spark.createDataFrame(deletes, kind))
    assert left.columns == ["did", "rkey", "time_us"]
    assert sorted(map(tuple, left.collect()), key=str) == sorted([("a", "1", 30), ("a", "2", 5), ("b", "1", 1), (None, "1", 1)], key=str)
    assert P.apply_deletes(left, spark.createDataFrame([], kind)).count() == 4
    untimed = P.apply_deletes(spark.createDataFrame(stored, kind), spark.createDataFrame(deletes, kind), time=None)
    assert {tuple(r) for r in untimed.collect()} == {("b", "1", 1), (None, "1", 1)}


def test_more_messages_are_more_files(spark, tmp_path, monkeypatch):
    """Events are dealt out before they become messages, and written to as many files as they need; batches stay."""
    rows = [(n, datetime(2024, 1, 1 + n % 28, 1, n % 60), n % 7, ["view", "click", "error", "signup", "purchase"][n % 5], n % 40 / 1.0, f'{{"k": {n % 9}}}') for n in range(400)]
    frame = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    os.mkdir(tmp_path / "in")
    frame.toPandas().to_parquet(tmp_path / "in" / "events.parquet", coerce_timestamps="us")
    # A split of stored events is many times as large as messages.
    streamed = ingest._event_rows(spark, str(tmp_path / "in"))
    assert streamed.isStreaming and "RepartitionByExpression" in streamed._jdf.queryExecution().analyzed().toString()
    names = ["stream_late_events", "stream_recreated_posts", "stream_collections", "stream_quarantine"]
    found = []
    for size in (250_000, 20):
        monkeypatch.setattr(ingest, "_PER_FILE", size)
        for name in names:
            out = tmp_path / f"{name}-{size}"
            monkeypatch.setattr(ingest, "shared_folder", lambda *_, out=out: str(out))
            got = sorted(map(str, QUERIES[name].run(spark, str(tmp_path / "in")).collect()))
            files = {str(p.parent): 0 for p in (out / "in").rglob("part-*")}
            for p in (out / "in").rglob("part-*"):
                files[str(p.parent)] += 1
                assert size > 20 or len(p.read_text().splitlines()) <= 25
            found.append((name, got, len(files), len(list((out / "matches").glob("batch_id=*")))))
    assert found[:4] == found[4:] and all(batches > 1 for *_, batches in found)
