"""Ingest, history, crawls and the live job against brute force."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from postsieve import filter_posts
from postsieve.plans.history import DAY_US, SLICE_US, Crawl, backtest_progress, default_range, narrow_crawl, replay_range, reverse_slices, run_backfill, run_backtest
from postsieve.plans.positions import split_even, with_positions, with_running_totals
from postsieve.sources import posts as P
from postsieve.sources.assets import latest_assets
from postsieve.sources.sinks import write_matches
from postsieve.streaming.live import FeedSet, event_stream, process_batch, run_live
from tests.posts import event, ids, posts, view

def now():
    return F.lit("2024-06-01 12:00:00").cast("timestamp")


def raw(spark, messages):
    return spark.createDataFrame([(i, m) for i, m in enumerate(messages)], "i int, raw string")


def test_validation(spark):
    def post(created, **more):
        return event({"text": "x", **({"createdAt": created} if created is not ... else {}), **more})

    stamp = "2024-06-01T12:00:00.000000Z"
    cases = {
        "not json": None,
        "[1]": None,
        '"text"': None,
        '{"commit": null}': None,
        '{"commit": {"record": []}}': None,
        event({"text": "y" * 100_001}): None,
        post(5): None,
        post("2024-05-01T10:00:00Z"): "2024-05-01T10:00:00Z",
        post("2024-05-01T10:00:00.12Z"): "2024-05-01T10:00:00.12Z",
        post("2024-06-01T13:00:00Z"): stamp,  # an hour ahead
        post("2024-05-01T10:00:00+00:00"): stamp,
        post("2024-05-01T10:00:00.1234567Z"): stamp,
        post("2024-13-01T10:00:00Z"): stamp,
        post("yesterday"): stamp,
        post(...): ...,
        post(""): "",
        post(None): None.__class__,
    }
    messages = list(cases) + ['{"did":"d","commit":{"operation":"delete","rkey":"1"}}', '{"commit":{"record":{"createdAt":"bad","a":"bad"}}}']
    got = {r.i: json.loads(r.raw) for r in P.validate_events(raw(spark, messages), now(), max_chars=100_000).collect()}
    for i, want in enumerate(cases.values()):
        if want is None:
            assert i not in got, messages[i][:80]
        elif want is ...:
            assert "createdAt" not in got[i]["commit"]["record"]
        elif want is None.__class__:
            assert got[i]["commit"]["record"]["createdAt"] is None
        else:
            assert got[i]["commit"]["record"]["createdAt"] == want
    assert got[len(cases)]["commit"]["operation"] == "delete"
    assert got[len(cases) + 1] == {"commit": {"record": {"createdAt": stamp, "a": "bad"}}}


def test_creation_time_is_corrected_at_its_path_alone(spark):
    future = "2999-01-01T00:00:00Z"
    templates = [
        '{"commit":{"record":{"createdAt" : "%s","text":"x"}}}',
        '{"commit":{"record":{"createdAt":  "%s","text":"x"}}}',
        '{"commit":{"record":{"embed":{"createdAt":"%s"},"createdAt":"%s","text":"x"}}}',
        '{"commit":{"record":{"embed":{"createdAt":"%s"},"createdAt":  "%s","text":"x"}},"did":"d","time_us":5}',
        '{"commit":{"record":{"created\\u0041t":"%s","text":"\\"createdAt\\":"}},"createdAt":"%s"}',
    ]
    sent = [t.replace("%s", future) for t in templates] + [templates[0].replace("%s", "2999\\u002d01-01T00:00:00Z")]
    got = {r.i: json.loads(r.raw) for r in P.validate_events(raw(spark, sent), now()).collect()}
    for i, message in enumerate(sent):
        want = json.loads(message)
        want["commit"]["record"]["createdAt"] = "2024-06-01T12:00:00.000000Z"
        assert got[i] == want, message


def test_size_limits(spark):
    exact = "x" * (100_000 - len(event({"text": ""})))
    rows = raw(spark, [event({"text": exact}), event({"text": exact + "x"})])
    assert [r.i for r in P.validate_events(rows, now(), max_chars=100_000).collect()] == [0]
    parsed = P.parse_events(rows)
    # The same limit means the same in history, and without one nothing is dropped.
    assert replay_range(parsed, -1, 10**9, max_chars=100_000).count() == 1
    assert replay_range(parsed, -1, 10**9).count() == P.validate_events(rows, now()).count() == 2


def test_operations_and_deletes(spark):
    df = P.parse_events(raw(spark, [event({}, n, operation=op) for n, op in enumerate(["create", "delete", "update", "create"])] + ["{}"]))
    creates, deletes = P.split_operations(df)
    assert ids(creates) == [0, 3] and ids(deletes) == [1]
    stored = posts(spark, [{}, {}, {}])
    assert ids(P.apply_deletes(stored, deletes)) == [0, 2]
    good, bad = P.quarantine(raw(spark, ["{}", "{", "1"]))
    assert [r.i for r in good.collect()] == [0, 2] and [r.i for r in bad.collect()] == [1]


def test_replay_and_slices(spark):
    at = [0, 59, 60, 61, 120, 121, 300]
    df = P.parse_events(raw(spark, [event({}, t) for t in at] + [event({}, 100, operation="delete")]))
    assert ids(replay_range(df, 60_000_000, 120_000_000)) == [60, 61, 120]
    assert ids(replay_range(df, 5, 5)) == []
    sliced = [(r.slice_no, int(r.rkey)) for r in reverse_slices(df, 0, 300_000_000, 60_000_000).select("slice_no", "rkey").collect()]
    # (240, 300] is slice 0; an event on an edge belongs to the older slice; 0 itself is outside.
    assert sliced == [(0, 300), (2, 121), (3, 61), (3, 120), (4, 59), (4, 60)]
    assert default_range(2 * DAY_US) == (DAY_US, 2 * DAY_US - SLICE_US)


def crawl_brute_force(rows, crawl):
    """rows: (time_us, key, matched) -> (per batch progress, matched keys with batch)"""
    inside = [r for r in rows if crawl.start_us < r[0] <= crawl.end_us]
    ordered = sorted(inside, key=lambda r: ((crawl.end_us - r[0]) // crawl.slice_us, r[0], r[1]))
    progress, hits, matches = [], [], 0
    for no in range(0, len(ordered), crawl.batch_size):
        batch = ordered[no : no + crawl.batch_size]
        found = [r[1] for r in batch if r[2]]
        matches += len(found)
        progress.append((no // crawl.batch_size, len(batch), len(found), no + len(batch), matches))
        hits += [(k, no // crawl.batch_size) for k in found]
        if matches >= crawl.max_matches:
            break
    return progress, sorted(hits)


@pytest.mark.parametrize("hot_second", [False, True])
@pytest.mark.parametrize("batch, limit, share", [(7, 20, 0.5), (50, 10_000, 0.3), (1, 5, 0.2)])
def test_crawls(spark, batch, limit, share, hot_second):
    rnd = random.Random(batch)
    # With a hot second a third of all posts fall on one time stamp.
    times = [500 if hot_second and i % 3 == 0 else rnd.randrange(0, 1000) for i in range(400)]
    rows = [(t, i, rnd.random() < share) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "time_us long, n int, hit boolean").select(
        "time_us", "n", F.lit("did").alias("did"), F.col("n").cast("string").alias("rkey"), F.struct("hit").alias("record")
    )
    crawl = Crawl(100, 900, 60, batch, limit)
    progress, hits = crawl_brute_force(rows, crawl)
    got = backtest_progress(df, F.col("record.hit"), crawl, ("n",)).orderBy("batch_no").collect()
    columns = ("batch_no", "batch_records", "batch_matches", "record_count", "match_count")
    assert [tuple(r[c] for c in columns) for r in got] == progress
    from postsieve import PostView

    condition = {"attribute_compare": ["hit", "==", True]}
    found = run_backfill(df, condition, PostView(df.schema, ("n",)), crawl)
    assert sorted((r.n, r.batch_no) for r in found.collect()) == hits
    # Widening looks change what is read, not what is found.
    both = run_backtest(df, condition, PostView(df.schema, ("n",)), Crawl(100, 900, 60, batch, limit, first_look=1))
    assert both[0].count() == len(progress) and both[1].count() == len(hits)


def test_crawl_reports_repeated_keys_once_each(spark):
    """Three posts, two of them with one key, under a filter on the author; one post out of range."""
    from postsieve import Catalog, PostView
    from postsieve.functions.keys import asset_key

    rows = [(10, "a", "x"), (20, "a", "x"), (30, "b", "x"), (40, "b", None), (2000, "a", "x")]
    df = spark.createDataFrame(rows, "time_us long, did string, rkey string").withColumn("record", F.struct("rkey"))
    url = "https://bsky.app/profile/u/lists/l"
    members = spark.createDataFrame([("user_list", asset_key("user_list", {"list_url": url}), "a")], "asset_type string, asset_key string, did string")
    catalog = Catalog(assets=members)
    for condition, hits in (({"list_member": [url, "in"]}, [10, 20]), ({"list_member": [url, "not_in"]}, [30, 40])):
        progress, found = run_backtest(df, condition, PostView(df.schema, ("did", "rkey")), Crawl(0, 1000, 60, 100, 50), catalog)
        assert [(r.record_count, r.match_count) for r in progress.collect()] == [(4, 2)]
        assert sorted(r.time_us for r in found.collect()) == hits


def test_scorer_sees_only_the_window(spark):
    from postsieve import Catalog, PostView
    from postsieve.sources.scores import Scorer

    texts = ["good", "bad", "old"]
    df = spark.createDataFrame([(990, "1", texts[0]), (980, "2", texts[1]), (5, "3", texts[2])], "time_us long, rkey string, text string")
    df = df.select("time_us", F.lit("d").alias("did"), "rkey", F.struct("text").alias("record"))

    def transform(inputs):
        wrong = F.raise_error(F.lit("scored a post outside the window"))
        score = F.when(F.col("input").contains("old"), wrong.cast("double")).when(F.col("input").contains("bad"), 0.9).otherwise(0.1)
        return inputs.select("input_key", F.create_map(F.lit("toxic"), score).alias("scores"))

    catalog = Catalog(scorers={"unitary/toxic-bert": Scorer(transform=transform)})
    found = run_backfill(df, {"toxicity_analysis": ["Toxic", ">", 0.5]}, PostView(df.schema, ("did", "rkey")), Crawl(900, 1000, 60), catalog)
    assert [r.rkey for r in found.collect()] == ["2"]


def test_narrow_crawl_reads_only_the_newest_part(spark):
    df = spark.range(100_000).select(F.col("id").alias("time_us"), "id")
    crawl = Crawl(0, 99_999, 10, batch_size=100, max_matches=500, first_look=10)
    # Looks: 100, 400, 1600 (limit reached), 6400 rows (the batch is whole for sure).
    assert narrow_crawl(df, F.lit(True), crawl).start_us == 99_999 - 6_400
    assert narrow_crawl(df, F.lit(False), crawl) == crawl


def test_date_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "p")
    day = 86_400_000_000
    rows = spark.range(10).select((F.col("id") * day).alias("time_us"), F.date_add(F.lit("1970-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    rows.write.partitionBy("d").parquet(path)
    found = replay_range(spark.read.parquet(path), 3 * day, 5 * day, date_column="d")
    assert found.count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan


def test_positions_and_totals(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    assert all(r.v == r.position for r in with_positions(df, "v").collect())
    totals = with_running_totals(df.withColumn("one", F.lit(1)), "v", {"seen": "one"}, block=64)
    assert all(r.seen == r.v + 1 for r in totals.collect())


@pytest.mark.parametrize("n, k, sizes", [(5, 2, [3, 2]), (7, 3, [3, 2, 2]), (3, 3, [1, 1, 1]), (100, 7, [15, 15, 14, 14, 14, 14, 14])])
def test_split_even(spark, n, k, sizes):
    parts = split_even(spark.range(n), k, "id").orderBy("id").collect()
    assert [sum(r.part == p for r in parts) for p in range(1, k + 1)] == sizes
    assert [r.part for r in parts] == sorted(r.part for r in parts)


def test_split_even_errors(spark):
    with pytest.raises(ValueError, match="positive"):
        split_even(spark.range(3), 0, "id")
    with pytest.raises(Exception, match="k cannot be greater"):
        split_even(spark.range(3), 4, "id").collect()


def test_latest_assets(spark):
    rows = [("l", "a", "old", "10:00"), ("l", "a", "new1", "11:00"), ("l", "a", "new2", "11:00"), ("l", "b", "stale", "07:00"), ("p", "a", "x", "11:30")]
    df = spark.createDataFrame(rows, "asset_type string, asset_key string, did string, t string")
    df = df.select("asset_type", "asset_key", "did", F.to_timestamp(F.concat(F.lit("2024-06-01 "), "t")).alias("fetched_at"))
    assert sorted(r.did for r in latest_assets(df, now()).collect()) == ["new1", "new2", "x"]


FEEDS = FeedSet({1: {"filter": {"attribute_compare": ["n", ">=", 5]}}, 2: {"filter": 3}, 4: None}, {3: {"operator_name": "regex_any", "condition_parameters": ["text", ["odd"]]}})


def messages():
    out = []
    for n in range(12):
        out.append(event({"n": n, "text": "odd one" if n % 2 else "even"}, n, operation="delete" if n == 7 else "create"))
    return out + ["broken {"]


def expected_matches():
    live = [n for n in range(12) if n != 7]
    return sorted([(1, n) for n in live if n >= 5] + [(2, n) for n in live if n % 2])


def test_batch_job(spark):
    events = P.parse_events(P.validate_events(raw(spark, messages()), now()))
    matches, deletes = process_batch(events, FEEDS)
    assert sorted((r.algorithm_id, int(r.uri.rsplit("/", 1)[1])) for r in matches.collect()) == expected_matches()
    assert ids(deletes) == [7]


def test_stream_equals_batch_and_survives_replay(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()

    def run():
        job = run_live(event_stream(spark, str(source)), lambda: FEEDS, f"{out}/m", f"{out}/d", f"{out}/c", available_now=True)
        job.awaitTermination()

    (source / "1.json").write_text("\n".join(messages()[:8]))
    run()
    # The next file repeats the last events of the first, as a reconnecting client would.
    (source / "2.json").write_text("\n".join(messages()[5:]))
    run()
    stored = spark.read.parquet(f"{out}/m")
    assert sorted((r.algorithm_id, int(r.uri.rsplit("/", 1)[1])) for r in stored.collect()) == expected_matches()
    assert [r.rkey for r in spark.read.parquet(f"{out}/d").collect()] == ["7"]


def test_late_and_far_future_events_are_kept(spark, tmp_path):
    """Files newest first, one of them years ahead, give what one batch gives."""
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()

    def run():
        job = run_live(event_stream(spark, str(source)), lambda: FEEDS, f"{out}/m", f"{out}/d", f"{out}/c", available_now=True)
        job.awaitTermination()

    def at(n, hours):
        return re.sub(r'"time_us": ?[0-9]+', f'"time_us": {1_700_000_000_000_000 + hours * 3_600_000_000}', messages()[n])

    hours = {11: 100_000, 10: 30, 9: 20, 8: 5, 6: 1, 5: 0}
    for n, hour in hours.items():
        (source / f"{n}.json").write_text(at(n, hour))
        run()
    (source / "again.json").write_text("\n".join(at(n, hour) for n, hour in hours.items()))
    run()
    stored = spark.read.parquet(f"{out}/m")
    found = sorted((r.algorithm_id, int(r.uri.rsplit("/", 1)[1])) for r in stored.collect())
    assert found == sorted(m for m in expected_matches() if m[1] in hours)


def test_live_job_answers_for_every_feed(spark, tmp_path):
    """A feed with matches, a silent, an inoperable and a broken one; tables are asked for per batch."""
    from postsieve import Catalog

    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    feeds = FeedSet(
        {
            1: {"filter": {"attribute_compare": ["n", ">=", 5]}},
            2: {"filter": {"attribute_compare": ["n", ">", 99]}},
            3: {"filter": {"no_such_operator": [1]}},
            5: {"filter": 77},
        },
        {},
    )
    asked = []

    def tables():
        asked.append(1)
        return Catalog()

    for n, part in enumerate((messages()[:8], messages()[8:9], messages()[:2])):
        (source / f"{n}.json").write_text("\n".join(part))
        run_live(
            event_stream(spark, str(source)), lambda: feeds, f"{out}/m", f"{out}/d", f"{out}/c", tables,
            available_now=True, responses_path=f"{out}/r",
        ).awaitTermination()
    stored = spark.read.parquet(f"{out}/r").collect()
    assert {(r.batch_id, r.algorithm_id): r.match_count for r in stored if r.match_count} == {(0, 1): 2, (1, 1): 1}
    assert len(stored) == 12 and len(asked) == 3 and len({r.uuid for r in stored}) == 12
    assert {(r.algorithm_id, r.error.error_type) for r in stored if r.error} == {(5, "ValueError")}


def test_size_limit_only_where_asked(spark):
    long = event({"n": 1, "text": "x" * 200_000}, 1)
    frame = raw(spark, [long])
    assert P.validate_events(frame, now()).count() == 1
    assert P.validate_events(frame, now(), max_chars=1000).count() == 0
    assert P.oversize(frame, 1000).select("reason").first()[0] == "longer than 1000 characters"


def test_match_sink_replaces_a_repeated_batch(spark, tmp_path):
    path = str(tmp_path / "m")
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "algorithm_id long, uri string")
    for _ in range(2):
        write_matches(batch, path, batch_id=0)
    write_matches(batch, path, batch_id=1)
    stored = spark.read.parquet(path)
    assert stored.count() == 4 and stored.where("algorithm_id = 2").count() == 2
    # Feeds are sorted columns, not folders.
    assert not list((tmp_path / "m").glob("batch_id=*/algorithm_id=*"))


def test_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "posts")
    spark.range(100).select(
        F.lit("d").alias("did"), F.col("id").cast("string").alias("rkey"),
        F.struct(F.col("id").alias("n"), F.lit("text").alias("text"), F.lit("x").alias("unused")).alias("record"),
    ).write.parquet(path)
    df = spark.read.parquet(path)
    tree = {"and": [{"attribute_compare": ["n", ">", "49.5"]}, {"or": [{"regex_any": ["text", ["text"]]}, {"attribute_compare": ["n", "<=", 3]}]}]}
    found = filter_posts(df, tree, view(df)).select("rkey")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(record.n,49)" in plan and "unused" not in plan
    assert found.count() == 50
