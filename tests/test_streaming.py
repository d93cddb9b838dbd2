import json
import time

import pytest
from pyspark.sql import functions as F

from docksense.streaming import routes as route_stream
from docksense.sources import versions, writers
from docksense.streaming import status as live
from docksense.streaming.metrics import TriggerLog
from docksense.streaming.state import KeyedState


def message(station, bikes, at):
    return json.dumps({"station_id": station, "num_bikes_available": bikes, "num_docks_available": 1, "last_reported": at})


def stations(spark):
    return spark.createDataFrame([(1, 20, 0), (2, 20, 0)], "station_id int, capacity int, truck int")


def test_newest_message_wins_and_replay_changes_nothing(spark, tmp_path):
    feed, target = tmp_path / "feed", str(tmp_path / "state")
    feed.mkdir()
    (feed / "a.json").write_text(message(1, 20, 200) + "\n" + message(2, 3, 100) + "\n")

    def run(checkpoint):
        stream = live.status_stream(live.read_status_stream(spark, str(feed)), stations(spark))
        query = live.start_upsert(stream, target, str(tmp_path / checkpoint))
        query.awaitTermination()
        return query

    run("c")
    (feed / "b.json").write_text(message(1, 5, 150) + "\n" + message(2, 9, 300) + "\n{broken\n")
    query = run("c")
    assert live.progress_rows(query)[0]["rows"] == 3

    def now():
        return sorted((r["station_id"], r["num_bikes_available"], r["check_status"]) for r in live.current_state(spark, target).collect())

    assert now() == [(1, 20, "full"), (2, 9, "sufficient")]
    stream = live.decode_status(spark.read.text(str(feed / "b.json")))
    again = live.stamp(live.classify(live.enrich_stream(stream, stations(spark))))
    KeyedState(spark, target).apply(again, 1, str(tmp_path / "c"))
    assert now() == [(1, 20, "full"), (2, 9, "sufficient")]
    compact = live.compact_state(spark, target)
    assert live.current_state(spark, compact).count() == 2


def test_latest_state_on_a_stream(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "a.json").write_text("\n".join([message(1, 7, 20), message(1, 4, 10), message(2, 1, 5)]))
    stream = live.latest_state(live.decode_status(live.read_status_stream(spark, str(feed))).select("station_id", "num_bikes_available", "last_reported"))
    query = stream.writeStream.outputMode("update").format("memory").queryName("latest_rows").trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination()
    assert sorted(map(tuple, spark.table("latest_rows").select("station_id", "num_bikes_available").collect())) == [(1, 7), (2, 1)]


def test_route_messages_with_missing_keys(spark):
    texts = ['{"truck_id": 3, "optimal_route": [{"station_id": 1, "lat": 41.0, "lon": 2.0}, {"station_id": 2, "lat": 41.1, "lon": 2.1}], "distance": 1234.5}',
             '{"truck_id": 4}', '{"distance": 1}', '{"truck_id": ']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "arrival int, value string")
    good, bad = route_stream.decode_routes(df, on_error="split")
    assert bad.count() == 1 and good.count() == 2
    assert [(r["order"], r["station_id"]) for r in route_stream.explode_routes(good).orderBy("order").collect()] == [(1, 1), (2, 2)]
    assert [r["path"] for r in route_stream.route_paths(good).collect()] == [[[2.0, 41.0], [2.1, 41.1]]]
    text = {r["truck_id"]: (r["distance_text"], r["balance_bicicletas"]) for r in route_stream.truck_summary(good, "arrival").collect()}
    assert text == {3: ("1.234,50", 0), 4: ("0,00", 0)}


def test_long_tours_come_back_in_order(spark):
    from docksense.operators import routes

    stations = spark.createDataFrame(
        [(i, 1, 2.0 + i * 0.01, 41.0, "low", 20, 3, 7, 0) for i in range(10)] + [(100 + i, 2, 2.0, 41.0 + i * 0.02, "full", 20, 9, 0, 5) for i in range(3)],
        "station_id int, truck int, lon double, lat double, check_status string, capacity int, num_bikes_available int, bikes_to_refill int, bikes_to_remove int")
    sent = routes.route_messages(routes.truck_routes(stations, block=4), block=4).select("value")
    assert sent.count() == 3 + 1
    decoded = route_stream.decode_routes(sent)
    orders = [(r["truck_id"], r["order"]) for r in route_stream.explode_routes(decoded).orderBy("truck_id", "order").collect()]
    assert orders == [(1, i) for i in range(1, 12)] + [(2, i) for i in range(1, 5)]
    paths = {r["truck_id"]: r["path"] for r in route_stream.route_paths(decoded).collect()}
    assert {k: len(v) for k, v in paths.items()} == {1: 11, 2: 4} and paths[1][0] == paths[1][-1] == [2.0, 41.0]


def test_files_before_the_start_are_skipped(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "a.json").write_text(message(1, 20, 200) + "\n")
    mark = spark.read.text(str(feed)).agg(F.max("_metadata.file_modification_time")).first()[0]
    time.sleep(0.05)
    (feed / "b.json").write_text(message(2, 5, 150) + "\n")

    def ids(name, start):
        stream = live.decode_status(live.read_status_stream(spark, str(feed), start=start)).select("station_id")
        return sorted(r.station_id for r in live.run_to_table(stream, str(tmp_path / name), str(tmp_path / f"{name}-at")).collect())

    assert ids("all", "earliest") == [1, 2] and ids("late", mark) == [2] and ids("now", "latest") == []


def test_files_that_arrive_while_stopped_are_read(spark, tmp_path):
    feed, progress, target = tmp_path / "feed", str(tmp_path / "at"), str(tmp_path / "rows")
    feed.mkdir()

    def run():
        messages = live.read_status_stream(spark, str(feed), start="latest", checkpoint=progress)
        rows = live.run_to_table(live.decode_status(messages).select("station_id"), target, progress)
        return sorted(r.station_id for r in rows.collect())

    (feed / "old.json").write_text(message(1, 20, 200) + "\n")
    time.sleep(0.05)
    assert run() == []
    (feed / "a.json").write_text(message(2, 5, 150) + "\n")
    time.sleep(0.05)
    assert run() == [2]
    assert run() == [2]
    (feed / "b.json").write_text(message(3, 5, 150) + "\n")
    assert run() == [2, 3]


STATUS = "station_id int, num_bikes_available int, last_reported long"


def test_state_stays_small_and_survives(spark, tmp_path):
    import random

    rng, want, target = random.Random(3), {}, str(tmp_path / "state")
    state = KeyedState(spark, target, buckets=4, changes=5)
    most, batches = 0, []
    for i in range(50):
        rows = [(rng.randint(1, 40), rng.randint(0, 30), rng.randint(0, 300)) for _ in range(rng.choice([0, 3, 12]))]
        batches.append(spark.createDataFrame(rows, STATUS).coalesce(1))
        state.apply(batches[-1], i, "one")
        for r in sorted(rows, key=lambda r: r[2]):
            if r[0] not in want or r[2] > want[r[0]][2]:
                want[r[0]] = r
            elif r[2] == want[r[0]][2]:  # equally new: the later batch, within one the row that compares higher
                want[r[0]] = max(r, want[r[0]]) if want[r[0]] in rows else r
        if i % 7 == 0 and want:
            most = max(most, len(state.current().inputFiles()))
    held = lambda: {r.station_id: r.last_reported for r in state.current().collect()}
    assert held() == {k: v[2] for k, v in want.items()} and most <= 4 + 5
    assert len(state.versions.numbers()) == 2
    # a batch that comes again changes nothing, not even after a restart
    before = sorted(map(tuple, state.current().collect()))
    newer = spark.createDataFrame([(k, 99, 10**6) for k in want], STATUS)
    KeyedState(spark, target).apply(newer, 49, "one")
    KeyedState(spark, target).apply(newer, 3, "one")
    assert sorted(map(tuple, state.current().collect())) == before
    # another stream's batches are its own
    KeyedState(spark, target).apply(newer.limit(1), 0, "two")
    assert [r.num_bikes_available for r in state.current().filter("last_reported = 1000000").collect()] == [99]


def test_crash_before_the_entry_leaves_the_old_state(spark, tmp_path, monkeypatch):
    state = KeyedState(spark, str(tmp_path / "state"), buckets=2, changes=1)
    state.apply(spark.createDataFrame([(1, 5, 10), (2, 5, 10)], STATUS), 0, "one")
    before = sorted(map(tuple, state.current().collect()))

    def fail(entry):
        raise OSError("gone")

    newer = spark.createDataFrame([(1, 7, 20)], STATUS)
    with monkeypatch.context() as m:
        m.setattr(state.versions, "commit", fail)
        with pytest.raises(OSError, match="gone"):
            state.apply(newer, 1, "one")
    assert sorted(map(tuple, state.current().collect())) == before
    state.apply(newer, 1, "one")
    assert sorted(map(tuple, state.current().collect())) == [(1, 7, 20), (2, 5, 10)]
    kept = {p for n in state.versions.numbers() for p in state.versions.entry(n)["paths"]}
    assert {f"data/{n}" for n in state.versions._names("data")} == kept  # the failed job's files are gone
    # only the bucket that changed has new files
    entries = [state.versions.entry(n)["base"] for n in state.versions.numbers()]
    assert sum(entries[0][b] != entries[1][b] for b in entries[0]) == 1


def test_equal_polls_reach_the_sink_once(spark, tmp_path):
    feed, target = tmp_path / "feed", str(tmp_path / "state")
    feed.mkdir()
    polls = [message(1, 5, 100)] * 6 + [message(1, 9, 50)] + [message(1, 5, 100)] + [message(1, 4, 120)]
    for i, p in enumerate(polls):
        (feed / f"{i}.json").write_text(p + "\n")
    seen = []
    messages = live.read_status_stream(spark, str(feed), files_per_trigger=1)
    stream = live.distinct_polls(live.decode_status(messages).select("station_id", "num_bikes_available", "last_reported"))
    state = KeyedState(spark, target)

    def write(batch, batch_id):
        rows = [tuple(r) for r in batch.collect()]
        seen.extend(rows)
        state.apply(spark.createDataFrame(rows, batch.schema), batch_id, "one")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(seen) == [(1, 4, 120), (1, 5, 100), (1, 9, 50)]
    assert [tuple(r) for r in state.current().collect()] == [(1, 4, 120)]
    assert live.distinct_polls(spark.createDataFrame([(1, 5, 100)] * 6 + [(1, 9, 50)], STATUS)).count() == 2


def test_more_triggers_than_spark_remembers(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    for i in range(120):
        (feed / f"{i}.json").write_text(message(i, 5, 100) + "\n")
    stream = live.read_status_stream(spark, str(feed), files_per_trigger=1).observe("all", F.count(F.lit(1)).alias("n"))
    with TriggerLog(spark, str(tmp_path / "log")) as log:
        query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination()
        log.wait(str(query.runId))
    assert len(live.progress_rows(query)) <= 100
    rows = log.table().filter("rows > 0").collect()
    assert sorted(r.batch_id for r in rows) == list(range(120)) and all(json.loads(r.observed)["all"]["n"] == 1 for r in rows)


def test_table_is_replaced_without_a_gap(spark, tmp_path):
    target = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, target)
    assert versions.replace_table(spark.range(5).toDF("k"), target) == 0
    old = versions.read_table(spark, target)
    # from itself, while a reader holds the old one
    assert versions.replace_table(old.withColumn("k", F.col("k") + 10), target) == 1
    assert sorted(r.k for r in old.collect()) == [0, 1, 2, 3, 4]
    assert sorted(r.k for r in versions.read_table(spark, target).collect()) == [10, 11, 12, 13, 14]

    # a job that fails halfway through its write
    def broken(batches):
        for n, batch in enumerate(batches):
            if n or batch.column(0)[0].as_py() >= 13:
                raise ValueError("halfway")
            yield batch

    with pytest.raises(Exception, match="halfway"):
        versions.replace_table(versions.read_table(spark, target).repartitionByRange(4, "k").mapInArrow(broken, "k long"), target)
    assert sorted(r.k for r in versions.read_table(spark, target).collect()) == [10, 11, 12, 13, 14]
    assert sorted(r.k for r in versions.read_table(spark, target, 0).collect()) == [0, 1, 2, 3, 4]
    assert writers.upsert_table(spark.createDataFrame([(10,), (20,)], "k long").withColumn("v", F.lit(1)).select("k"), target, ["k"]) == 2
    store = versions.Versions(spark, target)
    assert store.numbers() == [1, 2] and len(store._names("data")) == 2 and store._names("tmp") == []
    assert versions.replace_table(versions.read_table(spark, target).limit(0), target) == 3
    assert versions.read_table(spark, target).count() == 0 and versions.read_table(spark, target).columns == ["k"]
