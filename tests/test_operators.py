import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docksense.functions import calendar as cal
from docksense.operators import aggs, clean, joins, ml, windows
from docksense.operators.spatial import exact_quantiles
from docksense.plans import demand
from docksense.sources import landing, readers, writers


def day(s):
    return dt.date.fromisoformat(s)


def test_partition_repair(spark):
    rows = [(day("2024-02-29"),), (day("2024-04-01"),), (day("2024-03-15"),), (day("2024-02-28"),), (None,)]
    df = spark.createDataFrame(rows, "d date")
    got = [r["partition_date"] for r in writers.repair_boundary(df, 2024, 3, "d").collect()]
    assert got == [day("2024-03-01"), day("2024-03-31"), day("2024-03-15"), day("2024-02-28"), None]


def test_snapshot_merge_keeps_old_adds_new(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "station_id int, name string, capacity int")
    new = spark.createDataFrame([(1, None, 11), (3, "c", 30)], "station_id int, name string, capacity int")
    got = {tuple(r) for r in joins.merge_snapshots(old, new).collect()}
    assert got == {(1, "a", 11), (2, "b", 20), (3, "c", 30)}
    dated = old.withColumn("d", F.lit(1)).union(new.withColumn("d", F.lit(2)))
    assert {tuple(r) for r in joins.consolidate_snapshots(dated, "station_id", ["d"]).collect()} == got


def test_no_capacity_table_gives_zero(spark):
    df = spark.createDataFrame([(1,)], "station_id int")
    assert joins.join_capacity(df, None).first()["capacity"] == 0


def test_shared_holiday_counts_once(spark):
    general = spark.createDataFrame([("2024", day("2024-01-01")), ("2019", day("2019-01-01"))], "any string, data date")
    local = spark.createDataFrame([("2024", day("2024-01-01"), "T", "L"), ("2024", day("2024-09-24"), "T", "L"), ("2024", day("2024-05-20"), "X", "L")],
                                  "any_calendari string, data date, ajuntament_o_nucli_municipal string, festiu string")
    got = clean.holiday_calendar(general, local, (2021, 2024), "T", "L")
    assert sorted(r["data"] for r in got.collect()) == [day("2024-01-01"), day("2024-09-24")]


def readings(spark, n=6000, seed=1):
    """A third of all readings belong to one station and day, with equal times among them."""
    rng = np.random.default_rng(seed)
    station = np.where(rng.random(n) < 0.34, 7, rng.integers(0, 20, n))
    start = dt.datetime(2024, 1, 1)
    secs = np.where(station == 7, rng.integers(0, 20000, n), rng.integers(0, 3 * 86400, n))
    rows = [(int(i), int(s), start + dt.timedelta(seconds=int(t)), int(b), int(k)) for i, (s, t, b, k) in enumerate(
        zip(station, secs, rng.integers(0, 4, n), rng.integers(0, 3, n)))]
    df = spark.createDataFrame(rows, "event_id bigint, station_id int, last_reported_local timestamp_ntz, num_bikes_available int, num_docks_available int")
    return df.withColumn("file_date", F.to_date("last_reported_local"))


def test_sliced_lag_equals_window(spark):
    df = readings(spark).cache()
    got = windows.demand_from_lag(df, slice_seconds=600).select("event_id", "num_bikes_available_lag").collect()
    w = W.partitionBy("station_id", "file_date").orderBy("last_reported_local", "event_id")
    want = df.select("event_id", F.lag("num_bikes_available").over(w)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_first_reading_of_a_day_has_no_demand(spark):
    t = dt.datetime(2024, 1, 1, 23, 59)
    rows = [(1, 5, t, 3, 0), (2, 5, t + dt.timedelta(minutes=2), 9, 0)]
    df = spark.createDataFrame(rows, "event_id bigint, station_id int, last_reported_local timestamp_ntz, num_bikes_available int, num_docks_available int")
    got = windows.demand_from_lag(df.withColumn("file_date", F.to_date("last_reported_local"))).collect()
    assert {(r["bikes_taken"], r["bikes_returned"]) for r in got} == {(0, 0)}


def test_forward_fill_equals_pandas(spark):
    df = readings(spark).cache()
    got = windows.forward_fill_zero(df, slice_seconds=3600).toPandas().sort_values("event_id")
    pdf = df.toPandas().sort_values(["station_id", "last_reported_local", "event_id"])
    empty = (pdf.num_bikes_available == 0) & (pdf.num_docks_available == 0)
    pdf.loc[empty, ["num_bikes_available", "num_docks_available"]] = np.nan
    cols = ["num_bikes_available", "num_docks_available"]
    pdf[cols] = pdf.groupby("station_id")[cols].ffill()
    want = pdf.sort_values("event_id")
    for c in cols:
        np.testing.assert_array_equal(got[c].to_numpy(dtype=float), want[c].to_numpy(dtype=float))


def test_last_in_hour_keeps_ties(spark):
    t = dt.datetime(2024, 1, 1, 5)
    df = spark.createDataFrame([(1, 1, t, 2), (2, 1, t, 3), (3, 1, t - dt.timedelta(minutes=1), 4)], "event_id int, k int, ts timestamp_ntz, v int")
    both = windows.last_in_group(df, ["k"], "ts", {"total": "v"}).collect()
    assert sorted((r["event_id"], r["total"]) for r in both) == [(1, 9), (2, 9)]
    assert [r["event_id"] for r in windows.last_in_group(df, ["k"], "ts", {"total": "v"}, keep_ties=False, tie="event_id").collect()] == [2]


def documents(spark, days):
    rows = [(s, day(d), [(h, b, k) for h, b, k in hours]) for s, d, hours in days]
    return spark.createDataFrame(rows, "station_id int, date date, status array<struct<hour int, num_bikes_available int, num_docks_available int>>")


def test_rotation_counts_short_days_with_zero(spark):
    full = [(h, h % 2, 5) for h in range(24)]
    docs = documents(spark, [(1, "2024-01-01", full), (1, "2024-01-02", full[:23])])
    got = aggs.rotation_stations(docs).first()
    assert (got["avg_daily_rotation"], got["count"]) == (11.5, 2)
    assert aggs.rotation_stations(docs, skip_incomplete=True).first()["avg_daily_rotation"] == 23.0


def test_shortage_averages_only_months_with_any(spark):
    docs = documents(spark, [(1, "2024-01-01", [(0, 0, 1), (1, 0, 1)]), (1, "2024-02-01", [(0, 3, 1)]), (1, "2024-03-01", [(0, 0, 1)])])
    got = aggs.shortage_stations(docs, "num_bikes_available").first()
    assert (got["avg_monthly_count"], got["months_count"]) == (1.5, 2)


def test_density_thresholds(spark):
    df = spark.range(10).select(F.col("id").alias("count"))
    got = {r["count"]: r["classification"] for r in aggs.density_class(df).collect()}
    assert [got[i] for i in range(10)] == ["low"] * 3 + ["medium"] * 4 + ["high"] + ["very_high"] * 2


def test_first_document_fill(spark):
    df = spark.createDataFrame([(1, 1, None, 5), (1, 2, "x", 6), (2, 1, None, None), (2, 2, "y", 7)], "s int, d int, a string, c int")
    got = sorted(tuple(r) for r in aggs.backfill_info(df, "s", ["d"], ["a", "c"]).select("s", "d", "a", "c").collect())
    assert [r[3] for r in got] == [5, 5] and got[1][2] == "x" and len(got) == 2


def test_null_profile_of_nothing(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert aggs.null_percentages(df).count() == 0


def test_quantiles_with_a_frequent_value(spark):
    rng = np.random.default_rng(3)
    v = np.concatenate([np.full(4000, 1.25), rng.normal(size=3000), rng.integers(0, 5, 1000).astype(float), [1e12, -1e12]])
    df = spark.createDataFrame(pd.DataFrame({"v": v}))
    shares = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    np.testing.assert_allclose(exact_quantiles(df, "v", shares, buckets=64), np.quantile(v, shares), rtol=1e-12)


def test_upsert_replaces_whole_rows(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, x string, y int")
    new = spark.createDataFrame([(2, None, 9), (3, "c", 3)], "k int, x string, y int")
    assert {tuple(r) for r in writers.upsert(old, new, ["k"]).collect()} == {(1, "a", 1), (2, None, 9), (3, "c", 3)}


def test_malformed_messages_are_set_aside(spark):
    from docksense.schemas import LIVE_STATUS

    df = spark.createDataFrame([('{"station_id": 5, "num_bikes_available": 2}',), ('{"station_id":',)], "value string")
    good, bad = landing.decode(df, "value", LIVE_STATUS, {"num_docks_available": 0}, on_error="split")
    assert [(r["station_id"], r["num_docks_available"]) for r in good.collect()] == [(5, 0)]
    assert [r[0] for r in bad.collect()] == ['{"station_id":']


def test_weather_files(spark):
    from docksense.schemas import WEATHER_FILE

    docs = spark.createDataFrame([("X", [("2024-03-01T10:30Z", 7.25), ("bad", 1.0)])], WEATHER_FILE)
    got = [tuple(r) for r in landing.weather_rows(docs).collect()]
    assert got == [("X", day("2024-03-01"), "10:30:00", 7.3), ("X", None, None, 1.0)]


def test_write_days_replaces_only_its_days(spark, tmp_path):
    root = str(tmp_path / "z")
    df = spark.createDataFrame([(1, day("2024-01-01")), (2, day("2024-01-02")), (3, None)], "k int, d date")
    writers.write_days(df, root, "d")
    writers.write_days(spark.createDataFrame([(9, day("2024-01-02"))], "k int, d date"), root, "d")
    tree = readers.read_tree(spark, root)
    assert sorted(r["k"] for r in tree.collect()) == [1, 9]
    plan = tree.filter(F.col("date") == day("2024-01-02"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def demand_rows(spark):
    rows = [(1, h, d, h % 4, 3, 0 if d == 3 else 1) for d in (1, 3) for h in range(0, 24, 5)]
    df = spark.createDataFrame(rows, "station_id int, hora_dia int, day int, num_bikes_available int, num_docks_available int, festivo int")
    return df.select(
        "*", F.lit(2024).alias("year"), F.lit(3).alias("month"), F.lit(0).alias("num_bikes_error"), F.lit(2).alias("total_bikes_taken"),
        F.lit(1).alias("total_bikes_returned"), F.lit("IN_SERVICE").alias("status_station"), F.lit(5).alias("weekday"), F.lit(1).alias("laborable"),
        F.lit(10.5).alias("temperatura"), F.lit(0.0).alias("precipitacion"), F.lit(60).cast("bigint").alias("humedad"), F.lit(1.0).alias("viento"),
        cal.ts_from_parts(F.lit(2024), F.lit(3), F.col("day"), F.col("hora_dia")).alias("last_reported_local"),
        F.lit("night").alias("hora_info"), F.lit("Invierno").alias("season"))


def test_completed_table_has_every_hour_and_no_gaps(spark):
    out = demand.preprocess(demand_rows(spark), None, None, "2024-01-01").cache()
    assert out.count() == 3 * 24
    assert aggs.null_percentages(out).filter("null_pct > 0").count() == 0
    assert {r["festivo"] for r in out.select("festivo").distinct().collect()} == {0}
    gap = out.filter("day = 2 and hora_dia = 13").first()
    assert (gap["weekday"], gap["laborable"], gap["hora_info"], gap["num_bikes_available"]) == (6, 0, "morning", 1)
    assert out.filter("day = 2").select("last_reported_local").distinct().count() == 24


def test_days_take_their_facts_and_null_hours(spark):
    facts = spark.createDataFrame([(1, day("2024-03-01"), 5, "a"), (1, day("2024-03-01"), 5, "a"), (1, day("2024-03-01"), 5, "b"),
                                   (1, day("2024-03-01"), 30, "c"), (2, day("2024-03-01"), 0, "d"), (None, day("2024-03-01"), 1, "e")],
                                  "station_id int, date_reported date, hora_dia int, v string")
    stations = spark.createDataFrame([(1, day("2024-03-01"), day("2024-03-02"), "s"), (3, day("2024-03-02"), day("2024-03-02"), "t"),
                                      (None, day("2024-03-01"), day("2024-03-01"), "u")], "station_id int, lo date, hi date, w string")
    days = joins.calendar_days(stations, F.col("lo"), F.col("hi")).drop("lo", "hi")
    out = joins.densify_days(facts, days, ["station_id", "date_reported"])
    assert out.columns == ["station_id", "w", "date_reported", "hora_dia", "v"] and out.count() == 25 + 24 + 24 + 24
    assert sorted((r.station_id, r.hora_dia, r.v) for r in out.filter("v IS NOT NULL").collect()) == [(1, 5, "a"), (1, 5, "b")]
    assert out.select("station_id", "date_reported", "hora_dia").distinct().count() == 4 * 24


def test_stations_out_of_service_leave(spark):
    assert demand.preprocess(demand_rows(spark), None, None, "2024-07-31").count() == 0


def test_min_levels_ignores_zero_thresholds(spark):
    df = spark.createDataFrame([("low", "high"), ("medium", None), ("very_high", "low")], "a string, b string")
    assert clean.min_levels(df, {"a": 2, "b": 0}).count() == 2


def test_bad_types_become_null(spark):
    df = spark.createDataFrame([("7", "2024-02-30", "2024-2-3")], "n string, d string, e string")
    assert tuple(clean.normalise_types(df, {"n": "int", "d": "date", "e": "date"}).first()) == (7, None, None)


def test_observation_counts(spark, tmp_path):
    from docksense.streaming.status import with_metrics

    df, seen = with_metrics(spark.range(10), "job", "id > 7")
    df.write.parquet(str(tmp_path / "o"))
    assert seen.get == {"rows": 10, "errors": 2}


@pytest.mark.parametrize("n", [1, 3])
def test_tail_positions(spark, n):
    df = spark.range(5).select(F.lit(1).alias("k"), "id")
    got = windows.tail_per_key(df, ["k"], ["id"], n, position="pos").orderBy("pos").collect()
    assert [(r["id"], r["pos"]) for r in got] == [(5 - n + i, i + 1) for i in range(n)]


def test_quantiles_with_values_that_are_not_finite(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(x,) for x in [nan, inf, inf, -inf, 1.0, 2.0, 3.0, 4.0, None]], "v double")
    assert exact_quantiles(df, "v", [0.0, 1 / 7, 2 / 7, 0.5, 5 / 7]) == [-inf, 1.0, 2.0, 3.5, inf]
    assert np.isnan(exact_quantiles(df, "v", [1.0])[0])
    assert exact_quantiles(df.filter("isnan(v)"), "v", [0.5])[0] != 0


def test_a_null_key_keeps_its_previous_row(spark):
    rows = [(i, k, f"2024-01-01 {h:02d}:10:00", b) for i, (k, h, b) in enumerate([(None, 0, 5), (None, 5, 9), (7, 0, 5), (7, 5, 9)])]
    df = spark.createDataFrame(rows, "event_id int, station_id int, t string, num_bikes_available int").withColumn(
        "last_reported_local", F.to_timestamp("t")).withColumn("file_date", F.to_date("last_reported_local"))
    got = {r["event_id"]: (r["num_bikes_available_lag"], r["bikes_returned"]) for r in windows.demand_from_lag(df).collect()}
    assert got[1] == got[3] == (5, 4) and got[0] == got[2] == (None, 0)


def test_feed_files_to_demand_on_one_clock(spark):
    # 10:05 and 10:40 local summer time are 08:05 and 08:40 UTC
    start = int(dt.datetime(2024, 7, 1, 8, 5, tzinfo=dt.UTC).timestamp())
    raw = [(7, 5, 3, 2, 9, start, 1), (7, 2, 1, 1, 12, start + 2100, 2), (7, 4, 2, 2, 10, start + 7200, 3), (7, 4, 2, 2, 10, start + 7200, 3)]
    raw = spark.createDataFrame(
        [(*r[:6], True, 1, 1, 1, "IN_SERVICE", start + r[6]) for r in raw],
        "station_id int, num_bikes_available int, `num_bikes_available_types.mechanical` int, `num_bikes_available_types.ebike` int, "
        "num_docks_available int, last_reported long, is_charging_station boolean, is_installed int, is_renting int, is_returning int, "
        "status string, last_updated long")
    readings = [{"data": "2024-07-01T08:30Z", "valor": 21.04}, {"data": "2024-07-01T10:00Z", "valor": 25.0}, {"data": "2024-07-01T10:30Z", "valor": 30.0}]
    files = spark.createDataFrame([(1, readings)], "codi int, lectures array<struct<data:string,valor:double>>")
    weather = demand.weather_series(temperatura=landing.weather_rows(files))
    info = spark.createDataFrame([(7, 20)], "station_id int, capacity int")
    holidays = spark.createDataFrame([(day("2024-07-02"),)], "data date")

    def table(**how):
        rows = demand.demand_dataset(demand.feed_readings(raw), info, holidays, weather, **how).orderBy("hora_dia").collect()
        return [(r.hora_dia, r.num_bikes_available, r.total_bikes_taken, r.total_bikes_returned, r.temperatura, r.festivo) for r in rows]

    assert table() == [(10, 2, 3, 0, 21.0, 0), (12, 4, 0, 2, 25.0, 0)]
    assert [r[4] for r in table(as_reference=True)] == [30.0, None]


def test_days_are_completed_to_24_hours(spark):
    entry = "struct<hour:int,num_bikes_available:int,num_docks_available:int>"
    docs = spark.createDataFrame([(1, [(3, 5, 1), (20, 9, 2)]), (2, [])], f"station_id int, status array<{entry}>")
    got = {r.station_id: [s.num_bikes_available if s else None for s in r.status] for r in aggs.complete_days(docs).collect()}
    assert got[1] == [5] * 20 + [9] * 4 and got[2] == [None] * 24
    hours = aggs.complete_days(docs.filter("station_id = 1")).selectExpr("status.hour AS h").first().h
    assert hours == list(range(24))


def test_rotation_takes_the_values_once_a_day(spark):
    entry = "struct<hour:int,num_bikes_available:int,num_docks_available:int>"
    full = [(h, h % 5 * 3, 0) for h in range(24)]
    moved = sum(abs(h % 5 - (h - 1) % 5) * 3 for h in range(1, 24))
    gap = [(h, None if h == 7 else 1, 0) for h in range(24)]
    docs = spark.createDataFrame([(1, full), (1, full[:23]), (2, gap), (3, []), (4, None), (5, full + [(24, 99, 0)])],
                                 f"station_id int, status array<{entry}>")
    got = {r.station_id: (r.avg_daily_rotation, r["count"]) for r in aggs.rotation_stations(docs).collect()}
    assert got == {1: (moved / 2, 2), 2: (0.0, 1), 3: (0.0, 1), 4: (0.0, 1), 5: (float(moved), 1)}
    assert [r.station_id for r in aggs.rotation_stations(docs, skip_incomplete=True).orderBy("station_id").collect()] == [1, 5]
    # the entries' values are not taken anew inside the sum over the hours
    text = aggs.rotation_stations(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "namedlambdavariable" not in text.split("aggregate(zip_with(slice(")[1].split(".num_bikes_available")[0]


def regression_rows(spark, days=12):
    rows = []
    for day_ in range(days):
        for station in (1, 2, 3):
            for hour in (8, 12, 18):
                gap = (day_ + station + hour) % 5 == 0
                rows.append((station, dt.date(2024, 1, 1) + dt.timedelta(day_), hour, None if gap else "Invierno", 1.0,
                             None if gap else 10.0 + day_, 0.5, 60.0 + hour, 0.0, None if station == 3 and day_ == 4 else station * 3 + hour // 6))
    names = ", ".join(f"{c} double" for c in ml.NUMERIC)
    return spark.createDataFrame(rows, f"station_id int, date_reported date, hora_dia int, season string, {names}, {ml.LABEL} int")


def test_every_reading_trains_or_is_held_out(spark):
    df = regression_rows(spark)
    train, test = ml.split_days(df, "date_reported", 0.75)
    assert train.count() + test.count() == df.count()
    assert train.agg(F.max("date_reported")).first()[0] == dt.date(2024, 1, 9)
    assert test.agg(F.min("date_reported")).first()[0] == dt.date(2024, 1, 10)
    undated = df.withColumn("date_reported", F.lit(None).cast("date"))
    assert [x.count() for x in ml.split_days(undated, "date_reported")] == [df.count(), 0]
    assert [x.count() for x in ml.split_days(df.limit(1), "date_reported")] == [1, 0]


def test_missing_numbers_take_the_training_mean(spark):
    train, test = ml.split_days(regression_rows(spark), "date_reported", 0.75)
    model = ml.fit_demand(train)
    out = model.transform(test)
    assert out.count() == test.count() and out.filter("prediction IS NULL").count() == 0
    means = model.stages[0].surrogateDF.first()
    assert means["temperatura"] == pytest.approx(ml.labelled(train).agg(F.avg("temperatura")).first()[0])
    filled = out.filter("temperatura IS NULL").select("temperatura_filled").distinct().collect()
    assert [r[0] for r in filled] == [means["temperatura"]]


def test_chosen_model_is_scored_on_the_hold_out(spark):
    train, test = ml.split_days(regression_rows(spark), "date_reported", 0.75)

    class Chosen:
        """What the scores need of a tuned model: two grid points, the second one better."""

        avgMetrics = [2.0, 1.0]
        best = ml.fit_demand(train, 0.01)
        transform = best.transform

        def getEstimatorParamMaps(self):
            lr = ml.demand_stages().getStages()[-1]
            return [{lr.regParam: r, lr.elasticNetParam: 0.0, lr.maxIter: 10} for r in (0.1, 0.01)]

    rows = ml.grid_scores(Chosen(), test).orderBy("rmse").collect()
    want = ml.evaluate(ml.labelled(Chosen.best.transform(test)))
    assert [(r.reg_param, r.chosen) for r in rows] == [(0.01, True), (0.1, False)]
    assert rows[0].holdout_rmse == pytest.approx(want["rmse"]) and rows[0].holdout_r2 == pytest.approx(want["r2"])
    assert rows[1].holdout_rmse is None


def moment_rows(spark):
    rng = np.random.default_rng(7)
    rows = [(int(s) if s < 9 else None, dt.date(2024, 1, 1) + dt.timedelta(int(d)), int(h), ["Invierno", "Verano", None][i % 3], float(d % 2),
             None if i % 7 == 0 else float(t), float(t * h % 3), 60.0 + h, float("nan") if i % 11 == 0 else 0.5 * i % 4, None if i % 13 == 0 else int(s * 2 + h // 6 + t))
            for i, (s, d, h, t) in enumerate(zip(*[rng.integers(0, n, 600).tolist() for n in (10, 12, 24)], rng.uniform(0, 9, 600).tolist()))]
    names = ", ".join(f"{c} double" for c in ml.NUMERIC)
    return spark.createDataFrame(rows, f"station_id int, date_reported date, hora_dia int, season string, {names}, {ml.LABEL} int")


@pytest.mark.parametrize("reg, mix, steps, normal", [(0.1, 0.0, 100, 4096), (0.01, 1.0, 10, 4096), (0.1, 0.0, 100, 0)])
def test_a_fit_by_moments_equals_the_fit_of_the_readings(spark, monkeypatch, reg, mix, steps, normal):
    train, test = ml.split_days(moment_rows(spark), "date_reported", 0.75)
    train = ml.labelled(train)
    pipeline = ml.demand_stages(reg)
    lr = pipeline.getStages()[-1].setElasticNetParam(mix).setMaxIter(steps).setSolver("auto" if normal else "l-bfgs").setTol(1e-12)
    want = pipeline.fit(train).transform(test).select("prediction").toPandas()["prediction"].to_numpy()
    monkeypatch.setattr(ml, "NORMAL_FEATURES", normal)
    moments = ml.Moments(train)
    fitted, scaled = moments.features([0], pipeline.getStages()[:-1])
    assert scaled.count() < 10 + 80 < train.count()  # a row per station, and the steps around one
    model = ml.PipelineModel([*fitted, ml._solve(lr, moments, scaled)])
    got = model.transform(test).select("prediction").toPandas()["prediction"].to_numpy()
    np.testing.assert_allclose(got, want, rtol=0, atol=1e-6)
    assert model.stages[-1].getRegParam() == reg


def test_folds_are_scored_by_their_moments(spark):
    train = ml.labelled(moment_rows(spark))
    tuned = ml.tune(train)
    fold = F.pmod(F.xxhash64(F.lit(1), *train.columns), F.lit(3))
    for at in (1, 6):  # with and without an L1 part
        want = []
        for k in range(3):
            stages = ml.demand_stages()
            own = {p: v for p, v in zip([stages.getStages()[-1].getParam(q.name) for q in tuned.grid[at]], tuned.grid[at].values())}
            stages.setStages([*stages.getStages()[:-1], stages.getStages()[-1].copy(own)])
            want.append(ml.evaluate(stages.fit(train.filter(fold != k)).transform(train.filter(fold == k)))["rmse"])
        assert tuned.avgMetrics[at] == pytest.approx(sum(want) / 3, abs=1e-6)
    assert len(tuned.avgMetrics) == 8


def test_scratch_of_a_run_is_dropped(spark):
    import os

    from docksense.session import cut_lineage, new_path, run_folder

    with run_folder(spark, "trial") as folder:
        assert cut_lineage(spark.range(3)).count() == 3
        assert new_path(spark, "x").startswith(folder) and os.listdir(folder)
    assert not os.path.exists(folder)
    assert not new_path(spark, "x").startswith(folder)


def test_normal_equations_hold_for_the_fitted_model_only(spark):
    train, _ = ml.split_days(regression_rows(spark), "date_reported", 0.75)
    model = ml.fit_demand(train, 0.1)
    rows = ml.normal_equations(model, train).collect()
    known = ml.labelled(train)
    assert all(abs(r.gap) < 1e-6 for r in rows)
    assert sum(r.readings for r in rows if r.feature == "hour") == known.count()
    assert {r.value for r in rows if r.feature == "station"} == {
        str(r[0]) if r[0] is not None else None for r in known.select("station_id").distinct().collect()}
    # rows that the model was not fitted on do not solve them
    other = known.withColumn(ml.LABEL, F.col(ml.LABEL) + F.col("hora_dia") % 3)
    assert max(abs(r.gap) for r in ml.normal_equations(model, other).collect()) > 1e-3


def test_zone_gaps(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame(pd.DataFrame({"station_id": range(40), "lat": rng.uniform(41, 42, 40), "lon": rng.uniform(2, 3, 40)}))
    model = ml.fit_zones(df, 5)
    out = ml.zone_gaps(model, df)
    assert out.columns == ["station_id", "lat", "lon", "truck", "gap"]
    assert [r.gap for r in out.collect()] == [0.0] * 40
    assert {(r.station_id, r.truck) for r in ml.cluster_stations(df, 5).collect()} == {(r.station_id, r.truck) for r in out.collect()}
    moved = ml.zone_gaps(model, df.withColumn("lat", F.col("lat") + 0.5)).collect()
    assert all(r.gap == 0 for r in moved)  # zones are those of the places asked for
