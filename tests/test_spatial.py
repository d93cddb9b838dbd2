import json
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from docksense.functions import geometry as geom
from docksense.operators import density, nearest, routes, spatial
from docksense.plans import expansion


def points(spark, xy, key="id"):
    pdf = pd.DataFrame({key: np.arange(len(xy), dtype=np.int64), "x": xy[:, 0], "y": xy[:, 1]})
    return spark.createDataFrame(pdf)


def brute(a, b, k=1):
    d = np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    return np.sort(d, axis=1)[:, :k]


def skewed(rng, n):
    """A third in one place, a third in a tiny spot, the rest spread out."""
    spot = np.array([700.0, 300.0]) + rng.normal(scale=0.01, size=(n // 3, 2))
    return np.concatenate([np.full((n // 3, 2), 500.0), spot, rng.uniform(0, 1000, size=(n - 2 * (n // 3), 2))])


def test_nearest_equals_brute_force_on_skew(spark):
    rng = np.random.default_rng(5)
    a, b = skewed(rng, 600), skewed(rng, 900)
    got = nearest.nearest_distance(points(spark, a), points(spark, b), "d", "id").orderBy("id").toPandas()["d"].to_numpy()
    np.testing.assert_allclose(got, brute(a, b)[:, 0], atol=1e-9)


def test_nearest_other_place(spark):
    rng = np.random.default_rng(6)
    a = np.concatenate([rng.uniform(0, 100, size=(200, 2)), [[5.0, 5.0], [5.0, 5.0]]])
    df = points(spark, a)
    got = nearest.nearest_distance(df, df, "d", "id", exclude_self=True).orderBy("id").toPandas()["d"].to_numpy()
    np.testing.assert_allclose(got, brute(a, a, 2)[:, 1], atol=1e-9)
    assert got[-1] == 0


def test_work_per_query_does_not_grow_with_the_hot_spot(spark):
    rng = np.random.default_rng(7)
    a = points(spark, skewed(rng, 300))

    def pairs(n):
        b = points(spark, skewed(rng, n)).select(F.col("x").alias("bx"), F.col("y").alias("by")).distinct()
        return nearest.candidates(a, ["x", "y"], b, ["bx", "by"], ["bx", "by"]).count()

    assert pairs(9000) < 2 * pairs(900)


def test_shuffled_tree_gives_the_same(spark):
    with_size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled_tree(spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_size)


def shuffled_tree(spark):
    rng = np.random.default_rng(8)
    a, b = rng.uniform(0, 100, size=(100, 2)), rng.uniform(0, 100, size=(400, 2))
    got = nearest.nearest_distance(points(spark, a), points(spark, b), "d", "id").orderBy("id").toPandas()["d"].to_numpy()
    np.testing.assert_allclose(got, brute(a, b)[:, 0], atol=1e-9)


def test_a_layer_is_grouped_once(spark, tmp_path):
    # the search reads its objects in every step; the layer itself was scanned and grouped in each of them
    rng = np.random.default_rng(2)
    path = str(tmp_path / "layer_of_places")
    points(spark, rng.uniform(0, 1000, size=(3000, 2))).write.parquet(path)
    out = nearest.nearest_distance(points(spark, rng.uniform(0, 1000, size=(50, 2))), spark.read.parquet(path), "d", "id")
    assert "layer_of_places" not in out._jdf.queryExecution().toString()
    assert out.filter("d IS NULL").count() == 0


def test_nearest_of_nothing_and_without_place(spark):
    a = points(spark, np.array([[1.0, 1.0], [2.0, 2.0]])).withColumn("x", F.when(F.col("id") == 0, F.col("x")))
    assert [r["d"] for r in nearest.nearest_distance(a, a.limit(0), "d", "id").collect()] == [None, None]
    got = {r["id"]: r["d"] for r in nearest.nearest_distance(a, points(spark, np.array([[1.0, 2.0]])), "d", "id").collect()}
    assert got == {0: 1.0, 1: None}


@pytest.mark.parametrize("n_ref", [3, 60])
def test_knn_mean(spark, n_ref):
    rng = np.random.default_rng(9)
    cols = [f"f{i}" for i in range(7)]
    q, r = rng.normal(size=(80, 7)), rng.normal(size=(n_ref, 7))
    r[1] = r[0]
    qdf = spark.createDataFrame(pd.DataFrame(q, columns=cols).assign(id=np.arange(80)))
    rdf = spark.createDataFrame(pd.DataFrame(r, columns=cols))
    got = nearest.knn_mean(qdf, rdf, "id", cols, 5).orderBy("id").toPandas()["mean_distance"].to_numpy()
    np.testing.assert_allclose(got, brute(q, r, min(5, n_ref)).mean(axis=1), atol=1e-9)


def test_tiles_of_many_features(spark):
    # a cloud, many rows that share all but one value, ties in every feature, and queries far from all of them
    rng = np.random.default_rng(12)
    cols, named = [f"f{i}" for i in range(7)], [f"r_{i}" for i in range(7)]
    flat = np.zeros((210, 7))
    flat[np.arange(210), np.arange(210) % 7] = np.arange(210) % 30 + 1.0
    r = np.unique(np.concatenate([rng.normal(size=(1500, 7)), flat]), axis=0)
    q = np.concatenate([rng.normal(size=(60, 7)), flat[:20], rng.normal(size=(20, 7)) * 40])
    places = spark.createDataFrame(pd.DataFrame(r, columns=named))
    levels, placed = nearest._tiles(places, named, 64)
    sizes = [x["count"] for x in placed.groupBy("_tile").count().collect()]
    assert max(sizes) <= 64 and sum(sizes) == len(r) and len(sizes) <= len(r) / 8
    asked = spark.createDataFrame(pd.DataFrame(q, columns=cols).assign(id=np.arange(100)))
    met = nearest.close_rows(asked, cols, places, named, 5, 64).toPandas()
    got = {i: np.sort(np.sqrt(((g[cols].to_numpy() - g[named].to_numpy()) ** 2).sum(axis=1)))[:5] for i, g in met.groupby("id")}
    np.testing.assert_allclose([got[i] for i in range(100)], brute(q, r, 5), atol=1e-9)
    assert met[met.id < 60].shape[0] < 60 * 150  # of 1 500 and more


def test_knn_mean_compares_a_bounded_part(spark, monkeypatch):
    # the grid's candidates grew with a cell's neighbours (2^7 a level); tiles keep the mean and equal rows
    rng = np.random.default_rng(13)
    cols = [f"f{i}" for i in range(7)]
    q, r = rng.normal(size=(40, 7)), rng.normal(size=(1500, 7))
    r[700:704] = r[3]

    def unused(*_, **__):
        raise AssertionError("cells of a grid in seven dimensions")

    monkeypatch.setattr(nearest, "candidates", unused)
    odd = spark.createDataFrame([(100, None), (101, float("nan"))], "id long, f0 double").withColumns({c: F.lit(0.0) for c in cols[1:]})
    qdf = spark.createDataFrame(pd.DataFrame(q, columns=cols).assign(id=np.arange(40))).unionByName(odd)
    rdf = spark.createDataFrame(pd.DataFrame(r, columns=cols)).unionByName(odd.drop("id"))
    got = {x["id"]: x["mean_distance"] for x in nearest.knn_mean(qdf, rdf, "id", cols, 5).collect()}
    np.testing.assert_allclose([got[i] for i in range(40)], brute(q, r, 5).mean(axis=1), atol=1e-9)
    assert got[100] is None and got[101] is None and len(got) == 42


def test_areas_of_very_different_size(spark):
    rng = np.random.default_rng(10)
    box = [(0.0, 0.0, 1000.0, 1000.0)] + [(x, y, x + s, y + s) for x, y, s in zip(
        rng.uniform(0, 900, 60), rng.uniform(0, 900, 60), rng.choice([0.5, 7.0, 90.0], 60))]
    areas = spark.createDataFrame([(i, *map(float, b)) for i, b in enumerate(box)], "area int, x0 double, y0 double, x1 double, y1 double")
    areas = areas.select("area", geom.rectangle("x0", "y0", "x1", "y1").alias("geometry"))
    xy = skewed(rng, 900)
    got = {tuple(r) for r in spatial.spatial_join_within(points(spark, xy), areas).select("id", "area").collect()}
    want = {(i, j) for i, (x, y) in enumerate(xy) for j, b in enumerate(box) if b[0] < x < b[2] and b[1] < y < b[3]}
    assert got == want


def plain_dbscan(xy, eps, m):
    near = np.hypot(xy[:, None, 0] - xy[None, :, 0], xy[:, None, 1] - xy[None, :, 1]) <= eps
    core = near.sum(axis=1) >= m
    label = np.full(len(xy), -1)
    for i in np.flatnonzero(core):
        if label[i] == -1:
            todo = [i]
            label[i] = i
            while todo:
                j = todo.pop()
                for k in np.flatnonzero(near[j]):
                    if label[k] == -1:
                        label[k] = i
                        if core[k]:
                            todo.append(k)
    return label


@pytest.mark.parametrize("eps, m", [(60.0, 4), (25.0, 2)])
def test_dbscan_equals_the_plain_one(spark, eps, m):
    rng = np.random.default_rng(11)
    xy = np.concatenate([skewed(rng, 240), [[0.0, 0.0], [25.0, 0.0], [50.0, 0.0], [5000.0, 5000.0]]])
    want = plain_dbscan(xy, eps, m)
    df = points(spark, xy, "point_id")
    got = density.dbscan(df, eps, m).orderBy("point_id").toPandas()["cluster"].to_numpy()
    np.testing.assert_array_equal(got, want)


def test_sweep_equals_single_runs(spark):
    rng = np.random.default_rng(4)
    xy = skewed(rng, 200)
    out = {(r["eps"], r["min_samples"]): (r["clusters"], r["noise"]) for r in density.tune_dbscan(
        points(spark, xy, "point_id"), [30.0, 60.0], [2, 5]).collect()}
    for e in (30.0, 60.0):
        for m in (2, 5):
            want = plain_dbscan(xy, e, m)
            assert out[e, m] == (len(set(want) - {-1}), int((want == -1).sum()))


def test_sweep_along_chains(spark):
    """Long chains, which take several rounds of contraction, and a grid of equal distances."""
    line = np.array([(float(i * (1 if i % 50 else 1.2)), 0.0) for i in range(160)])
    grid = np.array([(1000.0 + 10 * i, 5.0 * j) for i in range(7) for j in range(6)])
    xy = np.random.default_rng(2).permutation(np.concatenate([line, grid]))
    eps, ms = [1.0, 2.0, 5.0, 12.0], [2, 3, 5]
    got = {(r["eps"], r["min_samples"]): (r["clusters"], r["noise"]) for r in density.tune_dbscan(points(spark, xy, "point_id"), eps, ms).collect()}
    for e in eps:
        for m in ms:
            want = plain_dbscan(xy, e, m)
            assert got[e, m] == (len(set(want.tolist()) - {-1}), int((want == -1).sum()))


def test_full_cells_in_a_sweep(spark):
    """Cells with very many points, beside thin ones, at distances around every eps; repeated places."""
    rng = np.random.default_rng(4)
    spots = [np.array(c) + rng.uniform(0, 0.5, (60, 2)) for c in ((0, 0), (1.4, 0), (4.2, 0.3), (4.2, 2.9), (9, 9))]
    xy = np.concatenate([*spots, np.repeat([[20.0, 20.0]], 40, axis=0), [[20.9, 20.0], [22.5, 20.0]], rng.uniform(-3, 14, (60, 2))])
    eps, ms = [1.0, 1.5, 3.0], [2, 4, 40]
    got = {(r["eps"], r["min_samples"]): (r["clusters"], r["noise"]) for r in density.tune_dbscan(points(spark, xy, "point_id"), eps, ms).collect()}
    for e in eps:
        for m in ms:
            want = plain_dbscan(xy, e, m)
            assert got[e, m] == (len(set(want.tolist()) - {-1}), int((want == -1).sum())), (e, m)


@pytest.mark.parametrize("close", [256, 20])
def test_sweep_of_many_points_has_cells_for_each_eps(spark, monkeypatch, close):
    rng = np.random.default_rng(6)
    xy = np.concatenate([skewed(rng, 200), rng.uniform(0, 60, (200, 2)), np.repeat([[5000.0, 5000.0]], 3, axis=0)])
    eps, ms = [5.0, 20.0, 60.0], [2, 3, 12]
    monkeypatch.setattr(density, "FEW", 100)
    monkeypatch.setattr(density, "CLOSE", close)
    assert density.searches(points(spark, xy, "point_id"), eps) == [[5.0], [20.0], [60.0]]
    got = {(r["eps"], r["min_samples"]): (r["clusters"], r["noise"]) for r in density.tune_dbscan(points(spark, xy, "point_id"), eps, ms).collect()}
    for e in eps:
        for m in ms:
            want = plain_dbscan(xy, e, m)
            assert got[e, m] == (len(set(want.tolist()) - {-1}), int((want == -1).sum())), (e, m)


def test_pairs_of_a_sweep_grow_with_the_points(spark):
    pairs = []
    for n in (5000, 20000):
        df = points(spark, np.random.default_rng(8).uniform(0, 1000, (n, 2)), "point_id")
        near = [density.Neighbours(df, part, 5) for part in density.searches(df, [10.0, 20.0, 30.0, 40.0, 50.0])]
        pairs.append(sum(x.near.count() + x.links.count() for x in near))
    assert pairs[1] < 6 * pairs[0]


def test_thin_points_meet_a_strip_of_a_full_cell(spark):
    met = []
    for n in (3000, 48000):
        rng = np.random.default_rng(1)
        full = rng.uniform(0, 0.6, (n, 2))
        xy = np.concatenate([full, [[1.2, 0.2], [1.25, 0.5], [1.3, 0.9]]])
        asked = points(spark, xy[n:], "point_id").withColumn("grp", F.lit(0))
        places = points(spark, xy, "point_id").select(F.lit(0).alias("grp"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.lit(1).cast("bigint").alias("on"))
        met.append(nearest.candidates(asked, ["x", "y"], places, ["ox", "oy"], ["ox", "oy"], k=4, weight="on", group="grp").count())
    assert met[0] < 0.15 * 3 * 3000 and met[1] < 0.15 * 3 * 48000


def test_points_without_place_are_noise(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.1, 0.0), (3, None, 0.0), (None, 0.0, 0.0)], "point_id bigint, x double, y double")
    assert {tuple(r) for r in density.dbscan(df, 1.0, 2).select("point_id", "cluster").collect()} == {(1, 1), (2, 1), (3, -1), (None, -1)}


def test_sweep_prefers_the_first_of_equal_scores(spark):
    xy = np.array([[0.0, 0.0], [1.0, 0.0], [2.0, 0.0], [100.0, 0.0], [101.0, 0.0], [102.0, 0.0]])
    got = density.tune_dbscan(points(spark, xy, "point_id"), [1.0, 2.0], [2, 3]).collect()
    assert (got[0]["eps"], got[0]["min_samples"], got[0]["clusters"], got[0]["noise"]) == (1.0, 2, 2, 0)


def fleet(spark, n, trucks=2, seed=12):
    rng = np.random.default_rng(seed)
    truck = np.where(rng.random(n) < 0.7, 0, rng.integers(0, trucks, n))
    pdf = pd.DataFrame({
        "station_id": np.arange(n, dtype=np.int32), "lat": np.round(rng.uniform(41.3, 41.5, n), 3), "lon": np.round(rng.uniform(2.0, 2.2, n), 3),
        "capacity": np.int32(20), "check_status": rng.choice(["low", "full", "sufficient"], n, p=[0.5, 0.3, 0.2]),
        "num_bikes_available": np.int32(3), "bikes_to_refill": np.int32(12), "bikes_to_remove": np.int32(5), "truck": truck.astype(np.int32)})
    return spark.createDataFrame(pdf), pdf


def plain_tour(pdf):
    from docksense.operators.routes import _metres

    todo = pdf.sort_values("station_id").to_dict("records")
    tour = [todo.pop(0)]
    while todo:
        d = [float(_metres(tour[-1]["lon"], tour[-1]["lat"], np.array([s["lon"]]), np.array([s["lat"]]))[0]) for s in todo]
        tour.append(todo.pop(int(np.argmin(d))))
    return [s["station_id"] for s in tour]


@pytest.mark.parametrize("block", [4000, 25])
def test_tours(spark, block):
    df, pdf = fleet(spark, 150)
    out = routes.truck_routes(df, block).toPandas()
    need = pdf[pdf.check_status.isin(["low", "full"])]
    for truck, stops in need.groupby("truck"):
        got = out[out.truck == truck].sort_values("seq")
        assert list(got.station_id[:-1]) == plain_tour(stops)
        assert got.station_id.iloc[0] == got.station_id.iloc[-1] and got.leg_distance.iloc[0] == 0
    totals = {r["truck"]: r for r in routes.route_totals(routes.truck_routes(df, block)).collect()}
    for truck, stops in need.groupby("truck"):
        assert totals[truck]["balance_bicicletas"] == 12 * (stops.check_status == "low").sum() - 5 * (stops.check_status == "full").sum()


def test_index_of_open_stops():
    """The closest open stop at every step, places on a line and repeated places included; the work does not grow."""
    import time

    rng = np.random.default_rng(3)
    for n, digits in ((1, 3), (300, 3), (900, 1), (900, 6)):
        lons, lats = np.round(rng.uniform(2.0, 2.2, n), digits), np.round(rng.uniform(41.3, 41.5, n), digits)
        if n == 900 and digits == 6:
            lons[:400] = 2.1
        stops, open_ = routes.OpenStops(lons, lats), np.ones(n, bool)
        lon, lat = 2.0, 41.3
        for _ in range(n):
            d = np.where(open_, routes._metres(lon, lat, lons, lats), np.inf)
            near = stops.closest(lon, lat)
            i = int(near[routes._metres(lon, lat, lons[near], lats[near]).argmin()])
            assert i == int(d.argmin())
            stops.take(i)
            open_[i], lon, lat = False, lons[i], lats[i]
    seconds = {}
    for n in (1000, 16000):
        pdf = pd.DataFrame({"truck": 1, "station_id": np.arange(n), "lon": rng.uniform(2.0, 2.2, n), "lat": rng.uniform(41.3, 41.5, n),
                            "cur_lon": 2.1, "cur_lat": 41.4, "cur_seq": 0, "horizon": np.inf})
        began = time.process_time()
        assert sorted(routes._walk(pdf).seq) == list(range(1, n + 1))
        seconds[n] = (time.process_time() - began) / n
    assert seconds[16000] < 3 * seconds[1000], seconds


def test_route_id_names_the_order(spark):
    df, _ = fleet(spark, 60)
    tours = routes.truck_routes(df)
    ids = lambda t: {r.key: json.loads(r.value)["route_id"] for r in routes.route_messages(t).collect()}
    assert ids(tours) == ids(tours.withColumn("leg_distance", F.col("leg_distance") * (1 + 1e-12)))


def test_one_stop_has_no_tour_and_two_go_out_and_back(spark):
    df, pdf = fleet(spark, 3)
    rows = [(0, 41.0, 2.0, "low", 0), (1, 41.0, 2.1, "full", 1), (2, 41.0, 2.2, "low", 1)]
    df = spark.createDataFrame(rows, "station_id int, lat double, lon double, check_status string, truck int").select(
        "*", *[F.lit(1).alias(c) for c in ("capacity", "num_bikes_available", "bikes_to_refill", "bikes_to_remove")])
    out = routes.truck_routes(df).orderBy("seq").collect()
    assert [(r["truck"], r["station_id"]) for r in out] == [(1, 1), (1, 2), (1, 1)]
    assert out[1]["leg_distance"] == pytest.approx(out[2]["leg_distance"])


def test_closest_partner_equals_brute_force(spark):
    df, pdf = fleet(spark, 120)
    need = pdf[pdf.check_status.isin(["low", "full"])]
    for r in routes.intervention_edges(df).collect():
        me = need[need.station_id == r["station_id"]].iloc[0]
        mates = need[(need.truck == me.truck) & (need.station_id != me.station_id)]
        d = routes._metres(me.lon, me.lat, mates.lon.to_numpy(), mates.lat.to_numpy())
        assert r["degree"] == len(mates) and r["distance"] == pytest.approx(d.min(), abs=1e-3)


@pytest.mark.parametrize("block", [512, 7])
def test_every_pair_of_a_truck_is_listed_once(spark, block):
    df, pdf = fleet(spark, 120, trucks=4)
    need = pdf[pdf.check_status.isin(["low", "full"])]
    want = {}
    for truck, mates in need.groupby("truck"):
        for a in mates.itertuples():
            for b in mates[mates.station_id > a.station_id].itertuples():
                want[truck, a.station_id, b.station_id] = float(routes._metres(a.lon, a.lat, np.array([b.lon]), np.array([b.lat]))[0])
    got = routes.intervention_edges(df, block).collect()
    assert len(got) == len(want) > 2000
    assert {(r["truck"], r["station_id"], r["other_id"]): r["pair_distance"] for r in got} == pytest.approx(want, abs=1e-4)
    closest = {}
    for (truck, a, b), d in want.items():
        for me, mate in ((a, b), (b, a)):
            closest[truck, me] = min(closest.get((truck, me), (np.inf, 0)), (d, mate))
    for r in got:
        for me, mate, d in (("station_id", "closest_id", "distance"), ("other_id", "other_closest_id", "other_distance")):
            best = closest[r["truck"], r[me]]
            assert (r[d], r[mate]) == (pytest.approx(best[0], abs=1e-4), best[1])


def test_pairs_of_repeated_rows_and_of_stations_without_a_place(spark):
    rows = [(1, 1, 2.0, 41.0), (1, 1, 2.0, 41.0), (1, 2, 2.1, 41.0), (1, 3, None, 41.0), (2, 4, 2.1, 41.0), (2, 4, 2.0, 41.0),
            (2, 5, 2.2, 41.0), (3, 6, 2.0, 41.0), (3, 6, 2.0, 41.0), (4, 7, None, None), (4, 8, 2.0, 41.0), (None, 9, 2.0, 41.0),
            (None, 10, 2.0, 41.0), (5, None, 2.0, 41.0), (5, 11, 2.0, 41.0)]
    df = spark.createDataFrame(rows, "truck int, station_id int, lon double, lat double").withColumn("check_status", F.lit("low"))
    tenth, fifth = (float(routes._metres(2.0, 41.0, np.array([lon]), np.array([41.0]))[0]) for lon in (2.1, 2.2))
    got = sorted(routes.intervention_edges(df, 1).collect(), key=lambda r: (r["station_id"], r["other_id"], r["pair_distance"] or 0.0))
    assert [(r["station_id"], r["other_id"], r["degree"], r["closest_id"], r["other_closest_id"]) for r in got] == [
        (1, 2, 4, 2, 1), (1, 2, 4, 2, 1), (1, 3, 4, 2, None), (1, 3, 4, 2, None), (2, 3, 3, 1, None),
        (4, 5, 2, 5, 4), (4, 5, 2, 5, 4), (7, 8, 1, None, None)]
    assert [r["pair_distance"] for r in got] == [
        pytest.approx(d, abs=1e-4) if d else None for d in (tenth, tenth, None, None, None, tenth, fifth, None)]
    assert [r["distance"] for r in got if r["station_id"] == 4] == [pytest.approx(tenth, abs=1e-4)] * 2


def in_ring(x, y, xs, ys):
    inside = False
    for x1, y1, x2, y2 in zip(xs, ys, np.roll(xs, -1), np.roll(ys, -1)):
        if (y1 > y) != (y2 > y) and x < x1 + (x2 - x1) * (y - y1) / (y2 - y1):
            inside = not inside
    return inside


@pytest.mark.parametrize("vertices", [100, 3000])
def test_points_meet_the_edges_of_their_band_only(spark, vertices):
    from docksense.functions import geometry as geom

    rng = np.random.default_rng(vertices)
    angle = np.linspace(0, 2 * np.pi, vertices, endpoint=False)
    radius = 100 * (1 + 0.2 * np.sin(9 * angle))
    xs, ys = radius * np.cos(angle), radius * np.sin(angle)
    ring = [(float(x), float(y)) for x, y in zip([*xs, xs[0]], [*ys, ys[0]])]
    hole = [(-10.0, -10.0), (10.0, -10.0), (10.0, 10.0), (-10.0, 10.0), (-10.0, -10.0)]
    flat = [(200.0, 5.0), (210.0, 5.0), (205.0, 5.0), (200.0, 5.0)]
    shapes = spark.createDataFrame([(1, [ring, hole]), (2, [flat]), (3, [ring, hole])], "area_id int, rings array<array<struct<x:double,y:double>>>")
    areas = shapes.select("area_id", geom.geometry(F.lit("POLYGON"), F.col("rings")).alias("geometry"))
    pts = rng.uniform(-130, 130, (400, 2)).tolist() + [[0.0, 0.0], [10.0, 0.0], [205.0, 5.0]]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "id int, x double, y double")
    got = {(r.id, r.area_id) for r in spatial.spatial_join_within(df, areas).select("id", "area_id").collect()}
    hx, hy = np.array([p[0] for p in hole[:-1]]), np.array([p[1] for p in hole[:-1]])
    want = {i for i, (x, y) in enumerate(pts[:400]) if in_ring(x, y, xs, ys) and not in_ring(x, y, hx, hy)}
    assert got == {(i, a) for i in want for a in (1, 3)}
    edge = spatial.spatial_join_within(df, areas, boundary=True).filter("id >= 400").select("id", "area_id")
    assert {tuple(r) for r in edge.collect()} == {(401, 1), (401, 3), (402, 2)}
    held = spatial.edge_bands(areas).select(F.avg(F.size("_edges")).alias("n"), F.max(F.size("_edges")).alias("most")).first()
    assert held.n < 4 * spatial.BAND_EDGES


def test_quantiles_of_all_columns_share_their_scans(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"a": rng.normal(size=3000), "b": np.where(rng.random(3000) < 0.6, 7.0, rng.exponential(size=3000)),
                        "c": rng.integers(0, 5, 3000).astype(float), "d": np.nan})
    df = spark.createDataFrame(pdf).withColumn("d", F.lit(None).cast("double"))

    def jobs(group, cols):
        spark.sparkContext.setJobGroup(group, group)
        got = spatial.column_quantiles(df, cols, [0.1, 0.25, 0.5, 0.99], 64)
        spark.sparkContext.setJobGroup("tests", "tests")
        return got, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    got, n = jobs("all", ["a", "b", "c", "d"])
    for c in "abc":
        assert got[c] == pytest.approx(list(pdf[c].quantile([0.1, 0.25, 0.5, 0.99])))
    assert got["d"] == [None] * 4
    assert n == max(jobs(c, [c])[1] for c in "abc")


def test_scale_of_constant_feature(spark):
    ref = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = spatial.scale_like(ref, ref, ["a", "b"]).collect()
    assert [tuple(r) for r in got] == [(-1.0, 0.0), (1.0, 0.0)]


def test_propose_sites(spark):
    rng = np.random.default_rng(13)
    box = spark.range(1).select(geom.rectangle(F.lit(0.0), F.lit(0.0), F.lit(3000.0), F.lit(3000.0)).alias("geometry"))
    stations = points(spark, rng.uniform(0, 3000, size=(12, 2)), "station_id")
    layers = {n: points(spark, rng.uniform(0, 3000, size=(30, 2))).select("x", "y") for n in expansion.POINT_LAYERS.values()}
    lane = spark.range(1).select(F.array(*[F.struct(F.lit(a).alias("x"), F.lit(a).alias("y")) for a in (0.0, 3000.0)]).alias("path"))
    out = expansion.propose_sites(stations.limit(6), stations, layers, lane, box, step=100.0).collect()
    assert out and all(r["dist_bike_station"] > 200 and r["dist_bike_lanes"] < 60 for r in out)
    assert len({r["cluster"] for r in out}) == len(out)


def segments(spark, ends):
    rows = [([(float(a), float(b)), (float(c), float(d))],) for a, b, c, d in ends]
    return spark.createDataFrame(rows, "path array<struct<x:double,y:double>>")


def to_segments(p, s):
    a, d = s[:, :2], s[:, 2:] - s[:, :2]
    t = ((p[:, None, :] - a) * d).sum(axis=2) / np.maximum((d * d).sum(axis=1), 1e-300)
    near = a + np.clip(t, 0, 1)[:, :, None] * d
    return np.sqrt(((p[:, None, :] - near) ** 2).sum(axis=2)).min(axis=1)


def test_long_segments_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    p, s = rng.uniform(0, 1000, size=(200, 2)), rng.uniform(0, 1000, size=(300, 4))
    s[0, 2:] = s[0, :2]  # a segment of one point
    lines = segments(spark, s).union(segments(spark, [(0, 0, float("inf"), 5), (float("nan"), 1, 2, 3)]))
    got = nearest.line_distance(points(spark, p), lines, "d", "id").orderBy("id").toPandas()
    assert np.allclose(got.d.to_numpy(), to_segments(p, s), atol=1e-6)
    none = nearest.line_distance(points(spark, p[:2]), lines.limit(0), "d", "id").collect()
    assert [r.d for r in none] == [None, None]


def test_lines_within_a_radius_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    p, s = rng.uniform(-500, 1000, size=(400, 2)), rng.uniform(-300, 1000, size=(12, 4))
    s[0, 2:] = s[0, :2]
    p[:40] = s[1, :2] + rng.normal(scale=30, size=(40, 2))
    p[40] = s[2, :2]
    lines = segments(spark, np.concatenate([s, s])).union(segments(spark, [(0, 0, float("inf"), 5), (float("nan"), 1, 2, 3)]))
    for radius in (60.0, 7.5):
        got = {r.id: r.d for r in nearest.line_distance_within(points(spark, p), lines, "d", "id", radius).collect()}
        true = to_segments(p, s)
        assert set(got) == set(np.flatnonzero(true < radius).tolist()) and len(got) > 5
        assert np.allclose([got[i] for i in sorted(got)], true[sorted(got)], atol=1e-6)
    assert nearest.line_distance_within(points(spark, p), lines.limit(0), "d", "id", 60.0).count() == 0


def test_farther_than_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    p, o = skewed(rng, 300) - 400, skewed(rng, 60) - 400
    p[0], o[-1] = (-600.0, 0.0), (-800.0, 0.0)  # exactly the radius apart: not farther
    odd = spark.createDataFrame([(None, 1.0), (float("nan"), 2.0), (float("inf"), 0.0)], "x double, y double")
    objects = points(spark, o).select("x", "y").union(odd)
    extra = points(spark, p).withColumn("_note", F.lit("kept"))
    got = nearest.farther_than(extra, objects, 200.0)
    assert got.columns == extra.columns
    assert {r.id for r in got.collect()} == set(np.flatnonzero(brute(p, o)[:, 0] > 200).tolist()) != set()
    assert nearest.farther_than(extra, objects.limit(0), 200.0).count() == len(p)


def test_candidates_per_point_stay_few_with_more_long_segments(spark):
    rng = np.random.default_rng(4)
    p = points(spark, rng.uniform(0, 1000, size=(100, 2)))
    met = []
    for n in (200, 2000):
        seg = spark.createDataFrame(pd.DataFrame(rng.uniform(0, 1000, size=(n, 4)), columns=["sx1", "sy1", "sx2", "sy2"]))
        pairs = nearest.candidates(p, ["x", "y"], nearest.short_pieces(seg), ["slox", "sloy"], ["shix", "shiy"])
        met.append(pairs.count() / 100)
    assert met[1] < 1.5 * met[0]  # of 1 441 and 42 783 pieces


def test_registered_site_selection_step(spark, sf_dir, monkeypatch):
    import __spark_entry__ as entry_module

    class Seen(Exception):
        pass

    def seen(*_, step=10.0, **__):
        raise Seen(step)

    monkeypatch.setattr(expansion, "propose_sites", seen)
    with pytest.raises(Seen) as caught:
        entry_module.queries()["j10_site_selection"](spark, sf_dir)
    assert caught.value.args == (10.0,)
