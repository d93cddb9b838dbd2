"""Expansion: popular stations, area densities and proposed sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docksense.functions import geo
from docksense.functions import geometry as geom
from docksense.operators import aggs, clean, density, nearest, spatial
from docksense.session import cut_lineage

POINT_LAYERS = {
    "dist_education": "education", "dist_shopping": "shopping", "dist_cpoi": "cpoi",
    "dist_bus_stops": "bus_stops", "dist_metro_stations": "metro_stations",
}


def find_popular(docs: DataFrame, k: int = 10) -> DataFrame:
    """Stations most often empty, most often full, and with most movement, with their reasons."""
    return aggs.popular_stations(
        aggs.shortage_stations(docs, "num_bikes_available", k),
        aggs.shortage_stations(docs, "num_docks_available", k),
        aggs.rotation_stations(docs, k),
    )


def with_plane(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """UTM ``x`` and ``y`` metres."""
    x, y = geo.to_utm31(lon, lat)
    return df.withColumns({"x": x, "y": y})


def plane_geometry(df: DataFrame, col: str = "geometry") -> DataFrame:
    """Geometry in degrees to UTM metres."""
    def move(p):
        x, y = geo.to_utm31(p.x, p.y)
        return F.struct(x.alias("x"), y.alias("y"))

    rings = F.transform(F.col(col).rings, lambda r: F.transform(r, move))
    return df.withColumn(col, geom.geometry(F.col(col).kind, rings, F.col(col).parts))


def site_distances(points: DataFrame, layers: dict[str, DataFrame], key: str) -> DataFrame:
    """Distances to the five point layers."""
    return nearest.nearest_distances(points, {col: layers[layer] for col, layer in POINT_LAYERS.items()}, key)


def propose_sites(top: DataFrame, stations: DataFrame, layers: dict[str, DataFrame], lanes: DataFrame, areas: DataFrame,
                  step: float = 10.0, min_station: float = 200.0, max_lane: float = 60.0, k: int = 5, best: int = 100,
                  eps: tuple = (50.0, 100.0, 150.0, 200.0, 250.0), min_samples: tuple = (2, 3, 4, 5),
                  exclude_self: bool = True) -> DataFrame:
    """Sites whose surroundings resemble those of popular stations; one per density cluster.

    All tables are in plane metres (``x``, ``y``; ``path``; ``geometry``). Lattice points too close to a station
    or too far from a lane leave by joins of cells of that size, before any nearest object is searched for.
    """
    spark = top.sparkSession
    stations = cut_lineage(stations.select("x", "y"))
    box = aggs.total_bounds(areas).first()
    grid = spatial.candidate_grid(spark, (box["xmin"], box["ymin"], box["xmax"], box["ymax"]), step)
    # every step reads its input more than once, so each result is written before the next one
    sites = cut_lineage(nearest.farther_than(
        nearest.line_distance_within(grid, lanes, "dist_bike_lanes", "point_id", max_lane), stations, min_station))
    inside = spatial.spatial_join_within(sites.select("point_id", "x", "y"), areas.select("geometry")).select("point_id").distinct()
    sites = cut_lineage(sites.join(inside, "point_id"))
    sites = nearest.nearest_distance(sites, stations, "dist_bike_station", "point_id")
    sites = cut_lineage(clean.site_filters(sites, min_station, max_lane))

    top = cut_lineage(top.select("station_id", "x", "y"))
    popular = nearest.nearest_distance(top, stations, "dist_bike_station", "station_id", exclude_self=exclude_self)
    popular = nearest.line_distance(popular, lanes, "dist_bike_lanes", "station_id")

    # lattice points and popular stations share the search in the five point layers
    near = ["x", "y", "dist_bike_station", "dist_bike_lanes"]
    tagged = sites.select(F.lit("site").alias("kind"), F.col("point_id").cast("bigint").alias("id"), *near).unionByName(
        popular.select(F.lit("popular").alias("kind"), F.col("station_id").cast("bigint").alias("id"), *near))
    tagged = cut_lineage(tagged.withColumn("row_id", F.concat_ws(":", "kind", "id")))
    measured = cut_lineage(site_distances(tagged, layers, "row_id"))
    popular = measured.filter(F.col("kind") == "popular")
    sites = measured.filter(F.col("kind") == "site").withColumnRenamed("id", "point_id").drop("kind", "row_id")

    scaled_top = spatial.scale_like(popular, popular.select(*aggs.DISTANCES), aggs.DISTANCES)
    scaled = spatial.scale_like(popular, sites.select("point_id", *aggs.DISTANCES), aggs.DISTANCES)
    scored = nearest.knn_mean(scaled, scaled_top, "point_id", aggs.DISTANCES, k).select(
        "point_id", nearest.similarity("mean_distance").alias("similarity_score"))
    ranked = cut_lineage(aggs.top_k(sites.join(scored, "point_id"), "similarity_score", best, "point_id"))

    setting = density.tune_dbscan(ranked, list(eps), list(min_samples)).first()
    if setting is None:
        return ranked.limit(0).withColumn("cluster", F.lit(None).cast("bigint"))
    clusters = clean.drop_noise(density.dbscan(ranked, setting["eps"], setting["min_samples"]))
    chosen = aggs.best_per_cluster(clusters)
    lon, lat = geo.from_utm31("x", "y")
    return chosen.withColumns({"lon": lon, "lat": lat, "geometry": geom.point_json(lon, lat)})
