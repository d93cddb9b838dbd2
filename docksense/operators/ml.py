"""Zones and demand regression with Spark ML."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docksense.session import cut_lineage

LABEL = "total_bikes_taken"
NUMERIC = ["laborable", "temperatura", "precipitacion", "humedad", "viento"]


def cluster_stations(df: DataFrame, k: int = 25, seed: int = 1) -> DataFrame:
    """k-means zones on (lat, lon); the zone number is the truck id."""
    return fit_zones(df, k, seed).transform(df).drop("_xy")


def fit_zones(df: DataFrame, k: int = 25, seed: int = 1) -> PipelineModel:
    gather = VectorAssembler(inputCols=["lat", "lon"], outputCol="_xy")
    return Pipeline(stages=[gather, KMeans(k=k, seed=seed, featuresCol="_xy", predictionCol="truck")]).fit(df)


def zone_gaps(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with its zone and ``gap``: how much farther (squared) the zone's centre is than the closest centre, 0 if it is that."""
    centres = [(float(lat), float(lon)) for lat, lon in model.stages[-1].clusterCenters()]
    far = F.array(*[F.pow(F.col("lat") - lat, 2) + F.pow(F.col("lon") - lon, 2) for lat, lon in centres])
    return model.transform(df).withColumn("gap", F.get(far, F.col("truck")) - F.array_min(far)).drop("_xy")


def truck_table(spark: SparkSession, k: int = 25, capacity: int = 30) -> DataFrame:
    return spark.range(k).select(F.col("id").cast("int").alias("truck_id"), F.lit(capacity).alias("capacity"))


def demand_stages(reg_param: float = 0.1) -> Pipeline:
    """Impute, index, one-hot, assemble, scale and regress.

    A missing number takes the mean of the training rows, so no reading is left out for one. Features are scaled but not
    centred, which keeps the one-hot vectors sparse; centring would only move the intercept. Stations or seasons that are
    missing or unseen in training fall into an extra category.
    """
    filled = [f"{c}_filled" for c in NUMERIC]
    impute = Imputer(strategy="mean", inputCols=NUMERIC, outputCols=filled)
    index = StringIndexer(inputCols=["season", "station_id"], outputCols=["season_index", "station_index"], handleInvalid="keep")
    encode = OneHotEncoder(inputCols=["season_index", "station_index", "hora_dia"],
                           outputCols=["season_vec", "station_vec", "hora_vec"], handleInvalid="keep")
    assemble = VectorAssembler(inputCols=["hora_vec", "season_vec", "station_vec", *filled], outputCol="features")
    scale = StandardScaler(inputCol="features", outputCol="scaled_features", withMean=False, withStd=True)
    regress = LinearRegression(featuresCol="scaled_features", labelCol=LABEL, regParam=reg_param)
    return Pipeline(stages=[impute, index, encode, assemble, scale, regress])


def split_days(df: DataFrame, date_col: str, share: float = 2 / 3) -> tuple[DataFrame, DataFrame]:
    """Training rows and hold-out rows: the first ``share`` of the days that the table spans, and the others.

    Every row is in one of the two; one without a date trains.
    """
    span = df.agg(F.min(date_col).alias("first"), (F.datediff(F.max(date_col), F.min(date_col)) + 1).alias("days")).first()
    if span["first"] is None:
        return df, df.limit(0)
    late = F.datediff(F.col(date_col), F.lit(span["first"])) >= max(1, round(span["days"] * share))
    late = F.coalesce(late, F.lit(False))
    return df.filter(~late), df.filter(late)


def labelled(df: DataFrame) -> DataFrame:
    """Rows whose demand is known; the others can be predicted, but neither fitted nor scored."""
    return df.filter(F.col(LABEL).isNotNull() & ~F.isnan(F.col(LABEL).cast("double")))


#: Up to so many features Spark solves the normal equations, whose deviations are those of the population.
NORMAL_FEATURES = 4096
FILLED = [f"{c}_filled" for c in NUMERIC]


class Moments:
    """Sums of the training rows, of which a least-squares fit needs no more: its loss and all that scales it follow from
    the first and second moments of the features.

    Per fold and station one row with the sums of the hours, the seasons, the numbers (0 where missing), what is missing of
    each, and the label; per fold the products of all of them within the stations. ``rows`` turns the moments of some folds
    into weighted rows with the same moments: a station's mean, weighted by its readings, and for the products a few places
    around the mean of the largest station. So a fit passes over the stations, not over the readings.
    """

    def __init__(self, train: DataFrame, folds: int = 1) -> None:
        self.folds = folds
        gone = {c: F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in NUMERIC}
        values = {**{f"v{i}": F.when(gone[c], 0.0).otherwise(F.col(c).cast("double")) for i, c in enumerate(NUMERIC)},
                  **{f"m{i}": gone[c].cast("double") for i, c in enumerate(NUMERIC)}, "y": F.col(LABEL).cast("double")}
        # a fold is drawn from the row itself, so that every pass over the rows draws the same
        fold = F.pmod(F.xxhash64(F.lit(1), *train.columns), F.lit(folds)).cast("int")
        rows = train.select(fold.alias("fold"), "station_id", "season", "hora_dia", *[v.alias(c) for c, v in values.items()])
        names = list(values)
        pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
        # a row per fold, season and hour
        self.small = small = rows.groupBy("fold", "season", "hora_dia").agg(
            F.count("*").alias("n"), *[F.sum(c).alias(c) for c in names],
            *[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"p{i}_{j}") for i, j in pairs]).collect()
        self.spark = train.sparkSession
        seasons = sorted({r.season for r in small}, key=lambda v: (v is not None, v))
        self.hours = range(1 + max((r.hora_dia for r in small if r.hora_dia is not None), default=-1))
        self.seasons = seasons
        k, h = len(names), len(self.hours)
        self.width = h + len(seasons) + k
        of_season = [F.sum(F.col("season").eqNullSafe(F.lit(v)).cast("double")) for v in seasons]
        of_hour = [F.sum((F.col("hora_dia") == i).cast("double")) for i in self.hours]
        sums = F.array(*of_hour, *of_season, *[F.sum(c) for c in names])
        self.stations = cut_lineage(rows.groupBy("fold", "station_id").agg(F.count("*").cast("double").alias("n"), sums.alias("sums")))
        products = {f: np.zeros((self.width, self.width)) for f in range(folds)}
        for r in small:
            at, sums_ = [seasons.index(r.season) + h], np.array([r[c] for c in names])
            if r.hora_dia is None:
                raise ValueError("a reading has no hour")
            m, at = products[r.fold], [r.hora_dia, *at]
            for x in at:
                for z in at:
                    m[x, z] += r.n
                m[x, h + len(seasons):] += sums_
                m[h + len(seasons):, x] += sums_
            for i, j in pairs:
                x, z = h + len(seasons) + i, h + len(seasons) + j
                m[x, z] += r[f"p{i}_{j}"]
                if x != z:
                    m[z, x] += r[f"p{i}_{j}"]
        self.total = products
        # what the stations' means leave of the products
        self.within = {f: m.copy() for f, m in products.items()}
        for r in self.stations.mapInPandas(_mean_products(self.width), "fold int, m array<double>").groupBy("fold").agg(
                Summarizer.sum(array_to_vector("m")).alias("m")).collect():
            self.within[r.fold] -= r.m.toArray().reshape(self.width, self.width)

    def means(self, folds: list[int]) -> list[float | None]:
        """Training mean of every number, of the readings that have it."""
        rows = [r for r in self.small if r.fold in folds]
        known = [sum(r.n - r[f"m{i}"] for r in rows) for i in range(len(NUMERIC))]
        return [sum(r[f"v{i}"] for r in rows) / n if n else None for i, n in enumerate(known)]

    def rows(self, folds: list[int], means: list[float], seasons: list[str]) -> DataFrame:
        """station_id, hora_vec, season_vec, the filled numbers, label and weight: rows with the moments of these folds.

        ``seasons`` are in the order of their index; others share the place behind them.
        """
        h, known, k = len(self.hours), len(self.seasons), len(NUMERIC)
        places = [seasons.index(v) if v in seasons else len(seasons) for v in self.seasons]
        wide = h + len(seasons) + 1 + k + 1
        # missing numbers take the mean, which keeps every moment a linear map of the sums
        a = np.zeros((wide, self.width))
        a[range(h), range(h)] = 1
        for i, p in enumerate(places):
            a[h + p, h + i] = 1
        for i in range(k):
            a[wide - 1 - k + i, h + known + i], a[wide - 1 - k + i, h + known + k + i] = 1, means[i]
        a[wide - 1, h + known + 2 * k] = 1
        own = self.stations.filter(F.col("fold").isin(folds))
        mean = [F.col("sums")[i] / F.col("n") for i in range(self.width)]
        points = [sum((mean[j] * float(a[i, j]) if a[i, j] != 1 else mean[j] for j in np.nonzero(a[i])[0]), F.lit(0.0)) for i in range(wide)]
        steps = _steps(a @ sum(self.within[f] for f in folds) @ a.T, np.diag(a @ sum(self.total[f] for f in folds) @ a.T))
        out = own.select("fold", "station_id", "n", F.array(*points).alias("z"))
        if len(steps):
            largest = own.orderBy(F.desc("n"), "fold", "station_id").select("fold", "station_id", "n").first()
            share = largest.n / (2 * len(steps))
            around = [(sign * d / math.sqrt(2 * share)).tolist() for d in steps for sign in (1, -1)]
            around = self.spark.createDataFrame([(largest.fold, largest.station_id, share, d) for d in around],
                                                f"fold int, {own.select('station_id').schema.simpleString()[7:-1].replace(':', ' ')}, share double, d array<double>")
            here = (F.col("fold") == largest.fold) & F.col("station_id").eqNullSafe(F.lit(largest.station_id))
            moved = out.filter(here).crossJoin(around.select("share", "d")).select(
                "fold", "station_id", F.col("share").alias("n"), F.zip_with("z", "d", lambda x, y: x + y).alias("z"))
            out = out.filter(~here).unionByName(moved)
        z = lambda i, n: array_to_vector(F.slice("z", i + 1, n))
        return out.select(
            "station_id", z(0, h).alias("hora_vec"), z(h, len(seasons) + 1).alias("season_vec"),
            *[F.col("z")[wide - 1 - k + i].alias(c) for i, c in enumerate(FILLED)], F.col("z")[wide - 1].alias(LABEL), F.col("n").alias("weight"))

    def features(self, folds: list[int], stages: list) -> tuple[list, DataFrame]:
        """The fitted stages before the regression, and the weighted rows with their scaled features."""
        impute, index, encode, assemble, scale = stages
        spark, means = self.spark, self.means(folds)
        names = ", ".join(f"`{c}` double" for c in NUMERIC)
        impute = impute.fit(spark.createDataFrame([tuple(means)], names))
        rows = [(r.season, r.hora_dia) for r in self.small if r.fold in folds]
        keys = self.stations.filter(F.col("fold").isin(folds)).select("station_id").distinct()
        keys = keys.withColumns({"season": F.lit(None).cast("string"), "hora_dia": F.lit(0)}).unionByName(
            spark.createDataFrame(rows, "season string, hora_dia int"), allowMissingColumns=True)
        index = index.fit(keys)
        encode = encode.fit(index.transform(keys))
        seasons = list(index.labelsArray[0])
        out = self.rows(folds, means, seasons)
        gathered = assemble.transform(self._station_vec(out, index, encode))
        # deviations of the readings: those of the weighted rows have another divisor
        s = gathered.agg(Summarizer.metrics("std").summary(F.col("features"), F.col("weight")).alias("s"),
                         F.sum("weight").alias("n"), F.sum(F.col("weight") ** 2).alias("n2")).first()
        self.correction = math.sqrt(max(s.n - 1, 0) / (s.n - s.n2 / s.n)) if s.n - s.n2 / s.n > 0 else 1.0
        half = s.s["std"].toArray() / self.correction / math.sqrt(2) if self.correction else s.s["std"].toArray()
        scale = scale.fit(spark.createDataFrame([(Vectors.dense(half),), (Vectors.dense(-half),)], ["features"]))
        return [impute, index, encode, assemble, scale], _written(scale.transform(gathered))

    @staticmethod
    def _station_vec(rows: DataFrame, index, encode) -> DataFrame:
        """``station_vec`` of the fitted stages; the other two vectors are means over a station's rows."""
        coded = encode.transform(index.transform(rows.withColumnsRenamed({"hora_vec": "_h", "season_vec": "_s"}).withColumns(
            {"season": F.lit(None).cast("string"), "hora_dia": F.lit(0)})))
        return coded.drop("hora_vec", "season_vec", "hora_dia", "season").withColumnsRenamed({"_h": "hora_vec", "_s": "season_vec"})


def _written(rows: DataFrame) -> DataFrame:
    """Scaled rows as a table of their own: a task of the solver need not get the labels and names of all features."""
    return cut_lineage(rows.select(F.col("scaled_features").alias("scaled_features", metadata={}), LABEL, "weight"))


def _mean_products(width: int):
    """Per fold the products of the stations' means, weighted by their readings."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for fold, own in pdf.groupby("fold"):
                sums = np.stack(own["sums"].to_numpy())
                total[fold] = total.get(fold, np.zeros((width, width))) + (sums / own["n"].to_numpy()[:, None]).T @ sums
        yield pd.DataFrame({"fold": pd.Series(list(total), dtype="int32"), "m": [m.ravel() for m in total.values()]})

    return run


def _steps(within: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Vectors whose products add up to the matrix; what is only rounding of the total is 0."""
    d = np.where(np.diag(within) > 1e-12 * total, np.diag(within), 0.0)
    some = np.nonzero(d)[0]
    if not len(some):
        return np.zeros((0, len(d)))
    by = np.sqrt(d[some])
    size, axes = np.linalg.eigh(within[np.ix_(some, some)] / by[:, None] / by[None, :])
    keep = size > 1e-12 * size[-1]
    out = np.zeros((int(keep.sum()), len(d)))
    out[:, some] = (axes[:, keep] * np.sqrt(size[keep])).T * by
    return out


def _solve(regress: LinearRegression, moments: Moments, scaled: DataFrame, params: dict | None = None):
    """The regression on weighted rows, as it would be on the readings."""
    regress = regress.copy(params or {})
    strength = regress.getRegParam()
    if len(scaled.select("scaled_features").first()[0]) > NORMAL_FEATURES:
        regress = regress.copy({regress.regParam: strength / moments.correction})
    model = regress.setWeightCol("weight").fit(scaled)
    return model.copy({model.regParam: strength})


def fit_demand(train: DataFrame, reg_param: float = 0.1) -> PipelineModel:
    """The stages fitted to the readings by their moments: a few passes over them, however many steps the solver takes."""
    moments = Moments(labelled(train))
    *stages, regress = demand_stages(reg_param).getStages()
    fitted, scaled = moments.features([0], stages)
    return PipelineModel([*fitted, _solve(regress, moments, scaled)])


def normal_equations(model: PipelineModel, train: DataFrame) -> DataFrame:
    """feature, value, readings, taken, gap: one row per hour, season and station of the training rows.

    ``gap`` is the gradient of the fitted loss for that one-hot column, the mean of column times residual less the ridge
    term; 0 for a solved model. The row ``intercept`` has the mean residual, which no ridge term pulls at. Holds for
    models without an L1 part.
    """
    encoder, scaler, line = (model.stages[i] for i in (2, 4, 5))
    seasons, stations = model.stages[1].labelsArray
    hours = range(encoder.categorySizes[2])
    known = [("hour", str(v)) for v in hours] + [("season", v) for v in seasons] + [("season", None)]
    known += [("station", v) for v in stations] + [("station", None)]
    weights = [(*name, float(w), float(s)) for name, w, s in zip(known, line.coefficients, scaler.std)]
    weights = train.sparkSession.createDataFrame(weights, "_f string, _v string, weight double, spread double")
    rows = model.transform(labelled(train)).withColumn("off", F.col(LABEL) - F.col("prediction"))
    values = {"hour": "hora_dia", "season": "season", "station": "station_id", "intercept": None}
    each = F.explode(F.array(*[
        F.struct(F.lit(k).alias("feature"), (F.col(c) if c else F.lit("")).cast("string").alias("value")) for k, c in values.items()]))
    sums = rows.select(each.alias("f"), LABEL, "off").groupBy("f.feature", "f.value").agg(
        F.count("*").alias("readings"), F.sum(LABEL).alias("taken"), F.sum("off").alias("off"))
    all_rows = rows.agg(F.struct(F.count("*").alias("n"), F.stddev_pop(LABEL).alias("sd"))).scalar()
    same = (F.col("feature") == F.col("_f")) & F.col("value").eqNullSafe(F.col("_v"))
    out = sums.join(weights, same, "left").withColumn("all", all_rows)
    share = F.col("readings") / F.col("all.n")
    ridge = line.getRegParam() * F.col("weight") * share * (1 - share) / F.col("spread") ** 2 / F.col("all.sd")
    gap = F.when(F.col("feature") == "intercept", F.col("off") / F.col("all.n")).when(
        F.col("spread") == 0, 0.0).otherwise(F.col("off") / F.col("all.n") / F.col("spread") - ridge)  # a constant column is scaled to 0
    return out.select("feature", "value", "readings", "taken", gap.alias("gap"))


@dataclass
class Tuned:
    """The best model of a grid, with the mean score of every point."""

    bestModel: PipelineModel
    avgMetrics: list[float]
    grid: list[dict]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.bestModel.transform(df)

    def getEstimatorParamMaps(self) -> list[dict]:
        return self.grid


def tune(train: DataFrame, folds: int = 3) -> Tuned:
    """Two values each of regularisation, elastic net mix and iterations, by cross-validated RMSE.

    Every fold has stages of its own, fitted to the rows outside it. Fits and scores pass over the folds' moments.
    """
    *stages, lr = demand_stages().getStages()
    grid = (
        ParamGridBuilder().addGrid(lr.regParam, [0.01, 0.1]).addGrid(lr.elasticNetParam, [0.0, 1.0])
        .addGrid(lr.maxIter, [10, 20]).build()
    )
    judge = RegressionEvaluator(labelCol=LABEL, predictionCol="prediction", metricName="rmse", weightCol="weight")
    moments = Moments(labelled(train), folds)
    scores = np.zeros((folds, len(grid)))
    for fold in range(folds):
        others = [f for f in range(folds) if f != fold]
        fitted, scaled = moments.features(others, stages)
        _, index, encode, assemble, scale = fitted
        held = moments.rows([fold], moments.means(others), list(index.labelsArray[0]))
        held = _written(scale.transform(assemble.transform(moments._station_vec(held, index, encode))))
        for i, params in enumerate(grid):
            scores[fold, i] = judge.evaluate(_solve(lr, moments, scaled, params).transform(held))
    average = scores.mean(axis=0).tolist()
    every = list(range(folds))
    fitted, scaled = moments.features(every, stages)
    best = _solve(lr, moments, scaled, grid[average.index(min(average))])
    return Tuned(PipelineModel([*fitted, best]), average, grid)


def grid_scores(model: Tuned, test: DataFrame) -> DataFrame:
    """Mean RMSE of every grid point; for the one that was chosen also RMSE and R2 on the hold-out rows ``test``."""
    held = evaluate(cut_lineage(labelled(model.transform(test)).select(F.col(LABEL).cast("double").alias(LABEL), "prediction")))
    best = min(range(len(model.avgMetrics)), key=lambda i: model.avgMetrics[i])
    rows = []
    for i, (params, score) in enumerate(zip(model.getEstimatorParamMaps(), model.avgMetrics)):
        p = {p.name: float(v) for p, v in params.items()}
        own = (held["rmse"], held["r2"]) if i == best else (None, None)
        rows.append((p["regParam"], p["elasticNetParam"], int(p["maxIter"]), float(score), i == best, *own))
    return test.sparkSession.createDataFrame(
        rows, "reg_param double, elastic_net double, max_iter int, rmse double, chosen boolean, holdout_rmse double, holdout_r2 double")


def evaluate(predictions: DataFrame) -> dict[str, float]:
    """RMSE and R2 of rows with a label and a prediction."""
    return {
        m: RegressionEvaluator(labelCol=LABEL, predictionCol="prediction", metricName=m).evaluate(predictions)
        for m in ("rmse", "r2")
    }
