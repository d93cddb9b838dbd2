"""Landed JSON: text columns, feeds, feature collections, malformed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def ingest_json_strings(df: DataFrame, col: str, schema: T.StructType | str) -> DataFrame:
    """JSON text column to typed columns next to the other columns."""
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.from_json(col, schema).alias("_j")).select(*rest, "_j.*")


def decode(df: DataFrame, col: str, schema: T.StructType, defaults: dict | None = None,
           on_error: str = "null"):
    """JSON messages to columns with defaults for missing keys.

    ``on_error="split"`` returns (good, bad) with the text of malformed messages in ``_corrupt_record``.
    """
    rest = [c for c in df.columns if c != col]
    wide = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    out = df.select(*rest, F.from_json(col, wide, options).alias("_j")).select(*rest, "_j.*")
    if defaults:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
    if on_error == "split":
        return split_corrupt(out)
    return out.drop(CORRUPT)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows read well, and rows whose text is in ``_corrupt_record``."""
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)
    return good, bad


def feed_rows(df: DataFrame, item: T.StructType, col: str = "value") -> DataFrame:
    """Rows of the array at ``data.stations`` of a JSON document."""
    doc = T.StructType([T.StructField("data", T.StructType([T.StructField("stations", T.ArrayType(item))]))])
    return df.select(F.explode(F.from_json(col, doc)["data"]["stations"]).alias("s")).select("s.*")


def flatten_features(df: DataFrame, layer: dict[str, str], required: list[str] | None = None) -> DataFrame:
    """FeatureCollection documents to rows; ``layer`` maps output columns to paths below a feature."""
    out = df.select(F.explode("features").alias("f")).select(
        *[F.col(f"f.{path}").alias(name) for name, path in layer.items()]
    )
    return out.dropna(subset=required) if required else out


# fixed values: property paths of the known layers
LAYERS = {
    "commercial_census": {"name": "properties.Nom_Activitat", "lon": "properties.Longitud", "lat": "properties.Latitud"},
    "bus_stops": {"geometry": "geometry", "name": "properties.NOM_PARADA", "stop_description": "properties.DESC_PARADA"},
    "bus_lines": {"geometry": "geometry", "name": "properties.NOM_LINIA", "line_description": "properties.DESC_LINIA"},
    "metro_lines": {"geometry": "geometry", "name": "properties.NOM_LINIA", "line_description": "properties.DESC_LINIA"},
    "metro_stations": {"geometry": "geometry", "name": "properties.NOM_ESTACIO", "metro_line": "properties.PICTO"},
    "no_motorized_vehicles": {"geometry": "geometry", "name": "properties.TOOLTIP"},
    "bike_lanes": {"geometry": "geometry", "name": "properties.TOOLTIP"},
}


def weather_rows(df: DataFrame) -> DataFrame:
    """Weather files (``codi``, ``lectures``) to (codi, fecha, hora, valor), readings to one decimal."""
    from docksense.functions.calendar import parse_iso

    rows = df.select("codi", F.explode("lectures").alias("l"))
    ts = parse_iso("l.data")
    return rows.select(
        "codi", F.to_date(ts).alias("fecha"), F.date_format(ts, "HH:mm:ss").alias("hora"),
        F.round("l.valor", 1).alias("valor"),
    )
