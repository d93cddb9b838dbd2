"""Display columns: title case, number format, colours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: words kept in lower case, in their natural order
PARTICLES = ["de", "del", "la", "las", "el", "los", "en", "y", "o"]

# fixed values: fill per density class
LEVEL_COLOURS = {"very_high": "#6a51a3", "high": "#9e9ac8", "medium": "#cbc9e2", "low": "#f2f0f7"}
UNKNOWN_LEVEL_COLOUR = "#808080"

# fixed values: RGB per truck id, from 0
TRUCK_COLOURS = [
    [255, 0, 0], [0, 255, 0], [0, 0, 255], [255, 255, 0], [255, 165, 0], [128, 0, 128],
    [0, 255, 255], [255, 192, 203], [255, 20, 147], [75, 0, 130], [139, 69, 19], [0, 100, 0],
    [173, 255, 47], [255, 69, 0], [0, 0, 128], [186, 85, 211], [47, 79, 79], [154, 205, 50],
    [255, 140, 0], [70, 130, 180], [72, 61, 139], [100, 149, 237], [255, 105, 180],
    [0, 191, 255], [34, 139, 34],
]
UNKNOWN_TRUCK_COLOUR = [255, 255, 255]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_es(name) -> Column:
    """Capitalise every run of letters, keep Spanish particles in lower case."""
    runs = F.regexp_extract_all(F.lower(_col(name)), F.lit(r"([\p{L}]+|[^\p{L}]+)"), F.lit(1))
    titled = F.array_join(F.transform(runs, F.initcap), "")
    words = F.filter(F.split(titled, r"\s+"), lambda w: w != "")
    return F.array_join(
        F.transform(words, lambda w: F.when(F.lower(w).isin(PARTICLES), F.lower(w)).otherwise(w)), " "
    )


def format_es(x, decimals: int = 2) -> Column:
    """1234.5 as ``1.234,50``."""
    return F.translate(F.format_number(_col(x), decimals), ",.", ".,")


def level_colour(level) -> Column:
    pairs = [F.lit(v) for item in LEVEL_COLOURS.items() for v in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(level)), F.lit(UNKNOWN_LEVEL_COLOUR))


def truck_colour(truck) -> Column:
    """RGB array of a truck id; white for ids without a colour."""
    palette = F.array(*[F.array(*[F.lit(v) for v in rgb]) for rgb in TRUCK_COLOURS])
    return F.coalesce(F.get(palette, _col(truck)), F.array(*[F.lit(v) for v in UNKNOWN_TRUCK_COLOUR]))
