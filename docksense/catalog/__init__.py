"""All registered queries; importing this package fills the registry."""

from docksense.catalog import (  # noqa: F401
    a_sources,
    b_cleaning,
    c_joins,
    d_aggregates,
    e_windows,
    f_sorts,
    h_scalars,
    i_streaming,
    j_analytics,
)
from docksense.catalog.base import ORACLE, QUERIES  # noqa: F401
