"""Every operator as a runnable query over the given tables."""

from marketlake.catalog import (  # noqa: F401
    aggregates,
    jobs,
    models,
    projections,
    quality,
    relations,
    salaries,
    scalars,
    scans,
    similar,
    skills,
    slicing,
    streams,
)
from marketlake.catalog.base import QUERIES, SQL  # noqa: F401
