"""Registered queries with their DuckDB counterparts."""

from weekfold.queries.registry import ORACLES, QUERIES  # noqa: F401
from weekfold.queries import (  # noqa: F401
    aggregates,
    dataset,
    features,
    ingest,
    joins,
    learning,
    quality,
    scalars,
    windows,
)
