"""Imports every query module, in the order of the operator inventory."""

from sparkwell.plans import (  # noqa: F401
    projection,
    ingest,
    joins,
    subqueries,
    aggregates,
    windows,
    scalars,
    changes,
    streams,
    graphs,
    nested,
    keyvalue,
    vectors_text,
    observe,
    business,
    quality,
    sets_sorts,
)
