"""Scans, dimension loading and sinks."""

from dealflow.sources.dims import (  # noqa: F401
    CLOSERS_SCHEMA,
    PRODUCT_MAP_SCHEMA,
    STAGES_SCHEMA,
    TARGETS_SCHEMA,
    TIER_MAP_SCHEMA,
    bounded_broadcast,
    load_dim,
    targets,
)
from dealflow.sources.scans import (  # noqa: F401
    assoc,
    freshness,
    live_rows,
    optional_col,
    other_side,
    paged_extract,
    publish,
    scalar_metric,
    write_report,
)
