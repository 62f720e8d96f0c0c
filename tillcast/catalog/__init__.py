"""All checked queries; importing this package registers them."""

from tillcast.catalog import (  # noqa: F401
    event_queries, explore_queries, forecast_queries, ingest_queries, series_queries,
)
from tillcast.catalog.registry import ORACLE, QUERIES  # noqa: F401
