"""meterstar: trip-style event analytics on Spark DataFrames, SQL and Structured Streaming.

Layout
  sources/    landing reads (Parquet, CSV with declared schema, JSON feeds, nested documents)
              and the binding of the driver tables onto the trip / event schemas
  functions/  Column -> Column helpers (safe cast, row hash, surrogate key, minute boundaries ...)
  operators/  reusable operators: dedup / top-k, dimension enrichment, load strategies,
              data-quality checks, staging projections
  streaming/  event-time windows (tumble, session), stream sources and keyed sinks
  plans/      the concrete report, warehouse, interval and stream queries built from the above
"""

from meterstar.session import get_session, checkpoint_root  # noqa: F401

__all__ = ["get_session", "checkpoint_root"]
