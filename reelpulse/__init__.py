"""reelpulse: Spark-native user-behaviour analytics.

Streaming ingest, star-schema warehouse, BI reports, telemetry cleaning,
bronze/silver/gold tables, document-style rollups, serving merges and
K-Means segmentation, all expressed with the public DataFrame, SQL,
Structured Streaming and MLlib APIs.
"""

from reelpulse.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
