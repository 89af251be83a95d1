"""canopy: Spark-native corpus preparation and topic analytics.

Layout
------
- ``sources``   table loaders and the derived message / post / channel views
- ``functions`` Column -> Column building blocks (cleaning, paths, tokens, vectors)
- ``operators`` DataFrame -> DataFrame jobs (dedupe, topics, kNN, clustering, annotation, images)
- ``plans``     the registered queries and their DuckDB oracle SQL
- ``streaming`` Structured Streaming ingest of posts
"""

from canopy.session import build_session, checkpoint_root  # noqa: F401

__all__ = ["build_session", "checkpoint_root"]
