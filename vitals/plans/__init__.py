"""Queries over the driver's tables."""

from . import registry, storage_queries, branch_queries, stream_queries, store_queries  # noqa: F401, I001  the later ones add their queries to the first's
