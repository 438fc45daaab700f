"""Every operation as a query over the given tables, with DuckDB SQL that computes the same.

The test tables stand in for the engine's own: ``lang`` is the document kind, ``source`` the url,
the first line the title, and a date derived from the id the meeting date.
"""

from quirefold.suite import documents, ingestion, texts, vectors  # noqa: F401
from quirefold.suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
