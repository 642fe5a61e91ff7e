"""Queries over the driver's tables, each with the SQL that gives the same rows.

Importing the package registers them all.
"""

from ratepanel.queries import checks, extraction, files, reshaping, scalars, store
from ratepanel.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "checks", "extraction", "files", "reshaping", "scalars", "store"]
