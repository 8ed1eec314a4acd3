"""Row keys derived from content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(*cols: Column) -> Column:
    """SHA-1 over the row as JSON; NULL and the empty string differ."""
    return F.sha1(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}))
