"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def effective_date(modified: Column, created: Column) -> Column:
    """The later of both dates. Without a creation date the result is NULL."""
    return F.when(modified > created, modified).otherwise(created)
