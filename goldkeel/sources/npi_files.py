"""CSV loads of the public NPI registry and its deactivation list."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldkeel.session import stage
from goldkeel.sources.schemas import deactivation_schema, registry_schema

CORRUPT = "_corrupt_record"
FIRST = "_first_field"
MAX_ERRORS = 10
DATE_FORMAT = "MM/dd/yyyy"


class Load(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


def _load_csv(
    spark: SparkSession, path: str, schema: T.StructType, max_errors: int | None, date_format: str
) -> Load:
    """Rows that fit the schema, and the lines that do not.

    Fields are read as text and dates converted here, so whether a line is bad
    never depends on the columns a query uses. The file is read once: its rows
    are written, and bad lines counted on the way; both parts are what was
    written. With ``max_errors=None`` nothing is counted and both parts stay
    lazy.
    """
    names = schema.fieldNames()
    text = T.StructType([T.StructField(name, T.StringType()) for name in [*names, CORRUPT]])
    try:
        lines = (
            spark.read.schema(text)
            .option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("columnPruning", False)
            .csv(path)
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no file to load at {path}") from error
        raise
    dates = {
        field.name: F.try_to_timestamp(F.col(field.name), F.lit(date_format)).cast("date")
        for field in schema
        if isinstance(field.dataType, T.DateType)
    }
    bad = F.col(CORRUPT).isNotNull()
    for name, value in dates.items():
        bad = bad | (F.col(name).isNotNull() & value.isNull())
    line = F.when(bad, F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*names)))).alias(CORRUPT)
    # The first column also names a reject, as it was read.
    first = F.col(names[0]).alias(FIRST)
    loaded = lines.select(*[dates.get(n, F.col(n)).alias(n) for n in names], line, first)
    if max_errors is not None:
        seen = Observation()
        loaded = stage(loaded.observe(seen, F.count(CORRUPT).alias("bad")), "load")
        # A task that ran twice may have counted twice; what was written has not.
        if seen.get["bad"] > max_errors and loaded.where(F.col(CORRUPT).isNotNull()).count() > max_errors:
            raise ValueError(f"more than {max_errors} bad rows in {path}")
    rows = loaded.where(F.col(CORRUPT).isNull()).select(*names)
    return Load(rows, loaded.where(F.col(CORRUPT).isNotNull()).select(F.col(FIRST).alias(names[0]), CORRUPT))


def load_npi_registry(
    spark: SparkSession, path: str, max_errors: int | None = MAX_ERRORS, date_format: str = DATE_FORMAT
) -> Load:
    """The 329-column registry file: quoted fields, header line.

    Unless ``max_errors`` is None the load is written before this returns, and
    fails with more bad lines than that.
    """
    return _load_csv(spark, path, registry_schema(), max_errors, date_format)


def load_deactivations(
    spark: SparkSession, path: str, max_errors: int | None = MAX_ERRORS, date_format: str = DATE_FORMAT
) -> Load:
    """The two-column deactivation list, checked like the registry file."""
    return _load_csv(spark, path, deactivation_schema(), max_errors, date_format)
