"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fold_of(column: str, folds: int) -> Column:
    """The fold of a row: CRC-32 of its id written as text, modulo ``folds``.
    A null id belongs to fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds, F.lit(0))


def sampled(rows: DataFrame, key: str, most: int, seed: str) -> DataFrame:
    """About ``most`` rows chosen by the hash of their key, all if there are
    no more. Sample sizes are parameters of the classifiers that use this."""
    total = rows.count()
    if total <= most:
        return rows
    lots = 1 << 62
    return rows.where(F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 2) < most * lots // total)


def fresh(name: str, df: DataFrame) -> str:
    """A column name that the table does not have yet, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns(df: DataFrame) -> list[Column]:
    """All columns, of whatever names."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]
