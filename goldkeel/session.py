"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import functools
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
LOCAL_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def get_session(app: str = "goldkeel", master: str | None = None, **settings: str) -> SparkSession:
    """A session with this package's settings. Without a master the cluster's
    submit settings apply; partition counts are left to them too."""
    builder = SparkSession.builder.appName(app)
    chosen = dict(SETTINGS)
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            chosen.update(LOCAL_SETTINGS)
    chosen.update({k.replace("__", "."): v for k, v in settings.items()})
    for key, value in chosen.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_folder() -> tempfile.TemporaryDirectory:
    """Goes when the process ends."""
    return tempfile.TemporaryDirectory(prefix="goldkeel-")


def _is_local(master: str) -> bool:
    """Whether driver and executors are one process; ``local-cluster`` is not."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path under the shared one named by ``spark.checkpoint.dir``.

    Only a session that is one process may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not _is_local(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = _local_folder().name
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


ROWS_PER_TASK = 500_000
BYTES_PER_TASK = 16 << 20  # of compressed rows, some ten times as much in memory


@contextlib.contextmanager
def shuffling(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run meanwhile deal their rows, about so many, out to tasks of
    bounded size. The session's own settings hold wherever they make more or
    smaller tasks, and again afterwards. Settings are the session's: do not run
    other jobs on it at the same time that must not see them."""
    most, size = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    usual = {key: spark.conf.get(key) for key in (most, size)}
    set_before = [key for key in usual if spark.conf._jconf.contains(key)]
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    try:
        spark.conf.set(most, max(int(usual[most]), -(-rows // ROWS_PER_TASK)))
        spark.conf.set(size, min(in_bytes(usual[size]), BYTES_PER_TASK))
        yield
    finally:
        for key, value in usual.items():
            spark.conf.set(key, value) if key in set_before else spark.conf.unset(key)


def stage(df: DataFrame, name: str, rows: int = 0) -> DataFrame:
    """Write an intermediate table to the shared folder and go on from there.

    For tables used several times: later stages rescan only the columns they
    need, know the true size, and a lost executor costs no recomputation. Tell
    about how many ``rows`` are shuffled on the way, if they may be many.
    """
    return staged(df, name, rows)[0]


def staged(df: DataFrame, name: str, rows: int = 0) -> tuple[DataFrame, str]:
    """A staged table and its folder, for ``discard`` when it has served."""
    path = scratch_folder(df.sparkSession, name)
    with shuffling(df.sparkSession, rows):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing still to run reads."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
