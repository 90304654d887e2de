"""Tables that cut lineage, written to the folder all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}
_open: list[Scratch] = []


@atexit.register
def _close_all() -> None:
    for scratch in list(_open):
        with suppress(Exception):  # the session, or its gateway, may be gone
            scratch.close()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Where it is unset: a temporary folder in local mode, else one beside the tables of the warehouse."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    key, master = spark.sparkContext.applicationId, spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tidewright-{key}"
    if key not in _own:
        _own[key] = tempfile.mkdtemp(prefix="tidewright-")
        spark.sparkContext.setCheckpointDir(_own[key])
    return f"file://{_own[key]}"


class Scratch:
    """Parquet tables under one fresh folder of the shared directory.

    A table that a returned DataFrame still reads must stay; all others are
    dropped as soon as what follows them is written. :meth:`close` removes what is left,
    once its results are read; the end of the driver's program closes all.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        _open.append(self)

    def close(self) -> None:
        """Removes the folder with all its tables; DataFrames that read them can't be used any more."""
        if self in _open:
            _open.remove(self)
        self.drop(self.root)

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path  # type: ignore[attr-defined]
        return out

    def drop(self, *tables: DataFrame | str) -> None:
        jvm = self.spark._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table if isinstance(table, str) else table.scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, most_rows: int) -> bool:
    """Whether a table has at most ``most_rows`` rows; reads no more than one row beyond."""
    return df.limit(most_rows + 1).count() <= most_rows


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Smaller Arrow batches for tables of long values that are written within."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
