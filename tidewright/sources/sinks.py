"""Where results go: append-only ledgers, reports with an exit code, artefacts, versioned schemas."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Ledger:
    """An append-only table below ``path`` in which each value of ``key`` has one row, whoever writes.

    A batch is written to a folder of its own by Spark's committer, so that failed and
    repeated tasks leave nothing. It is seen when ``_commits/<n>`` names it, a file that
    only one writer can create. The one that comes second takes the first's keys out
    of its batch and tries the next number. A batch keeps the name of its job: a job
    that is run again finds itself committed, and adds nothing. A commit that was begun and not
    named within :data:`PATIENCE` seconds stops other writers with an error, rather than let a
    key in twice.
    """

    PATIENCE = 60

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str) -> None:
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self._jvm = spark._jvm
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):  # noqa: ANN202
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _begun(self) -> dict[int, int]:
        """Numbers of commits with the bytes of their files."""
        there = self._fs.listStatus(self._at("_commits")) if self._fs.exists(self._at("_commits")) else []
        return {int(s.getPath().getName()): s.getLen() for s in there if s.getPath().getName().isdigit()}

    def batches(self) -> list[str]:
        """Names of the batches that are seen, in the order of their commits."""
        end = time.monotonic() + self.PATIENCE
        while not all((begun := self._begun()).values()):
            if time.monotonic() > end:
                raise RuntimeError(f"a commit of {self.path} was begun and not named: {[n for n, size in begun.items() if not size]}")
            time.sleep(0.2)
        if not begun:
            return []
        named = self.spark.read.text([f"{self.path}/_commits/{n:09d}" for n in begun]).select(F.col("_metadata.file_name").alias("n"), "value")
        return [r.value for r in sorted(named.collect(), key=lambda r: r.n)]  # a row for each batch

    def read(self, batches: Sequence[str] | None = None) -> DataFrame:
        names = self.batches() if batches is None else batches
        paths = [f"{self.path}/{n}" for n in names if self._fs.exists(self._at(n))]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _create(self, where) -> bool:  # noqa: ANN001
        """False if the file is there. On local disks Hadoop looks first and creates after, so that two callers may both succeed; Java's own call is one step."""
        if self._fs.getUri().getScheme() == "file":
            return self._jvm.java.io.File(self._fs.makeQualified(where).toUri().getPath()).createNewFile()
        return self._fs.createNewFile(where)

    def _commit(self, number: int, name: str) -> bool:
        """False if another writer has this number."""
        where = self._at(f"_commits/{number:09d}")
        if not self._create(where):
            return False
        out = self._fs.create(where, True)
        try:
            out.write(bytearray(name.encode()))
        finally:
            out.close()
        return True

    def append(self, rows: DataFrame, job: str | None = None) -> int:
        """Adds the rows whose key is not there yet; of rows of one key, any one. What is there never changes. Returns how many it added."""
        job = job or uuid.uuid4().hex
        seen = self.batches()
        if any(n.rsplit(".", 1)[0] == job for n in seen):
            return 0
        self._fs.mkdirs(self._at("_commits"))
        fresh = rows.select(*self.schema.names).filter(F.col(self.key).isNotNull()).dropDuplicates([self.key]).join(self.read(seen).select(self.key), self.key, "left_anti").select(*self.schema.names)
        name = f"{job}.{uuid.uuid4().hex[:8]}"
        fresh.write.parquet(f"{self.path}/{name}")
        while True:
            now = self.batches()
            begun = self._begun()
            if len(begun) != len(now):
                continue  # another one has begun since
            number = 1 + max(begun, default=0)
            others = [n for n in now if n not in seen]
            if any(n.rsplit(".", 1)[0] == job for n in others):  # the same job, run twice at a time
                self._fs.delete(self._at(name), True)
                return 0
            if others:
                kept = self.read([name]).join(self.read(others).select(self.key), self.key, "left_anti").select(*self.schema.names)
                again = f"{job}.{uuid.uuid4().hex[:8]}"
                kept.write.parquet(f"{self.path}/{again}")
                self._fs.delete(self._at(name), True)
                name, seen = again, now
                continue
            if self._commit(number, name):
                return self.read([name]).count()


def append(rows: DataFrame, path: str, key: str) -> DataFrame:
    """Adds the rows whose key the ledger has not yet; what is there never changes. Returns the ledger."""
    ledger = Ledger(rows.sparkSession, path, rows.schema, key)
    ledger.append(rows)
    return ledger.read()


def report(violations: DataFrame, path: str) -> int:
    """Writes JSON lines; 0 if there are none, else 1."""
    violations.write.mode("overwrite").json(path)
    return 0 if violations.isEmpty() else 1


def artefacts(terms: DataFrame, ids: DataFrame, path: str) -> None:
    """Counts of terms, and ids by the part before their first dash, each as one sorted table."""
    terms.orderBy(F.desc("uses"), "term").write.mode("overwrite").json(f"{path}/terms")
    spaces = ids.groupBy(F.substring_index("id", "-", 1).alias("namespace")).agg(F.count(F.lit(1)).alias("ids"))
    spaces.orderBy("namespace").write.mode("overwrite").json(f"{path}/namespaces")


def write_yaml(rows: DataFrame, name: str, path: str) -> None:
    """One YAML file with a list under ``name``, in the order of the rows, which pass the driver one partition at a time.

    Each entry is written as JSON, which is YAML too.
    """
    spark = rows.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(f"{name}:".encode()))
        some = False
        for row in rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).toLocalIterator():
            out.write(bytearray(f"\n- {row['value']}".encode()))
            some = True
        out.write(bytearray(b"\n" if some else b" []\n"))
    finally:
        out.close()


def merged_invariants(notes: DataFrame) -> DataFrame:
    """``id, note, statement, status`` of the invariants in the front matter of ``notes(path, front)``, sorted; of ids that repeat, all."""
    kind = "struct<id:string,invariants:array<struct<id:string,statement:string,status:string>>>"
    rows = notes.select("path", F.from_json("front", kind).alias("f")).select(F.coalesce("f.id", F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1)).alias("note"), F.explode("f.invariants").alias("i"))
    return rows.select("i.id", "note", "i.statement", "i.status").orderBy("id", "note", "statement")


class Schemas:
    """Versions of a table's schema as columns that each version adds; a column that comes again is skipped."""

    def __init__(self) -> None:
        self._of: dict[int, list[T.StructField]] = {}

    def add(self, version: str, ddl: str) -> None:
        number = int(version.removeprefix("v"))
        if number in self._of:
            raise ValueError(f"{version} is there already")
        self._of[number] = T.StructType.fromDDL(ddl).fields

    @property
    def latest(self) -> str:
        return f"v{max(self._of)}"

    def schema(self, version: str | None = None) -> T.StructType:
        most = int((version or self.latest).removeprefix("v"))
        fields: dict[str, T.StructField] = {}
        for number in sorted(n for n in self._of if n <= most):
            for field in self._of[number]:
                fields.setdefault(field.name, field)
        return T.StructType(list(fields.values()))

    def migrate(self, rows: DataFrame, defaults: Mapping[str, object] | None = None) -> DataFrame:
        """Old rows under the latest schema; columns they lack get the default or null."""
        out = []
        for field in self.schema().fields:
            value = F.col(field.name) if field.name in rows.columns else F.lit((defaults or {}).get(field.name))
            out.append(value.cast(field.dataType).alias(field.name))
        return rows.select(*out)


def read(spark: SparkSession, path: str, schemas: Schemas) -> DataFrame:
    """Files of any version under the latest schema."""
    return spark.read.schema(schemas.schema()).parquet(path)
