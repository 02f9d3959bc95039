"""Layered tables, versioned tables, clustered layout and sinks."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.functions.scalars import round_half_up

LAYERS = ("RAW", "STAGING", "INTERMEDIATE", "MARTS", "ML_FEATURES", "SNAPSHOTS")
LAZY_LAYERS = ("STAGING",)


def layer_name(custom: str | None, default: str) -> str:
    """A custom layer name is used as given, trimmed and upper-cased."""
    return custom.strip().upper() if custom and custom.strip() else default


def clustered(df: DataFrame, by: Sequence[str], spread: str) -> DataFrame:
    """Order rows for pruning by ``by``; ``spread`` lets one large value fill many files."""
    return df.repartitionByRange(*by, spread).sortWithinPartitions(*by, spread)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


class LayerStore:
    """Tables of one run, by layer: the lazy layers are views, the others are written and read back.

    With ``database`` the written layers become catalog tables named ``<database>_<layer>.<table>``,
    otherwise versioned parquet folders under ``base``: a refresh that fails half-way leaves the old rows
    in place, and readers of the old version are not disturbed.
    """

    def __init__(self, spark: SparkSession, base: str | None = None, database: str | None = None):
        if (base is None) == (database is None):
            raise ValueError("give either a base path or a database")
        self.spark, self.base, self.database = spark, base, database

    def _table(self, layer: str, name: str) -> str:
        return f"{self.database}_{layer.lower()}.{name}"

    def put(self, layer: str, name: str, df: DataFrame, cluster_by: Sequence[str] = (), spread: str | None = None) -> DataFrame:
        layer = layer_name(layer, LAYERS[0])
        if layer in LAZY_LAYERS:
            df.createOrReplaceTempView(f"{layer.lower()}__{name}")
            return df
        if cluster_by:
            df = clustered(df, cluster_by, spread or cluster_by[-1])
        if self.database:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}_{layer.lower()}")
            df.write.mode("overwrite").saveAsTable(self._table(layer, name))
        else:
            self.versioned(layer, name).replace(lambda _: df)
        return self.get(layer, name)

    def get(self, layer: str, name: str) -> DataFrame:
        layer = layer_name(layer, LAYERS[0])
        if layer in LAZY_LAYERS:
            return self.spark.table(f"{layer.lower()}__{name}")
        if self.database:
            return self.spark.table(self._table(layer, name))
        return self.versioned(layer, name).read()

    def versioned(self, layer: str, name: str) -> VersionedTable:
        """A table of versions: under the base path, or in the folder of the layer's database."""
        layer = layer_name(layer, LAYERS[0])
        if self.base is not None:
            return VersionedTable(self.spark, f"{self.base}/{layer}/{name}")
        schema = f"{self.database}_{layer.lower()}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
        return VersionedTable(self.spark, f"{self.spark.catalog.getDatabase(schema).locationUri}/{name}_versions")


class CommitConflictError(RuntimeError):
    pass


class VersionedTable:
    """A table rewritten as a whole: each version is a new folder, the newest committed one is current.

    A writer puts its rows into a folder of its own and then claims the next version by creating that version's marker,
    which names the folder and which only one writer can create. A writer that comes second builds its rows anew on the
    version that came in between, so no writer's change is lost. Nothing that is being read is overwritten, and a
    failed write leaves the old version current.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _file(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.base, *parts]))

    @property
    def _fs(self):
        return self._file().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _commits(self) -> dict[int, str]:
        """Folder of each version; empty for one that is claimed and not yet, or never, named."""
        fs, log = self._fs, self._file("_commits")
        names = sorted(s.getPath().getName() for s in fs.listStatus(log)) if fs.exists(log) else []
        return {int(n): self._named(n) for n in names if n.isdigit()}

    def _named(self, marker: str) -> str:
        stream = self._fs.open(self._file("_commits", marker))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
        finally:
            stream.close()

    def _claim(self, version: int, folder: str) -> bool:
        """Create the version's marker; False if there is one."""
        from py4j.protocol import Py4JJavaError

        try:
            out = self._fs.create(self._file("_commits", f"{version:08d}"), False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName() or "already exists" in str(e.java_exception):
                return False
            raise
        try:
            out.write(bytearray(folder.encode()))
        finally:
            out.close()
        return True

    def _finished(self) -> dict[int, str]:
        return {v: folder for v, folder in self._commits().items() if folder}

    def latest(self) -> int:
        """Newest committed version, -1 for none."""
        return max(self._finished(), default=-1)

    def prune(self, keep: int = 2) -> None:
        """Delete the rows of all but the newest ``keep`` versions; their markers stay, so no number is used again."""
        finished = self._finished()
        for v in sorted(finished)[:-keep]:
            self._fs.delete(self._file(finished[v]), True)

    def read(self, version: int | None = None) -> DataFrame | None:
        v = self.latest() if version is None else version
        return None if v < 0 else self.spark.read.parquet(f"{self.base}/{self._finished()[v]}")

    def _settled(self, patience: float) -> tuple[int, int]:
        """The current version and the next free number; a claim still unnamed after ``patience`` seconds is a dead writer's."""
        until = time.monotonic() + patience
        while True:
            commits = self._commits()
            newest = max(commits, default=-1)
            if newest < 0 or commits[newest] or time.monotonic() > until:
                return max((v for v, folder in commits.items() if folder), default=-1), newest + 1
            time.sleep(0.05)

    def replace(self, build: Callable[[DataFrame | None], DataFrame], attempts: int = 20, patience: float = 5.0) -> DataFrame:
        """Commit ``build(current or None)`` as the next version; built again if another writer was faster."""
        for _ in range(attempts):
            current, number = self._settled(patience)
            folder = f"v{number:08d}-{uuid.uuid4().hex[:12]}"
            build(self.read(current)).write.mode("errorifexists").parquet(f"{self.base}/{folder}")
            if self._claim(number, folder):
                return self.read(number)
            self._fs.delete(self._file(folder), True)  # this attempt's own rows, which no marker names
        raise CommitConflictError(f"{self.base}: {attempts} attempts met other writers")


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def feature_store_summary(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows, columns and default rate of a feature table."""
    lower = lower_names(df)
    return lower.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(lower.columns)).alias("columns"),
                     round_half_up(F.avg(label), 6).alias("default_rate"))
