"""Session construction and shared-storage helpers.

On a cluster the session is built by the platform; library code only reads
its settings. ``spark.checkpoint.dir`` names the shared folder used to cut
lineage and to stage intermediate tables; a private folder is created only
when that setting is absent (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "vecdex") -> SparkSession:
    """Local session with the settings the tests and the bench use."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only when
    the session names none (local runs)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="vecdex-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``vecdex`` importable in every Python worker (executors import the
    functions that Arrow/pandas UDF closures refer to). Zips the package once
    per driver process and registers it with ``addPyFile``."""
    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="vecdex-pkg-"), "vecdex.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(id(sc))


#: folders named by ``scratch_path`` in this driver, oldest first
_MADE: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    _MADE.append(os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}"))
    return _MADE[-1]


def scratch_mark() -> int:
    """A point in time for ``drop_scratch``."""
    return len(_MADE)


def drop_scratch(spark: SparkSession, since: int, keep: tuple[str, ...] = ()) -> None:
    """Remove the folders that ``scratch_path`` named after the mark ``since``,
    once nothing reads them any more."""
    for path in _MADE[since:]:
        if path not in keep:
            remove_folder(spark, path)
    _MADE[since:] = [path for path in _MADE[since:] if path in keep]


class Scratch:
    """Intermediate tables of one job: parquet under one folder of the shared
    checkpoint folder. A table written and read back has no lineage and a real
    size in later plans, and goes as soon as its job is done with it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, scratch_path(spark, name)
        self._held: dict[str, DataFrame] = {}
        self._made = 0

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.path}/{self._made}"
        self._made += 1
        df.write.parquet(path)
        self._held[path] = self.spark.read.schema(df.schema).parquet(path)
        return self._held[path]

    def drop(self, *frames: DataFrame) -> None:
        """Remove tables that ``write`` returned; other frames are left alone."""
        for path in [p for p, held in self._held.items() if any(held is f for f in frames)]:
            remove_folder(self.spark, path)
            del self._held[path]

    def close(self, keep: DataFrame | None = None) -> None:
        """Remove every table but ``keep``."""
        self.drop(*[held for held in self._held.values() if held is not keep])


def balance(df: DataFrame) -> DataFrame:
    """Spread a small file scan over the cluster before CPU-heavy row work
    (embedding, scoring). Only the plan and the files' sizes are looked at, no
    job is started: inputs that need a shuffle anyway, are not files, or hold
    more bytes than one split per core are returned unchanged."""
    plan = df._jdf.queryExecution().optimizedPlan()
    want = df.sparkSession.sparkContext.defaultParallelism
    split = 4 << 20
    if not df.inputFiles() or any(x in plan.toString() for x in ("Join", "Aggregate", "Sort", "Repartition", "Window")):
        return df
    if int(plan.stats().sizeInBytes()) >= want * split:
        return df
    return df.repartition(want)


def within_bytes(df: DataFrame, limit: int = 32 << 20) -> bool:
    """Whether all rows of ``df`` written out take at most ``limit`` bytes; the
    check before a broadcast."""
    written = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    return (df.agg(F.sum(written.cast("long"))).first()[0] or 0) <= limit


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable checkpoint,
    survives executor loss) and return the re-read frame."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _filesystem(spark: SparkSession, path: str):
    """Hadoop file system and path object of ``path`` (any store Spark reads)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a Spark job finished writing ``path``. Errors other than a
    missing path are raised, never taken as an answer."""
    fs, where = _filesystem(spark, path.rstrip("/") + "/_SUCCESS")
    return fs.exists(where)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``; none if it does not exist."""
    fs, where = _filesystem(spark, path)
    if not fs.exists(where):
        return []
    return [f.getPath().getName() for f in fs.listStatus(where) if f.isDirectory()]


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _filesystem(spark, path)
    return fs.exists(where)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file (settings, a mark) written by the driver through Spark's file system."""
    fs, where = _filesystem(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _filesystem(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def file_state(spark: SparkSession, path: str) -> tuple:
    """Name, length and time of the data files of a table; differs once they change."""
    fs, where = _filesystem(spark, path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime())
                        for f in fs.listStatus(where) if not f.getPath().getName().startswith(("_", "."))))


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, where = _filesystem(spark, path)
    fs.delete(where, True)
