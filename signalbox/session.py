"""Session creation and the shared working folder."""

from __future__ import annotations

import contextlib
import contextvars
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Longer generated methods are not compiled by the JIT and run many times
    # slower than the same plan without whole-stage code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, app: str = "signalbox",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and written tables.

    Read from ``spark.checkpoint.dir``. Only a ``local`` session (tests) gets a
    private folder when it has none: elsewhere executors have disks of their own.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="signalbox-ckpt-", dir="/tmp")
        sc.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def run_root(spark: SparkSession) -> str:
    """Folder of this application's working tables, below the shared folder."""
    return f"{shared_dir(spark)}/signalbox-{spark.sparkContext.applicationId}"


_SCOPE: contextvars.ContextVar[str | None] = contextvars.ContextVar("scope", default=None)


def work_path(spark: SparkSession, label: str) -> str:
    """A new path for a working table: in the run folder, or in the folder of
    the ``scratch`` block that the caller is in."""
    return f"{_SCOPE.get() or run_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """Working tables written inside the block go to a folder of their own,
    which is deleted at its end: nothing made in it may be read afterwards. For
    work that comes again and again, such as the epochs of a stream."""
    folder = work_path(spark, label)
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        remove(spark, folder)


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete ``path`` and what is below it, on its own file system."""
    p, fs = _file_system(spark, path)
    fs.delete(p, True)


def release_run(spark: SparkSession) -> None:
    """Delete the application's working tables. Results read them lazily: call
    it when the last result has been written."""
    remove(spark, run_root(spark))


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the table folder ``path`` has data, asked of its own file
    system: markers such as ``_SUCCESS`` and unfinished attempts (names with a
    leading underscore or dot) do not count, and no error means "absent"."""
    p, fs = _file_system(spark, path)
    if not fs.exists(p):
        return False
    return any(st.getPath().getName()[:1] not in ("_", ".") for st in fs.listStatus(p))


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Move a finished folder to its name; False when the name is taken. The file
    system itself refuses a taken name, so of two writers one wins."""
    a, _ = _file_system(spark, source)
    b, fs = _file_system(spark, target)
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    try:
        hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(a, b, options)
    except Exception as e:  # noqa: BLE001 - the Java class tells
        if "AlreadyExists" in str(e):
            return False
        raise
    return True


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in the folder ``path``, none when there is no such folder."""
    p, fs = _file_system(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below the folder ``path``, 0 when there is no such folder."""
    p, fs = _file_system(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def materialize(df, label: str = "stage"):
    """Write ``df`` once to the shared folder and return the read-back table.

    Cuts lineage for an intermediate that several jobs read (each would
    otherwise recompute it), and survives lost executors: the data lives in
    the cluster's shared folder, not in executor memory.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    with compiled(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Plans that run inside the block leave whole-stage code where a generated
    method would be too long for the JIT (``DEFAULT_CONF``), also in a session
    that was not made by ``get_session``, and read files in splits of ``SPLIT_MB``
    at most: what a task sorts or hashes of a compressed split fits into memory.
    When such a plan has run, its shuffle files go: only what it wrote is read again."""
    name, split, clean = ("spark.sql.codegen.hugeMethodLimit", "spark.sql.files.maxPartitionBytes",
                          "spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    before = {k: spark.conf.get(k) for k in (name, split, clean)}
    spark.conf.set(name, DEFAULT_CONF[name])
    spark.conf.set(clean, "true")
    if _bytes(spark, before[split]) > SPLIT_MB << 20:
        spark.conf.set(split, f"{SPLIT_MB}m")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


#: Largest file split of the library's own jobs: a few million rows of a written table.
SPLIT_MB = 32


def _bytes(spark: SparkSession, size: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def counted(df, write) -> int:
    """``write(df)``, and the number of rows that went through it: the write's
    own metric (``observe``), no counting job."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    rows = Observation()
    with compiled(df.sparkSession):
        write(df.observe(rows, F.count(F.lit(1)).alias("n")))
    return rows.get.get("n", 0)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Once per application: Spark's file server takes a zip of this package to
    every executor, for Python tasks; nothing need be installed there."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="signalbox-"), "signalbox_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
