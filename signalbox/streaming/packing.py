"""The small files of epochs packed into sized files beside the stream.

An epoch leaves a few small files per table (``loaded_run``, ``loaded_epoch``).
``pack`` writes the rows of closed epochs, by month of creation and in files of
about ``FILE_ROWS`` rows, as a new generation and then publishes a *manifest*: a
small file that names the generations and, for each run, the last epoch they
hold. ``read_table`` takes the newest manifest and adds the epochs after it, so a
reader sees each row once, before, during and after a rewrite. The epochs that a
manifest covers are deleted by the next ``pack``, when no reader of an older
manifest should be left; generations that no manifest names go likewise.

Generations are merged when the newer ones together are as large as the one
before them, so a row is rewritten a logarithmic number of times and the number
of files stays bounded by months and generations. Ids and rows do not change.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import children, path_exists, remove, rename, work_path

FILE_ROWS = 1_000_000


def _manifest(spark: SparkSession, root: str, name: str, back: int = 0) -> dict:
    base = f"{root}/_packed/{name}/manifests"
    numbers = sorted(int(n) for n in children(spark, base) if n.isdigit())
    if len(numbers) <= back:
        return {"number": 0, "generations": [], "through": {}}
    return json.loads("".join(r[0] for r in spark.read.text(f"{base}/{numbers[-1 - back]}").collect()))


def _epochs(spark: SparkSession, root: str, name: str) -> list[tuple[str, int]]:
    """(run, epoch) of the folders of a table."""
    out = []
    for r in children(spark, f"{root}/{name}"):
        if r.startswith("loaded_run="):
            out += [(r.removeprefix("loaded_run="), int(e.removeprefix("loaded_epoch=")))
                    for e in children(spark, f"{root}/{name}/{r}") if e.startswith("loaded_epoch=")]
    return out


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A table by its newest manifest: packed rows and the epochs after them."""
    there = path_exists(spark, f"{root}/{name}")
    m = _manifest(spark, root, name)
    loose = spark.read.parquet(f"{root}/{name}") if there else None
    if loose is not None and "loaded_run" in loose.columns:
        loose = loose.withColumns({"loaded_run": F.col("loaded_run").cast("string"), "loaded_epoch": F.col("loaded_epoch").cast("long")})
    if not m["generations"]:
        return loose
    base = f"{root}/_packed/{name}"
    packed = spark.read.option("basePath", base).parquet(*[f"{base}/{g['folder']}" for g in m["generations"]]).drop("generation", "month")
    if loose is None:
        return packed
    covered = F.lit(False)
    for run, epoch in m["through"].items():
        covered = covered | ((F.col("loaded_run") == run) & (F.col("loaded_epoch") <= epoch))
    return packed.unionByName(loose.where(~covered).select(*packed.columns))


def pack(spark: SparkSession, root: str, name: str, keep: int = 2, month_of: str | None = None,
         file_rows: int = FILE_ROWS) -> int:
    """Packs the closed epochs of table ``name``: all but the last ``keep`` of
    each run, which the stream may write again. ``month_of`` names the time
    column that files are laid out by. Returns the number of epochs packed."""
    root = root.rstrip("/")
    base = f"{root}/_packed/{name}"
    m = _manifest(spark, root, name)
    epochs = _epochs(spark, root, name)
    for run, epoch in epochs:  # covered by the manifest that readers have had since the last call
        if epoch <= m["through"].get(run, -1):
            remove(spark, f"{root}/{name}/loaded_run={run}/loaded_epoch={epoch}")
    named = {g["folder"] for g in m["generations"]}
    for folder in children(spark, base):
        if folder.startswith("generation=") and folder not in named:
            remove(spark, f"{base}/{folder}")
    last: dict[str, int] = {}
    for run, epoch in epochs:
        last[run] = max(last.get(run, -1), epoch)
    fresh = [(r, e) for r, e in epochs if m["through"].get(r, -1) < e <= last[r] - keep]
    if not fresh:
        return 0
    table = spark.read.option("basePath", f"{root}/{name}").parquet(
        *[f"{root}/{name}/loaded_run={r}/loaded_epoch={e}" for r, e in fresh])
    table = table.withColumns({"loaded_run": F.col("loaded_run").cast("string"), "loaded_epoch": F.col("loaded_epoch").cast("long")})
    n, generations = table.count(), list(m["generations"])
    while generations and generations[-1]["rows"] <= n:      # as large as what comes after it
        g = generations.pop()
        table = table.unionByName(spark.read.parquet(f"{base}/{g['folder']}").drop("month").select(*table.columns))
        n += g["rows"]
    number = m["number"] + 1
    month = F.date_format(month_of, "yyyy-MM") if month_of else F.lit("all")
    attempt = work_path(spark, "generation")
    rows = table.withColumn("month", F.coalesce(month, F.lit("none")))
    (rows.repartition("month").write.option("maxRecordsPerFile", file_rows).partitionBy("month").parquet(attempt))
    folder = f"generation={number}"
    spark.createDataFrame([("",)], "value string").limit(0).write.mode("ignore").text(f"{base}/_made")
    remove(spark, f"{base}/{folder}")                        # of a call that broke off before its manifest
    if not rename(spark, attempt, f"{base}/{folder}"):
        raise RuntimeError(f"{base}/{folder}: another packing is at work")
    through = dict(m["through"])
    for r, e in fresh:
        through[r] = max(through.get(r, -1), e)
    text = json.dumps({"number": number, "generations": [*generations, {"folder": folder, "rows": n}], "through": through})
    draft = work_path(spark, "manifest")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(draft)
    spark.createDataFrame([("",)], "value string").limit(0).write.mode("ignore").text(f"{base}/manifests/_made")
    if not rename(spark, draft, f"{base}/manifests/{number}"):
        raise RuntimeError(f"{base}: another packing published first")
    for old in children(spark, f"{base}/manifests"):
        if old.isdigit() and int(old) < number - 1:
            remove(spark, f"{base}/manifests/{old}")
    return len(fresh)
