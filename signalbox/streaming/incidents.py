"""Incident stream: landing folder -> parse -> quarantine / load / outbox.

T01 ``incident_stream`` reads a landing folder (whole files, or one message
per line), a bounded number of files or bytes a trigger; files that were read
move to an archive. T02 ``IncidentBatchWriter`` handles each micro-batch in
``foreachBatch``: dimensions, then incidents, then links, each stored by epoch.
T03: ``versions.first_versions`` lets a version pass once over the life of the
stream, so an epoch need not read the incidents stored before it. T04: poison
messages go, text included, to a quarantine table, from which ``redrive`` feeds
them through again. Alerts go to an outbox partitioned by epoch and operator
code. T05: the checkpoint location makes a restart resume, and every write is
replay-safe: an epoch of a run overwrites its own partitions with the same rows
and ids, so a replayed epoch leaves what the first try left.

One writer at a time: an epoch, ``redrive`` and another stream into the same
tables run one after the other.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import incidents as I
from ..session import children, folder_bytes, materialize, path_exists, remove, rename, scratch, work_path
from ..sources.xml_docs import parse_incidents, unpack_messages
from .packing import read_table
from .versions import ROCKSDB, first_versions

TABLES = ("priority", "incident", "route_affected", "incident_route_link",
          "incident_operator_link")
#: Stored by run and epoch; the other tables are dimensions.
BY_EPOCH = {"incident": "incident_id", "incident_route_link": "incident_route_link_id",
            "incident_operator_link": "incident_operator_link_id"}
#: Landed MB for a partition of the version state, so that what a task sorts of them
#: stays in memory, and the most partitions a core.
STATE_MB, STATE_A_CORE = 32, 16
LETTER = "letter_id string, message_key string, value string, reason string, attempt int, run string, epoch long"


def incident_stream(spark: SparkSession, landing: str, whole_files: bool = False,
                    max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None,
                    archive: str | None = None) -> DataFrame:
    """Streaming DataFrame of (message_key, value) from a landing folder.
    With ``archive`` a file that was read moves there when a later batch begins
    (``archive_read`` moves those of the last one)."""
    r = spark.readStream.format("text")
    if whole_files:
        r = r.option("wholetext", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if archive:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    df = r.load(landing)
    return df.select(F.col("_metadata.file_path").alias("message_key"), "value")


def archive_read(spark: SparkSession, archive: str, checkpoint: str) -> int:
    """Moves the files of committed batches that still lie in the landing folder
    to the archive, under the same path as the source's own cleaner, and counts
    them. The source cleans up when the next batch begins, so the files of the
    last one are left to this."""
    done = [int(n) for n in children(spark, f"{checkpoint}/commits") if n.isdigit()]
    if not done:
        return 0
    jvm, moved = spark._jvm, 0
    for name in children(spark, f"{checkpoint}/sources/0"):
        number = name.removesuffix(".compact")
        if not number.isdigit() or int(number) < max(done) - 1:
            continue  # those were cleaned when the batches after them began
        for line in spark.read.text(f"{checkpoint}/sources/0/{name}").collect():  # the files of a batch
            if not line[0].startswith("{"):
                continue
            entry = json.loads(line[0])
            if entry["batchId"] > max(done):
                continue
            source = jvm.org.apache.hadoop.fs.Path(entry["path"])
            target = jvm.org.apache.hadoop.fs.Path(archive.rstrip("/") + source.toUri().getPath())
            fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
            if fs.exists(source):
                fs.mkdirs(target.getParent())
                moved += fs.rename(source, target)
    return moved


def read_outbox(spark: SparkSession, path: str) -> DataFrame:
    """The alerts of an outbox, which has no files as long as nobody was alerted."""
    columns = "operator_code string, version string, message string"
    return spark.read.schema(columns).option("basePath", path).parquet(path).select("operator_code", "version", "message")


class IncidentBatchWriter:
    """foreachBatch handler writing the incident tables under ``root``.

    What an epoch writes lies under the run's own id, so a stream begun anew with
    another checkpoint leaves the epochs of the one before as they are.
    ``suppressed`` says that the batches hold no version which this run had
    before (``first_versions``): only other runs' incidents are then read. Ids
    go on from the epoch before (``_last_ids``), not from a scan of the tables.
    """

    def __init__(self, root: str, operator_path: str, checkpoint: str | None = None,
                 suppressed: bool = False, run: str | None = None):
        self.root = root.rstrip("/")
        self.operator_path = operator_path
        self.checkpoint = checkpoint.rstrip("/") if checkpoint else None
        self.suppressed = suppressed
        self._run = run

    def _run_id(self, spark) -> str:
        """The stream's id, which Spark keeps in its checkpoint."""
        if self._run is None:
            self._run = json.loads(spark.read.text(f"{self.checkpoint}/metadata").first()[0])["id"]
        return self._run

    def _mine(self) -> Column:
        return (F.col("loaded_run") == self._run) & (F.col("loaded_epoch") == self._epoch)

    def _stored(self, spark, name) -> DataFrame | None:
        """What the load compares with: all of a dimension; of a table by epoch
        all but this epoch's own rows, and of this run nothing if suppressed."""
        found = read_table(spark, self.root, name)
        if found is None or name not in BY_EPOCH:
            return found
        return found.where(F.col("loaded_run") != self._run) if self.suppressed else found.where(~self._mine())

    def _last_ids(self, spark) -> dict[str, int]:
        """Each table's last id before this epoch: what the epoch before noted,
        or what other runs have stored since."""
        own = f"{self.root}/_last_ids/run={self._run}"
        before = [int(e) for n in children(spark, own) if (e := n.removeprefix("epoch=")).isdigit() and int(e) < self._epoch]
        last = dict.fromkeys(BY_EPOCH, 0)
        if before and self.suppressed:
            last = {r.name: r.last_id for r in spark.read.parquet(f"{own}/epoch={max(before)}").collect()}  # a row a table
        for name, id_col in BY_EPOCH.items():
            found = self._stored(spark, name)
            if found is not None:
                last[name] = max(last[name], found.agg(F.max(id_col)).first()[0] or 0)
        return last

    def _append(self, spark, name, df):
        if name not in BY_EPOCH:
            df.hint("rebalance").write.mode("append").parquet(f"{self.root}/{name}")
            return spark.read.schema(df.schema).parquet(f"{self.root}/{name}")
        id_col = BY_EPOCH[name]
        df = df.withColumn(id_col, F.col(id_col) + F.lit(self._last[name]))
        df = df.withColumns({"loaded_run": F.lit(self._run), "loaded_epoch": F.lit(self._epoch).cast("long")})
        (df.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("loaded_run", "loaded_epoch").parquet(f"{self.root}/{name}"))
        table = spark.read.schema(df.schema).parquet(f"{self.root}/{name}")
        return table.where(self._mine()) if self.suppressed else read_table(spark, self.root, name)

    def _overwrite_epoch(self, df, name, partition_cols=()):
        (df.withColumns({"run": F.lit(self._run), "epoch": F.lit(self._epoch)}).hint("rebalance")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run", "epoch", *partition_cols).parquet(f"{self.root}/{name}"))

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        self._run_id(spark)
        self._epoch = epoch_id
        with scratch(spark, "epoch"):
            self._write(spark, batch)

    def _write(self, spark, batch: DataFrame) -> None:
        # written, not cached: several loads read it, and executors may be lost
        # and a message that the version state has parsed is not parsed again
        parsed = unpack_messages(batch) if "parsed" in batch.columns else parse_incidents(batch).withColumn("value", F.col("raw"))
        details = materialize(I.incident_details(parsed), "stream-details")
        good, bad = I.split_messages(details)
        letter = F.col("letter_id") if "letter_id" in batch.columns else F.sha2(F.concat_ws(
            "\x00", F.lit(self._run), F.lit(str(self._epoch)), "message_key", "value"), 256)
        attempt = F.col("attempt") + 1 if "attempt" in batch.columns else F.lit(1)
        self._overwrite_epoch(bad.select(
            letter.alias("letter_id"), "message_key", "value", F.col("quarantine_reason").alias("reason"),
            attempt.cast("int").alias("attempt")), "quarantine")
        good = good.drop("value", "letter_id", "attempt")
        stored = self._stored(spark, "incident")
        if stored is not None:
            # versions of other runs, or of earlier epochs, are theirs
            good = materialize(good.join(stored.select(F.col("incident_version").alias("version")), "version", "left_anti"), "stream-new")
        self._last = self._last_ids(spark)
        rejects = []
        tables = I.load_all_incidents(
            good, spark.read.parquet(self.operator_path),
            lambda name: None if name in BY_EPOCH else self._stored(spark, name),
            lambda name, df: self._append(spark, name, df),
            lambda name, df: rejects.append(df.select(F.lit(name).alias("table_name"), F.to_json(F.struct("*")).alias("row"),
                                                      "reject_reason")))
        refused = rejects[0]
        for more in rejects[1:]:
            refused = refused.unionByName(more)
        self._overwrite_epoch(refused, "rejects")
        # Alerts for versions first stored by this epoch (stable on replay).
        mine = tables.incident.where(self._mine()).select(F.col("incident_version").alias("version"))
        self._overwrite_epoch(I.stored_alerts(good, mine), "outbox", ("operator_code",))
        self._note_ids(spark, tables)

    def _note_ids(self, spark, tables) -> None:
        own = f"{self.root}/_last_ids/run={self._run}"
        last = [(n, getattr(tables, n).where(self._mine()).agg(F.max(c)).first()[0] or self._last[n]) for n, c in BY_EPOCH.items()]
        spark.createDataFrame(last, "name string, last_id long").coalesce(1).write.mode("overwrite").parquet(f"{own}/epoch={self._epoch}")
        for n in children(spark, own):
            if (e := n.removeprefix("epoch=")).isdigit() and int(e) < self._epoch - 1:
                remove(spark, f"{own}/{n}")


# --- dead letters (T04) -----------------------------------------------------------

def open_letters(spark: SparkSession, root: str) -> DataFrame | None:
    """The quarantined messages that no later attempt has dealt with."""
    if not path_exists(spark, f"{root}/quarantine"):
        return None
    letters = spark.read.schema(LETTER).parquet(f"{root}/quarantine").dropDuplicates(["letter_id", "attempt"])
    if path_exists(spark, f"{root}/redrive/settled"):
        settled = spark.read.schema("letter_id string, attempt int, pass long").parquet(f"{root}/redrive/settled")
        letters = letters.join(settled.select("letter_id", "attempt"), ["letter_id", "attempt"], "left_anti")
    return letters


def redrive(spark: SparkSession, root: str, operator_path: str,
            fix: Callable[[Column], Column] | None = None) -> bool:
    """Feeds the open letters, their text after ``fix``, through the pipeline
    once more; False when there are none. A message made good is stored, alerts
    and leaves the table; one that is still bad becomes a letter of the next
    attempt. A pass works on the letters it noted at first, so one that broke off
    is taken up by the next call and leaves the same rows."""
    root = root.rstrip("/")
    settled = [int(n.removeprefix("pass=")) for n in children(spark, f"{root}/redrive/settled") if n.startswith("pass=")]
    number = max(settled, default=-1) + 1
    noted = f"{root}/redrive/noted/pass={number}"
    if not path_exists(spark, noted):
        letters = open_letters(spark, root)
        if letters is None:
            return False
        attempt = work_path(spark, "letters")
        letters.select("letter_id", "message_key", "value", "attempt").write.parquet(attempt)
        spark.range(0).write.mode("ignore").parquet(f"{root}/redrive/noted/_none")  # makes the parent folder
        if not rename(spark, attempt, noted):
            remove(spark, attempt)
    letters = spark.read.schema("letter_id string, message_key string, value string, attempt int").parquet(noted)
    if letters.isEmpty():
        return False
    batch = letters.withColumn("value", fix(F.col("value"))) if fix else letters
    IncidentBatchWriter(root, operator_path, run="redrive")(batch, number)
    letters.select("letter_id", "attempt").write.mode("overwrite").parquet(f"{root}/redrive/settled/pass={number}")
    return True


def run_incident_stream(spark: SparkSession, landing: str, root: str, operator_path: str,
                        checkpoint: str, whole_files: bool = False,
                        max_files_per_trigger: int | None = None, available_now: bool = True,
                        max_bytes_per_trigger: int | None = None, archive: str | None = None,
                        state_partitions: int | None = None):
    """Start (or resume, from ``checkpoint``) the incident stream. With
    ``available_now`` it processes what has landed and stops; with ``archive``
    the landing folder is then empty. The version state lies in
    ``state_partitions`` (if not given, one for ``STATE_MB`` that have landed, and
    at least the cluster's cores), fixed by the first start."""
    stream = incident_stream(spark, landing, whole_files, max_files_per_trigger, max_bytes_per_trigger, archive)
    if state_partitions is None:
        cores = spark.sparkContext.defaultParallelism
        state_partitions = max(cores, min(STATE_A_CORE * cores, folder_bytes(spark, landing) // (STATE_MB << 20)))
    # the query takes a copy of these when it starts; the checkpoint keeps the number of state partitions
    own = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
           "spark.sql.shuffle.partitions": str(state_partitions)}
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        w = (first_versions(stream).writeStream
             .foreachBatch(IncidentBatchWriter(root, operator_path, checkpoint, suppressed=True))
             .option("checkpointLocation", checkpoint))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="15 seconds")
        q = w.start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    if available_now:
        q.awaitTermination()
        if archive:
            archive_read(spark, archive, checkpoint)
    return q
