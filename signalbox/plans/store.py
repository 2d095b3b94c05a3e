"""Stored star schema per data folder, in the cluster's shared folder.

Dashboard and report queries read the loaded warehouse, as they read the
database in production. The first request for a data folder runs the load
(W10) into a fresh folder and then moves that to
``<run folder>/store-<digest>``; later requests read the written tables. The
digest covers every input file, so changed inputs are loaded anew, and an
attempt that broke off is never read.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import SparkSession

from ..session import _file_system, path_exists, remove, rename, run_root
from ..sources.binding import cancel_code_rows, service_rows
from ..sources.tables import Tables
from .services import ServiceTables, load_all, open_star_schema

#: Tables that the load reads.
INPUTS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

_OPENED: dict[str, ServiceTables] = {}


def inputs_digest(spark: SparkSession, sf_dir: str) -> str:
    """Names the input files, their sizes and times, as their file system has them."""
    stamps = [sf_dir]
    for table in INPUTS:
        path, fs = _file_system(spark, f"{sf_dir}/{table}.parquet")
        files = [fs.getFileStatus(path)]
        if files[0].isDirectory():
            files = sorted(fs.listStatus(path), key=lambda f: f.getPath().getName())
        stamps += [f"{f.getPath().getName()}|{f.getLen()}|{f.getModificationTime()}" for f in files]
    return hashlib.sha1("\n".join(stamps).encode()).hexdigest()[:16]


def services_store(spark: SparkSession, sf_dir: str) -> ServiceTables:
    root = f"{run_root(spark)}/store-{inputs_digest(spark, sf_dir)}"
    there = path_exists(spark, root)  # a released run folder takes its store along
    tables = _OPENED.get(root) if there else None
    if tables is None:
        if not there:
            t = Tables(spark, sf_dir)
            attempt = f"{run_root(spark)}/attempt-{uuid.uuid4().hex}"
            load_all(spark, service_rows(t), cancel_code_rows(t), attempt, rejects_root=f"{attempt}/_rejects")
            if not rename(spark, attempt, root):
                remove(spark, attempt)  # another load of the same inputs came first
        # Opened once per session: partition discovery and footers are read once.
        tables = _OPENED[root] = open_star_schema(spark, root)
    return tables
