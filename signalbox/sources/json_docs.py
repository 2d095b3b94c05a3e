"""Captured API documents (S01-S04): station searches, service details, CSV.

Documents are parsed with explicit schemas; a fetch failure is a document
with an ``error`` field and is split off, not raised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import CORRUPT, FLAT_SERVICE, SERVICE, STATION_SEARCH


JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def parse_json(docs: DataFrame, schema: StructType, column: str = "value") -> DataFrame:
    """Text column of JSON documents -> one struct column ``doc``; the text of a
    broken document lands in ``doc._corrupt_record``. The parse stands in a
    generator: a later filter or projection on fields of ``doc`` would otherwise
    be moved below it with a parse of its own, several of each text."""
    return docs.select(F.explode(F.array(F.from_json(F.col(column), schema, JSON_OPTIONS))).alias("doc"), *[
        c for c in docs.columns if c != column])


def read_json_docs(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """One JSON document per line (or per file with ``multi_line``) under ``path``."""
    return spark.read.schema(schema).options(**JSON_OPTIONS).option("multiLine", multi_line).json(path)


def read_station_searches(spark: SparkSession, path: str) -> DataFrame:
    """S01 over files."""
    return read_json_docs(spark, path, STATION_SEARCH)


def read_services(spark: SparkSession, path: str) -> DataFrame:
    """S02 over files."""
    return read_json_docs(spark, path, SERVICE)


def _doc(docs: DataFrame) -> DataFrame:
    """The struct column ``doc``, also of the flattened fields of a file read."""
    doc = F.col("doc") if "doc" in docs.columns else F.struct(*[F.col(c) for c in docs.columns])
    return docs.select(doc.alias("doc"))


def journeys(searches: DataFrame) -> DataFrame:
    """One row per journey of each good station search document."""
    good, _ = split_fetch_errors(searches, "Station")
    return good.select(F.col("doc.location.crs").alias("station_crs"), F.explode("doc.services").alias("journey"))


def split_fetch_errors(docs: DataFrame, key_field: str) -> tuple[DataFrame, DataFrame]:
    """Good documents and error documents (``error`` text plus the key
    the fetch was for: ``Station`` or ``Service``). A document that is not
    valid JSON is an error of an unknown key; its text is kept in ``document``."""
    d = _doc(docs)
    broken = F.col(f"doc.{CORRUPT}")
    good = d.where(F.col("doc.error").isNull() & broken.isNull())
    errors = d.where(F.col("doc.error").isNotNull() | broken.isNotNull()).select(
        F.when(broken.isNotNull(), F.lit("malformed document")).otherwise(F.col("doc.error")).alias("error"),
        F.col(f"doc.{key_field}").alias(key_field), broken.alias("document"))
    return good, errors


def read_service_csv(spark: SparkSession, path: str, schema: StructType = FLAT_SERVICE) -> DataFrame:
    """CSV with header and an explicit schema; a missing path gives an
    empty DataFrame instead of an error."""
    try:
        return spark.read.schema(schema).option("header", True).csv(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise
