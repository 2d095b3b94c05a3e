"""Incident messages (S06): one pass of a pull parser over each message.

A message's fields are the first descendants of their names, in document
order and in the namespaces of ``constants``, wherever they stand: an earlier
element counts before one at the usual place, and an element of the same name
in another namespace does not count. Spark's XML reader knows neither order
nor namespaces, so the text goes through expat in Arrow batches. A value is the
text before an element's first child; none is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import NS_COMMON, NS_INCIDENT
from ..session import ship_package

#: (namespace, element) of the scalar fields.
FIELDS = [(NS_INCIDENT, "CreationTime"), (NS_INCIDENT, "IncidentNumber"), (NS_INCIDENT, "Version"),
          (NS_INCIDENT, "Planned"), (NS_COMMON, "StartTime"), (NS_COMMON, "EndTime"), (NS_INCIDENT, "Uri"),
          (NS_INCIDENT, "Summary"), (NS_INCIDENT, "IncidentPriority"), (NS_INCIDENT, "RoutesAffected")]
_PLACE = {f"{ns} {name}": i for i, (ns, name) in enumerate(FIELDS)}
_OPERATOR = f"{NS_INCIDENT} AffectedOperator"
_PARTS = {f"{NS_INCIDENT} OperatorRef": 0, f"{NS_INCIDENT} OperatorName": 1}

_OPERATORS = pa.list_(pa.struct([("OperatorRef", pa.string()), ("OperatorName", pa.string())]))
INCIDENT_SCHEMA = ", ".join(f"{name} string" for _, name in FIELDS) + (
    ", Operators array<struct<OperatorRef string, OperatorName string>>, _corrupt_record string")


def read_message(text: str | None) -> tuple[list[str | None], list[list[str | None]]] | None:
    """(scalar values in the order of ``FIELDS``, [ref, name] of each affected
    operator) of a message; None when it is not well-formed."""
    values: list[str | None] = [None] * len(FIELDS)
    met: set[int] = set()
    operators: list[list[str | None]] = []
    inside: list[list] = []       # operators that are open: [value, value, met, met]
    row: list | None = None       # whose value ``at`` is being read
    at = 0
    root = True

    def start(name, _):
        nonlocal row, at, root
        row = None
        if root:
            root = False
            return
        i = _PLACE.get(name)
        if i is not None:
            if i not in met:
                met.add(i)
                row, at = values, i
        elif name == _OPERATOR:
            inside.append([None, None, False, False])
            operators.append(inside[-1])
        elif inside and name in _PARTS:
            i = _PARTS[name]
            if not inside[-1][2 + i]:
                inside[-1][2 + i] = True
                row, at = inside[-1], i

    def end(name):
        nonlocal row
        row = None
        if name == _OPERATOR and inside:
            inside.pop()

    def characters(data):
        if row is not None:
            row[at] = data if row[at] is None else row[at] + data

    parser = expat.ParserCreate(namespace_separator=" ")
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, characters
    try:
        parser.Parse(text or "", True)
    except (expat.ExpatError, ValueError):
        return None
    return values, [o[:2] for o in operators]


#: What a message that is not well-formed has instead of values and operators.
_BROKEN: tuple[list, list] = ([None] * len(FIELDS), [])


def _structs(raw: list[str | None]) -> pa.StructArray:
    """The parsed messages as ``INCIDENT_SCHEMA`` has them."""
    rows = [read_message(t) for t in raw]
    fields = zip(*[(r or _BROKEN)[0] for r in rows]) if rows else [()] * len(FIELDS)
    columns = [pa.array(c, pa.string()) for c in fields]
    lists = [r[1] if r else [] for r in rows]
    parts = [pa.array([o[i] for ops in lists for o in ops], pa.string()) for i in (0, 1)]
    ends = [0, *accumulate(map(len, lists))]
    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(parts, fields=list(_OPERATORS.value_type)),
                                            type=_OPERATORS, mask=pa.array([r is None for r in rows], pa.bool_())))
    columns.append(pa.array([(t or "") if r is None else None for t, r in zip(raw, rows)], pa.string()))
    return pa.StructArray.from_arrays(columns, fields=[
        *[pa.field(name, pa.string()) for _, name in FIELDS], pa.field("Operators", _OPERATORS), pa.field("_corrupt_record", pa.string())])


def _read(batches: Iterator[pa.RecordBatch], keep: bool = True) -> Iterator[pa.RecordBatch]:
    for b in batches:
        msg = _structs(b.column(b.num_columns - 1).to_pylist())
        others = b.num_columns if keep else b.num_columns - 1
        yield pa.RecordBatch.from_arrays([*b.columns[:others], msg], names=[*b.schema.names[:others], "msg"])


def _read_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _read(batches, False)


def parse_incidents(messages: DataFrame, column: str = "value", keep_text: bool = True) -> DataFrame:
    """Text column of XML messages -> struct column ``msg`` (malformed text
    lands in ``msg._corrupt_record``) beside the text as ``raw``; without
    ``keep_text`` the text does not come back from the parser's tasks."""
    ship_package(messages.sparkSession)
    others = [c for c in messages.columns if c != column]
    rows = messages.select(*others, messages[column].alias("raw"))
    msg = T.StructField("msg", T.StructType.fromDDL(INCIDENT_SCHEMA))
    kept = rows.schema if keep_text else rows.schema[:-1]
    return rows.mapInArrow(_read if keep_text else _read_only, T.StructType([*kept, msg]))


def pack_message(msg: str = "msg") -> Column:
    """A parsed message as JSON text, to go through steps that take plain columns."""
    return F.to_json(msg)


def unpack_messages(messages: DataFrame, packed: str = "parsed") -> DataFrame:
    """``msg`` from the column that ``pack_message`` made, in place of that column."""
    options = {"mode": "FAILFAST", "columnNameOfCorruptRecord": "_no_such_field"}
    return messages.select(*[c for c in messages.columns if c != packed],
                           F.explode(F.array(F.from_json(packed, INCIDENT_SCHEMA, options))).alias("msg"))


def read_incident_files(spark: SparkSession, path: str) -> DataFrame:
    """One message per file under ``path`` (whole file as text), parsed."""
    text = spark.read.option("wholetext", True).text(path)
    return parse_incidents(text)
