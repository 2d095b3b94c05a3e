"""HTML tables in captured pages (S05), extracted by a Spark job.

Each page is parsed in a task: the n-th table of a CSS class with its header
row and data rows. Names and attributes may be in any case and quoted in any
way, character references are decoded, ``rowspan`` and ``colspan`` repeat a
cell where it reaches, and a table inside a cell is not part of the table
around it. Pages without such a table give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

#: No cell reaches further than HTML allows.
MOST_SPAN = 1000


class _Tables(HTMLParser):
    """The rows of every table of a class; a cell is (text, rowspan, colspan)."""

    def __init__(self, css_class: str):
        super().__init__(convert_charrefs=True)
        self.css_class = css_class
        self.tables: list[list[list[tuple[str, int, int]]]] = []
        self.open: list[dict] = []  # tables around this place

    def handle_starttag(self, tag, attrs):
        got = dict(attrs)
        if tag == "table":
            rows = None
            if self.css_class in (got.get("class") or "").split():
                rows = []
                self.tables.append(rows)
            self.open.append({"rows": rows, "cell": None})
        elif self.open and tag in ("tr", "td", "th"):
            at = self.open[-1]
            self._close(at)
            if at["rows"] is None:
                return
            if tag == "tr":
                at["rows"].append([])
            else:
                if not at["rows"]:
                    at["rows"].append([])
                at["cell"] = ([], self._span(got.get("rowspan")), self._span(got.get("colspan")))

    @staticmethod
    def _span(text: str | None) -> int:
        return min(int(text), MOST_SPAN) or 1 if text and text.strip().isdecimal() else 1

    @staticmethod
    def _close(at: dict) -> None:
        if at["cell"]:
            text, down, across = at["cell"]
            at["rows"][-1].append(("".join(text).strip(), down, across))
            at["cell"] = None

    def handle_endtag(self, tag):
        if not self.open:
            return
        if tag in ("td", "th", "tr", "table"):
            self._close(self.open[-1])
        if tag == "table":
            self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1]["cell"]:
            self.open[-1]["cell"][0].append(data)

    def close(self):
        super().close()
        for at in self.open:
            self._close(at)


def spread(rows: list[list[tuple[str, int, int]]]) -> list[list[str]]:
    """Rows of texts, each cell repeated over the columns and rows it spans."""
    out, falling = [], {}  # column -> (text, rows it still reaches)
    for row in rows:
        line, cells, column = [], iter(row), 0
        cell = next(cells, None)
        while cell is not None or any(c >= column for c in falling):
            if column in falling:
                text, left = falling.pop(column)
                if left > 1:
                    falling[column] = (text, left - 1)
                line.append(text)
                column += 1
            elif cell is None:
                line.append("")
                column += 1
            else:
                text, down, across = cell
                for _ in range(across):
                    if down > 1:
                        falling[column] = (text, down - 1)
                    line.append(text)
                    column += 1
                cell = next(cells, None)
            # columns that fell to this row are done; later ones stay
        out.append(line)
    return out


def table_of(page: str | None, css_class: str, index: int = 0) -> list[list[str]]:
    """The texts of the page's ``index``-th table of the class, header row first."""
    parser = _Tables(css_class)
    parser.feed(page or "")
    parser.close()
    return spread([r for r in parser.tables[index] if r]) if index < len(parser.tables) else []


def extract_html_table(pages: DataFrame, css_class: str, index: int = 0,
                       html_col: str = "html", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Rows of the ``index``-th table whose class list contains ``css_class``.

    Output: ``keep`` columns, ``row_pos`` (0-based data row), ``header`` and
    ``cells`` (arrays of text). Use ``table_columns`` to name the cells.
    """
    ship_package(pages.sparkSession)
    rows = pages.select(*keep, F.col(html_col))
    texts = T.ArrayType(T.ArrayType(T.StringType()))
    out = T.StructType([*rows.schema[:-1], T.StructField("table", texts)])

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tables = [table_of(h, css_class, index) for h in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(tables, pa.list_(pa.list_(pa.string())))],
                                             names=[*b.schema.names[:-1], "table"])
    t = rows.mapInArrow(parsed, out).where(F.size("table") > 0)
    return t.select(*keep, F.get("table", 0).alias("header"), F.posexplode(F.expr("slice(table, 2, size(table))")).alias(
        "row_pos", "cells")).select(*keep, "row_pos", "header", "cells")


def table_columns(rows: DataFrame, names: Sequence[str],
                  keep: Sequence[str] = ("page_id", "row_pos")) -> DataFrame:
    """Cells looked up by header name (missing header -> null)."""
    named = [F.when(F.array_position("header", n) > 0,
                    F.try_element_at("cells", F.array_position("header", n).cast("int"))).alias(n)
             for n in names]
    return rows.select(*keep, *named)
