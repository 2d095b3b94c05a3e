"""HTML table extraction."""

import pytest

from signalbox.constants import KNOWN_BAD_OPERATOR_ROWS
from signalbox.operators.incidents import operator_info
from signalbox.sources.html import extract_html_table, table_columns, table_of

PAGE = """<html><table class="infobox"><tr><th>Code</th></tr><tr><td>decoy</td></tr></table>
<table border="3" class="dataframe wikitable"><thead><tr><th>Code</th><th>Cause</th>
<th>Abbreviation</th></tr></thead><tbody>
<tr><td>AA</td><td><a href="/x">text1</a></td><td>ACCEPTANCE</td></tr>
<tr><td>AC</td><td>text2 &amp; more</td><td>TRAIN PREP</td></tr>
<tr><td> AD </td><td>text3</td><td>WTG STAFF</td></tr>
<tr><td>ZZ</td><td>text4</td><td>SYS LIR</td></tr></tbody></table></html>"""


def test_first_wikitable_by_header(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    rows = table_columns(extract_html_table(pages, "wikitable"), ["Code", "Cause", "Missing"])
    got = [(r["row_pos"], r["Code"], r["Cause"], r["Missing"]) for r in rows.orderBy("row_pos").collect()]
    assert [g[1] for g in got] == ["AA", "AC", "AD", "ZZ"]
    assert got[0][2] == "text1" and got[1][2] == "text2 & more" and got[0][3] is None


def test_operator_info_appends_and_drops_named_rows_only(spark):
    rows = spark.createDataFrame(
        [(page, i, f"Op{page}-{i}", f"C{i}", "80%" if i % 2 else "n/a") for page in ("p", "q") for i in range(25)],
        "url string, row_pos int, Operator string, Code string, `Passenger satisfaction[1]` string")
    info = operator_info(rows, spark).collect()
    assert len(info) == 50 + 6 and "Island Line" in {r["operator_name"] for r in info}
    assert {r["customer_satisfaction"] for r in info if r["operator_name"] in ("Opp-1", "Opp-2")} == {80.0, None}
    some = {r["operator_name"] for r in operator_info(rows, spark, ("url", {"p": KNOWN_BAD_OPERATOR_ROWS})).collect()}
    assert len(some) == 50 - 2 + 6 and "Opp-9" not in some and "Opq-9" in some


@pytest.mark.parametrize("page,want", [
    ("<TABLE CLASS='x wikitable'><TR><TH>Code<th>Name<tr><td rowspan=2>a</td><td>it&#8217;s</td></tr><tr><td>y</td></tr></TABLE>",
     [["Code", "Name"], ["a", "it’s"], ["a", "y"]]),
    ("<table class=wikitable><tr><td>a<table class=wikitable><tr><td>inner</td></tr></table>b</td><td>c</td></tr></table>", [["ab", "c"]]),
    ("<table class=wikitable><tr><td colspan=2>w<td rowspan=3>x<tr><td>1<td>2<tr><td>3<td>4<td>5</table>",
     [["w", "w", "x"], ["1", "2", "x"], ["3", "4", "x", "5"]]),
    ("<table class='wikitables'><tr><td>other class</td></tr></table>", []),
    ("<table class='wikitable'><tr><td rowspan='x'>&nbsp;a&eacute;<!-- no --><b>b</b> </td></tr>", [["aéb"]]),
    ("", []), (None, []), ("</td></table><tr><td>stray", []),
])
def test_tables_as_found_on_pages(page, want):
    assert table_of(page, "wikitable") == want


def test_second_table_and_pages_without(spark):
    two = PAGE.replace("infobox", "wikitable")
    pages = spark.createDataFrame([(1, two), (2, "<p>none</p>"), (3, None)], "page_id long, html string")
    assert {r["page_id"] for r in extract_html_table(pages, "wikitable", 1).collect()} == {1}
    assert [r["Code"] for r in table_columns(extract_html_table(pages, "wikitable", 0), ["Code"]).collect()] == ["decoy"]
