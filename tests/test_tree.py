"""Nested and ill-formed markup: small pages."""

import pytest
from pyspark.sql import functions as F

from catalogspark.functions import tree
from catalogspark.operators import markup


def pages(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page_id long, html string")


def texts(df, page=0):
    return [r.text for r in df.where(F.col("page_id") == page).orderBy("pos").collect()]


def squeezed(xs):
    return [" ".join(x.split()) for x in xs if x.strip()]


@pytest.mark.parametrize(
    "html",
    ["It is so<p>Unrelated</p>", "<body>It is so<p>Unrelated</p></body>", "<div>It is so<p>Unrelated</p></div>", "<div><p>Unrelated</p>It is so</div>", "<div>It <b>is</b> <span>so</span><p>Unrelated</p></div>", "<p>I<em>t is so</p>"],
)
def test_a_blocks_own_text_is_a_record(spark, html):
    assert "It is so" in texts(markup.text_records(pages(spark, html)))


def test_text_outside_nested_tables(spark):
    a = "<p>one</p><table><tr><td>x<table><tr><td>y</td></tr></table>z</td></tr></table><p>two</p></table><p>three</p>"
    b = "<p>one</p><TABLE class=a><tr><td>never ended"
    df = markup.text_records(pages(spark, a, b, "", None))
    assert texts(df) == ["one", "two", "three"] and texts(df, 1) == ["one"] and df.where("page_id > 1").count() == 0


def test_many_levels():
    html = "<div>" * 5000 + "so <b>it</b> is" + "</div>" * 5000
    assert squeezed(tree.record_texts(html)) == ["so it is"]
    assert len(tree.item_texts("<ul><li>a" * 300)) == 300
    assert squeezed(tree.item_texts("<li>a" * 3000)) == ["a"] * 3000


def test_items_of_nested_lists():
    assert squeezed(tree.item_texts("<ul><li>a<ul><li>b</li></ul>c</li><li>d")) == ["a b c", "b", "d"]
    assert squeezed(tree.item_texts("<ul><li>a<li>b</ul><p>x<ul><li>c</ul>")) == ["a", "b", "c"]


def test_rows_without_ends():
    html = "<table><tr><th>A<th>B<tr><td>1<td>2<tr><td>3<tr><td>4<td>5</table>"
    assert tree.table_cells(html) == [(0, 1, ["1", "2"], ["A", "B"]), (0, 3, ["4", "5"], ["A", "B"])]
    # A header row of a nested table heads the outer rows after it, as they are one sequence.
    html = "<table><tr><td>1</td><td><table><tr><th>A</th><th>B</th></tr></table></td></tr><tr><td>2</td><td>3</td></tr></table>"
    assert [(t, r, h) for t, r, _, h in tree.table_cells(html)] == [(0, 0, None), (0, 2, ["A", "B"])]


def test_units_of_quotes():
    assert squeezed(tree.record_texts("<div>own<p>x</p></div>")) == ["x"]
    assert squeezed(tree.record_texts("<li>own<p>x</p></li><li>y<div>z</div></li>")) == ["x", "y z", "z"]
    assert squeezed(tree.record_texts("<p>a<br>b\nc</p>")) == ["a", "b", "c"]
    assert squeezed(tree.record_texts("<b>no</b> block")) == ["no block"]
    assert squeezed(tree.record_texts("</p></div>x<p>y</li>z</p><!-- <p>no</p> --><script>if (a <b) {}</script>")) == ["y z"]


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "  x \n\n y "), (4, "a < b")], "doc_id long, text string")
    assert sorted((r.doc_id, r.pos, r.record) for r in markup.source_records(df).collect()) == [(3, 0, "x"), (3, 1, "y"), (4, 0, "a < b")]
    none = pages(spark, None, "")
    assert markup.list_items(none).count() == 0 and markup.table_rows(none).count() == 0 and markup.table_rows(none.where("false")).count() == 0
