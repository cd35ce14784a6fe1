"""Pages are walked for rows only where they have a table; what comes of them is the same."""

from catalogspark.operators import markup

HTML = [
    (1, "<TABLE><tr><th>A</th><th>B</th></tr><tr><td>x &amp; y</td><td>2</td></tr></TABLE><p>said</p>"),
    (2, "<p>no rows here</p><tr><td>1</td><td>2</td></tr>"),
    (3, None),
    (4, ""),
    (5, "<table\n><tr><td>1</td><td><table><tr><td>a</td><td>b</td></tr></table></td></tr></table>"),
    (6, "one</table>two"),
]


def test_pages_without_a_table_need_no_walk(spark):
    pages = spark.createDataFrame(HTML, "page_id long, html string")
    rows = markup.table_rows(pages)
    assert sorted((r.page_id, r.table_no, r.row_no, r.cells, r.headers) for r in rows.collect()) == [
        (1, 0, 1, ["x & y", "2"], ["A", "B"]), (5, 0, 0, ["1", "a b", "a", "b"], None), (5, 0, 1, ["a", "b"], None), (5, 1, 0, ["a", "b"], None),
    ]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("(?i)<table")


def test_texts_outside_tables_are_as_before(spark):
    pages = spark.createDataFrame(HTML, "page_id long, html string")
    assert [(r.page_id, r.pos, r.text) for r in markup.text_records(pages).orderBy("page_id", "pos").collect()] == [(1, 0, "said"), (2, 0, "no rows here"), (2, 1, "12"), (6, 0, "one"), (6, 1, "two")]
