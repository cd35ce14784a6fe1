"""Work that is heavy a row: dealt over all cores, and done once a row whatever filters follow."""

import pytest
from pyspark.sql import functions as F

from catalogspark.functions import text as X
from catalogspark.operators import evidence
from catalogspark.plans.queries import QUERIES

DATA = "/root/testdata/sf0.001"
DEALT = "rejection_counts ground_years sentence_grid sentence_evidence ingest_comment_lists nested_tables table_rows nested_records evaluate_golden".split()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def grounded(spark):
    rows = spark.createDataFrame([(1, "A Film", "Unknown", "u", "A Film is P7 FEL"), (2, "A Film", "Unknown", "u", "never said"), (3, "", "", None, None)], "seq long, title string, year string, source_url string, evidence string")
    return evidence.ground(rows, spark.createDataFrame([("u", "<p>A Film is P7 FEL</p>")], "url string, text string"))


def test_a_filter_on_the_reason_computes_nothing_again(spark):
    mentions = lambda df: optimized(df).count("set\\-top") + optimized(df).count("set-top")
    counts = evidence.rejection_counts(grounded(spark))
    assert mentions(counts) == mentions(grounded(spark))
    assert {r.reason: r.n for r in counts.collect()} == {"evidence-not-found": 2}


@pytest.mark.parametrize("name", ["sentence_grid", "sentence_evidence"])
def test_a_sentence_is_read_once(spark, name):
    assert optimized(QUERIES[name](spark, DATA)).count("confirmed\\s+to\\s+be") == 1


def test_a_line_of_comments_is_cleaned_once(spark):
    assert optimized(QUERIES["ingest_comment_lists"](spark, DATA)).count("&eacute;") == 2  # the line, and a segment's title


@pytest.mark.parametrize("name", DEALT)
def test_rows_are_dealt_before_they_are_read(spark, name):
    plan = optimized(QUERIES[name](spark, DATA))
    assert plan.count("Repartition ") >= 1


def test_entities_and_marks_as_before(spark):
    cases = {"a &amp;amp; b": "a &amp; b", "&#65;&#x42; &lt;": "AB <", "&#38;lt;": "&lt;", "plain": "plain", "": "", "&unknown; &#38;#65;": "&unknown; &#65;", None: None, "A &#233;t&#xE9;": "A été"}
    df = spark.createDataFrame([(i, k) for i, k in enumerate(cases)], "i int, c string").select("i", X.unescape(F.col("c")).alias("o"))
    assert [r.o for r in df.orderBy("i").collect()] == list(cases.values())
    titles = {"101 Dalmatians x": "101 Dalmatians x", "101 ALIENS": "ALIENS", "127 hours": "127 hours", "300 RISE of": "300 RISE of", "300 Rose": "Rose", None: None}
    df = spark.createDataFrame([(i, k) for i, k in enumerate(titles)], "i int, c string").select("i", X.clean_title(F.col("c")).alias("o"))
    assert [r.o for r in df.orderBy("i").collect()] == list(titles.values())


def test_pages_meet_their_sources_once(spark):
    from catalogspark.sources import routes

    pages = spark.createDataFrame([(1, "https://www.reddit.com/r/x/comments/k1/t", "<p>x</p>"), (2, "https://other.example/2", None)], "page_id long, url string, html string")
    found, errors = routes.route_sources(pages, pages.selectExpr("url", "'' AS strictness"))
    assert "Join" not in optimized(found) and [r.page_id for r in errors.collect()] == [2] and found.collect() == []


def test_a_custom_extractor_makes_rows_not_a_batch_a_page(spark):
    from catalogspark.sources import custom

    pages = spark.createDataFrame([(1, "A :: 2001")], "page_id long, html string")
    plan = custom.as_extractor(custom.colon_lines, "own")(pages)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPythonUDTF" in plan and "ArrowEvalPythonUDTF" not in plan
