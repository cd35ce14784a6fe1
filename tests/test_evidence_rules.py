"""Sentences, denials and readers' lines, case by case; places of candidates."""

import pytest
from pyspark.sql import functions as F

from catalogspark.operators import evidence as E
from catalogspark.plans import build
from catalogspark.sources import lists, routes

SENTENCES = {
    "The disc for Heat is Profile 7 FEL.": ("Heat", "Unknown"),
    "Blu-ray of The Core (2003) is P7 FEL.": ("The Core", "2003"),
    "According to the spreadsheet, Heat is Profile 7 FEL.": None,
    "In the list, Heat is P7 FEL.": None,
    "This old forum post says Heat is P7 FEL.": None,
    "List entry: Heat is P7 FEL.": None,
    "For the record, Heat is P7 FEL.": None,
    "Heat is P7 FEL.": ("Heat", "Unknown"),
    "Heat (1995): P7 FEL confirmed by MediaInfo.": ("Heat", "1995"),
    "Heat (1995), FEL Profile 7": ("Heat", "1995"),
    "Heat (1995) P7 FEL": ("Heat", "1995"),
    "Heat (1995): Ronin is P7 FEL.": None,
    "Heat is P7 FEL, no doubt.": ("Heat", "Unknown"),
    "Heat is P7 FEL, not MEL.": ("Heat", "Unknown"),
    "Heat is P7 FEL and MEL.": None,
    "Heat is P7, no FEL.": None,
    "Heat is not a P7 FEL.": None,
    "Heat is P7 FEL, never confirmed as FEL.": None,
    "Heat is P7 FEL without MEL, Ronin is better.": None,
    "The Page (2001) is P7 FEL.": ("The Page", "2001"),
}
DENIED = {"no P7 FEL": True, "not a full enhancement layer FEL": True, "does not have FEL": True, "never verified as FEL": True, "FEL: no": True, "FEL is not supported": True, "P7 FEL": False, "not MEL but FEL": False, "no MEL, FEL": False}
REPLIES = {"You forgot one: Heat (1995)": "Heat (1995)", "and you missed Heat (1995)": "Heat (1995)", "Don't forget Heat (1995)": "Heat (1995)", "Missing You (2001)": "You (2001)", "Heat (1995)": "Heat (1995)", "Added: Heat (1995)": "Heat (1995)"}
ASKED = {"Is this Heat (1995)": True, "Are you sure, Heat (1995)": True, "Could someone check (1995)": True, "What about Heat (1995)": True, "Why is Heat (1995)": True, "Anyone know Heat (1995)": True, "What Women Want (2000)": False, "How It Ends (2018)": False, "You Got Served (2004)": False, "Why Him (2016)": False, "Is Paris Burning (1966)": False}

#: (title, year asked, evidence): (year told, reason)
GROUNDED = {
    ("Dune", "2021", "Dune (1984), Dune (2021) Profile 7 FEL"): ("2021", "ambiguous-year"),
    ("Dune", "2021", "Dune (2021) Profile 7 FEL"): ("2021", None),
    ("Dune", "2021", "Dune 2021 Profile 7 FEL"): ("2021", None),
    ("Dune", "2021", "Dune 20215 Profile 7 FEL"): ("2021", "cross-release-evidence"),
    ("Dune", "1984", "Dune (2021) Profile 7 FEL"): ("1984", "year-not-in-evidence"),
    ("Dune", "1984", "Dune 2021 Profile 7 FEL"): ("1984", "cross-release-evidence"),
    ("Dune", "", "Dune ( 2021 ) Profile 7 FEL"): ("2021", None),
    ("Dune", "next year", "dune is P7 FEL"): ("Unknown", None),
    ("Dune", None, "Dune is P7 FEL"): ("Unknown", None),
    ("Dune", "Unknown", "Dune is P7 FEL (2021)"): ("Unknown", "year-not-in-evidence"),
    ("Dune", "2021", "Dune is P7 FEL (2021)"): ("2021", None),
    ("Alpha", "2024", "Alpha (2024) Profile 7 FEL; Beta (2024) Profile 7 FEL"): ("2024", "cross-release-evidence"),
    ("Alpha", "2024", "Alpha (2024); Beta Profile 7 FEL"): ("2024", "cross-release-evidence"),
    ("Alpha", "2024", "Alpha; Profile 7 FEL; Beta (2024)"): ("2024", "cross-release-evidence"),
    ("Alpha", "Unknown", "Alpha Profile 7 FEL; Beta"): ("Unknown", "cross-release-evidence"),
    ("Alpha", "2024", "Alpha (2024) is Profile 7 FEL; Alpha has TrueHD"): ("2024", None),
    ("Alpha", "2024", "Alphabet (2024) is Profile 7 FEL"): ("2024", "title-not-bound"),
    ("Blade Runner 2049", "2017", "Blade Runner 2049 (2017) is P7 FEL"): ("2017", None),
    ("2012", "2009", "2012 (2009) is P7 FEL"): ("2009", None),
    ("2012", "Unknown", "2012 is P7 FEL"): ("Unknown", None),
    ("Heat", "1995", "2012 (2009) and Heat (1995) is P7 FEL"): ("1995", "ambiguous-year"),
    ("No MEL", "2001", "No MEL (2001) is P7 FEL"): ("2001", None),
    (r"A\E.b", "2001", r"A\E.b (2001) is P7 FEL"): ("2001", None),
    ("A.b", "2001", "Acb (2001) is P7 FEL"): ("2001", "title-not-bound"),
    ("Été", "2001", "ÉTÉ (2001) is P7 FEL"): ("2001", None),
    ("", "2001", "Heat is P7 FEL"): ("2001", "evidence-not-found"),
    (None, "2001", None): ("2001", "evidence-not-found"),
}


def test_grounding(spark):
    """Each candidate on a page that says just its evidence, and none on a page that is not there."""
    cases = list(GROUNDED.items())
    rows = spark.createDataFrame([(i, t, y, f"u{i}", e) for i, ((t, y, e), _) in enumerate(cases)], "seq long, title string, year string, source_url string, evidence string")
    found = {r.seq: (r.year, r.reason) for r in E.ground(rows, rows.select(F.col("source_url").alias("url"), F.col("evidence").alias("text"))).collect()}
    assert {k: found[i] for i, (k, _) in enumerate(cases)} == dict(cases)
    lost = E.ground(rows, rows.where("false").select(F.col("source_url").alias("url"), F.col("evidence").alias("text")))
    assert {r.reason for r in lost.collect()} == {"evidence-not-found"}
    assert E.ground(rows.where("false"), rows.select(F.col("source_url").alias("url"), F.col("evidence").alias("text"))).count() == 0


def test_sentences(spark):
    rows = spark.createDataFrame(list(enumerate(SENTENCES)), "page_id long, text string")
    found = {r.page_id: (r.title, r.year) for r in E.sentence_evidence(rows).collect()}
    assert {s: found.get(i) for i, s in enumerate(SENTENCES)} == SENTENCES


@pytest.mark.parametrize(("cases", "rule"), [(DENIED, E.denied), (REPLIES, lists.without_lead_in), (ASKED, lists.is_asking)])
def test_lines(spark, cases, rule):
    rows = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.v for r in rows.select("t", rule(F.col("t")).alias("v")).collect()} == cases


def test_first_candidate_of_a_page_leads(spark):
    """Equal titles keep the quote that stands first on the first page, with page ids beyond 2**39."""
    rows = [((1 << 45) + p, [0, n], "Heat", "1995", f"quote {p} {n}", "sentence") for p in (1, 0) for n in (4, 3, 2, 1, 0)]
    found = build.rows_of(spark.createDataFrame(rows, "page_id long, place array<long>, title string, year string, quote string, evidence_type string")).collect()
    assert [(r.movie_title, r.quote) for r in found] == [("Heat", "quote 0 0")]


def test_lines_of_long_pages_stay_on_their_page(spark):
    """Two million lines, and page ids beyond 2**33."""
    pages = spark.range(2).select((F.col("id") + (1 << 40)).alias("page_id"), F.concat(F.lit("https://github.com/"), "id").alias("url"), F.concat(F.repeat(F.lit("x\n"), 2_000_000), F.lit("Heat "), "id", F.lit(" (1995)")).alias("html"))
    found, _ = routes.route_sources(pages, pages.select("url", F.lit("always-fel").alias("strictness")))
    assert sorted((r.page_id - (1 << 40), r.title, r.place[1]) for r in found.collect()) == [(0, "Heat 0", 2_000_000), (1, "Heat 1", 2_000_000)]
