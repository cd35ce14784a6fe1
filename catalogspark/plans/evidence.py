"""Queries of the evidence predicates. Their SQL picks rows by template, so it shares no pattern with them."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogspark.operators import evidence as E
from catalogspark.plans.adapters import read
from catalogspark.plans.registry import query
from catalogspark.session import spread

# Twelve claims about a title; T stands for it.
CLAIMS = {
    0: "T is confirmed as Profile 7 FEL.",
    1: "T (1999) has Dolby Vision P7 FEL",
    2: "T is not confirmed as P7 FEL",
    3: "T: P7, FEL with TrueHD Atmos",
    4: "T is P7 MEL, other disc is P7 FEL",
    5: "T is P7 FEL and Casablanca is great",
    6: "T P7 FEL: no",
    7: "T is Profile 7 FEL, not MEL",
    8: "T REMUX is P7 FEL",
    9: "T is P7 only",
    10: "T does not have a Profile-7 FEL",
    11: "T has no doubt P7 FEL",
}


def _claim_sql(title: str) -> str:
    cases = " ".join(f"WHEN {k} THEN {' || '.join(repr(x) if x != 'T' else title for x in _cut(v))}" for k, v in CLAIMS.items())
    return f"CASE p_partkey % 12 {cases} END"


def _cut(claim: str) -> list[str]:
    head, tail = claim[:1], claim[1:]
    return [head, tail]


TITLE = "upper(substr(p_name, 1, 1)) || substr(p_name, 2)"
_ROWS = f"SELECT p_partkey AS seq, {TITLE} AS title, {_claim_sql('(' + TITLE + ')')} AS claim FROM part"


def _claims(spark, sf_dir):
    return spark.sql(_ROWS.replace("FROM part", "FROM {part}"), part=spread(read(spark, sf_dir, "part")))


@query("SELECT p_partkey AS seq, p_partkey % 12 IN (0, 1, 7, 11) AS direct FROM part")
def direct_evidence(spark, sf_dir):
    rows = _claims(spark, sf_dir)
    return rows.select("seq", E.direct(F.col("claim"), F.col("title")).alias("direct"))


@query("SELECT p_partkey AS seq, p_partkey % 12 IN (2, 6, 10) AS denied, p_partkey % 12 = 4 AS rival FROM part")
def denial_filter(spark, sf_dir):
    return _claims(spark, sf_dir).select("seq", E.denied(F.col("claim")).alias("denied"), E.unnegated_rival(F.col("claim")).alias("rival"))


_CLAUSES = "SELECT p_partkey AS seq, p_name, CASE p_partkey % 4 WHEN 0 THEN 'P7 FEL, with TrueHD; ' || p_name WHEN 1 THEN 'has dolby and vision' WHEN 2 THEN p_name || ' & more' ELSE 'P7 FEL' END AS c FROM part"


@query("SELECT p_partkey AS seq, CASE p_partkey % 4 WHEN 0 THEN 'P7 FEL# with TrueHD# ' || p_name WHEN 1 THEN 'has dolby # vision' WHEN 2 THEN p_name || ' # more' ELSE 'P7 FEL' END AS clauses FROM part")
def subject_clauses(spark, sf_dir):
    rows = spark.sql(_CLAUSES.replace("FROM part", "FROM {part}"), part=spread(read(spark, sf_dir, "part")))
    return rows.select("seq", F.array_join(E.subject_clauses(F.col("c")), "#").alias("clauses"))


@query("SELECT p_partkey AS seq, p_partkey % 4 = 3 AS correlated FROM part")
def correlated_evidence(spark, sf_dir):
    rows = spark.sql(_CLAUSES.replace("FROM part", "FROM {part}"), part=spread(read(spark, sf_dir, "part")))
    return rows.select("seq", E.correlated(F.col("c")).alias("correlated"))


@query(f"SELECT p_partkey AS page_id, {TITLE} || CASE p_partkey % 12 WHEN 8 THEN ' REMUX' ELSE '' END AS title, CASE p_partkey % 12 WHEN 1 THEN '1999' ELSE 'Unknown' END AS year FROM part WHERE p_partkey % 12 IN (0, 1, 7, 8, 11)")
def sentence_evidence(spark, sf_dir):
    rows = _claims(spark, sf_dir).select(F.col("seq").alias("page_id"), F.concat(F.lit("What a day. "), "claim", F.lit(". Next one.")).alias("text"))
    return E.sentence_evidence(rows).select("page_id", "title", "year")


@query("SELECT p_partkey AS page_id, p_name AS title, CAST(1970 + p_size AS STRING) AS year, CAST(p_size + 0.25 AS DOUBLE) AS bitrate FROM part WHERE p_partkey % 3 = 0")
def list_item_evidence(spark, sf_dir):
    items = spread(read(spark, sf_dir, "part")).selectExpr("p_partkey AS page_id", "CASE p_partkey % 3 WHEN 0 THEN p_name || ' (' || (1970 + p_size) || ') disc 2, FEL - ' || p_size || '.25 Mb/s' WHEN 1 THEN p_name || ' FEL - 3 Mb/s' ELSE 'Zidoo Z9X (2020) FEL - 3 Mb/s' END AS text")
    return E.list_item_evidence(items).select("page_id", "title", "year", "bitrate")


@query(
    f"""
SELECT p_partkey AS page_id, p_name AS title, CASE WHEN p_partkey % 2 = 0 THEN CAST(1970 + p_size AS STRING) ELSE 'Unknown' END AS year
FROM part WHERE p_partkey % 5 IN (0, 1)"""
)
def table_evidence(spark, sf_dir):
    rows = spread(read(spark, sf_dir, "part")).selectExpr(
        "p_partkey AS page_id",
        "array('1', p_name || CASE WHEN p_partkey % 2 = 0 THEN ' (' || (1970 + p_size) || ')' ELSE '' END, CASE p_partkey % 5 WHEN 0 THEN 'Profile 7 FEL' WHEN 1 THEN 'P7 FEL' WHEN 2 THEN 'P7 MEL' WHEN 3 THEN 'P7 FEL: no' ELSE 'Other Film is P7 FEL' END, p_brand) AS cells",
        "array('Rank', 'Title', 'Layer', 'Studio') AS headers",
    )
    return E.table_evidence(rows).select("page_id", "title", "year")


@query("SELECT p_partkey AS seq, p_partkey % 4 <> 1 AND p_partkey % 4 <> 2 AS title_like, p_partkey % 4 = 1 AS device FROM part")
def title_filter(spark, sf_dir):
    rows = spread(read(spark, sf_dir, "part")).selectExpr("p_partkey AS seq", "CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN 'the ' || p_name || ' player' WHEN 2 THEN repeat(p_name, 20) ELSE p_brand END AS t")
    return rows.select("seq", E.looks_like_title(F.col("t")).alias("title_like"), E.is_device(F.col("t")).alias("device"))


_GROUND_SQL = """
SELECT p_partkey AS seq, CASE p_partkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 'evidence-not-found' WHEN 2 THEN 'negated-fel' WHEN 3 THEN 'missing-affirmative-fel' WHEN 4 THEN 'year-not-in-evidence' WHEN 5 THEN 'title-not-bound' WHEN 6 THEN 'device-title' ELSE 'excluded-format' END AS reason FROM part"""


def _grounded(spark, sf_dir):
    rows = spread(read(spark, sf_dir, "part")).selectExpr(
        "p_partkey AS seq",
        "CASE p_partkey % 8 WHEN 5 THEN 'quite another' WHEN 6 THEN 'Zidoo player' ELSE p_name END AS title",
        "CASE p_partkey % 8 WHEN 4 THEN '1901' WHEN 0 THEN cast(1970 + p_size as string) ELSE 'Unknown' END AS year",
        "'http://x.example/' || p_partkey AS source_url",
        "p_name || CASE p_partkey % 8 WHEN 2 THEN ' is not P7 FEL' WHEN 3 THEN ' is P7' WHEN 7 THEN ' REMUX P7 FEL' ELSE ' (' || (1970 + p_size) || ') is P7 FEL' END AS claim",
    )
    pages = rows.select(F.col("source_url").alias("url"), F.concat(F.lit("<p>before</p><p>"), "claim", F.lit("</p><ul><li>after</li></ul>")).alias("text"))
    candidates = rows.select("seq", "title", "year", "source_url", F.when(F.col("seq") % 8 == 1, F.lit("never said")).otherwise(F.col("claim")).alias("evidence"))
    return E.ground(candidates, pages)


@query(_GROUND_SQL)
def ground_candidates(spark, sf_dir):
    return _grounded(spark, sf_dir).select("seq", "reason")


@query(f"SELECT reason, count(*) AS n FROM ({_GROUND_SQL}) WHERE reason IS NOT NULL GROUP BY reason")
def rejection_counts(spark, sf_dir):
    return E.rejection_counts(_grounded(spark, sf_dir))


#: A sentence of free parts: what leads in, how title and year stand, the order of markers, and what follows them.
_GRID = """
SELECT p_partkey AS page_id, p_name AS t, CAST(1970 + p_size AS STRING) AS y, p_partkey % 3 AS lead, (p_partkey // 3) % 3 AS form, (p_partkey // 9) % 2 AS turned, (p_partkey // 18) % 7 AS tail FROM part"""


@query(f"SELECT page_id, t AS title, CASE WHEN form = 0 THEN 'Unknown' ELSE y END AS year FROM ({_GRID}) WHERE lead <> 2 AND tail < 4")
def sentence_grid(spark, sf_dir):
    """All combinations of lead, form, marker order and tail; a report of what some list says names no title, and a denial or a rival ends it."""
    rows = spark.sql(_GRID.replace("//", "DIV").replace("FROM part", "FROM {part}"), part=spread(read(spark, sf_dir, "part")))
    lead = F.when(F.col("lead") == 1, "The disc for ").when(F.col("lead") == 2, "According to the list, ").otherwise("")
    year = F.concat(F.lit(" ("), "y", F.lit(")"))
    form = F.when(F.col("form") == 0, F.lit(" is ")).when(F.col("form") == 1, F.concat(year, F.lit(" is "))).otherwise(F.concat(year, F.lit(": ")))
    marks = F.when(F.col("turned") == 1, "FEL Profile 7").otherwise("P7 FEL")
    tails = F.array(*[F.lit(x) for x in ("", " confirmed by MediaInfo", ", not MEL", ", no doubt", ", never verified as FEL", " and MEL", ", other films are too")])
    text = F.concat(lead, "t", form, marks, F.get(tails, F.col("tail").cast("int")), F.lit("."))
    return E.sentence_evidence(rows.select("page_id", F.concat(F.lit("So it goes. "), text, F.lit(" The end.")).alias("text"))).select("page_id", "title", "year")


#: A claim of free parts: how the title's year stands, what follows the markers, which year the candidate has, and whether the page breaks the claim in two.
_BOUND = """
SELECT p_partkey AS seq, p_name AS t, CAST(1970 + p_size AS STRING) AS y, CAST(1971 + p_size AS STRING) AS z, p_partkey % 3 AS form, (p_partkey // 3) % 5 AS tail, (p_partkey // 15) % 3 AS asked, (p_partkey // 45) % 7 = 0 AS broken FROM part"""


@query(
    f"""
SELECT seq, reason, CASE WHEN reason IS NULL AND asked = 1 AND form > 0 THEN y WHEN asked = 0 THEN y WHEN asked = 1 THEN 'Unknown' ELSE z END AS year FROM (
  SELECT *, CASE
    WHEN broken THEN 'cross-release-evidence'
    WHEN form > 0 AND tail = 3 THEN 'ambiguous-year'
    WHEN tail IN (1, 4) OR (form = 2 AND asked = 2) THEN 'cross-release-evidence'
    WHEN asked = 0 AND form > 0 THEN NULL
    WHEN asked = 1 AND (form > 0 OR tail <> 3) THEN NULL
    WHEN asked = 2 AND form = 0 AND tail = 3 THEN NULL
    ELSE 'year-not-in-evidence' END AS reason FROM ({_BOUND}))"""
)
def ground_years(spark, sf_dir):
    """All combinations of year form, tail, asked year and broken page; the SQL decides from the parts, not from the text."""
    rows = spark.sql(_BOUND.replace("//", "DIV").replace("FROM part", "FROM {part}"), part=spread(read(spark, sf_dir, "part")))
    form = F.when(F.col("form") == 1, F.concat(F.lit(" ("), "y", F.lit(")"))).when(F.col("form") == 2, F.concat(F.lit(" "), "y")).otherwise("")
    tail = F.get(F.array(F.lit(""), F.lit("; Ronin"), F.concat(F.lit("; "), F.upper("t"), F.lit(" has TrueHD")), F.concat(F.lit(" ("), "z", F.lit(")")), F.lit(" and Heat is great")), F.col("tail").cast("int"))
    name = F.concat("t", form)
    claim = F.concat(name, F.lit(" is P7 FEL"), tail)
    page = F.when(F.col("broken"), F.concat(F.lit("<p>"), name, F.lit("</p><p>is P7 FEL"), tail, F.lit("</p>"))).otherwise(F.concat(F.lit("<p>Before.</p><ul><li>"), claim, F.lit("</li></ul>")))
    url = F.concat(F.lit("http://x.example/"), "seq")
    asked = F.when(F.col("asked") == 0, F.col("y")).when(F.col("asked") == 1, F.lit("Unknown")).otherwise(F.col("z"))
    candidates = rows.select("seq", F.col("t").alias("title"), asked.alias("year"), url.alias("source_url"), claim.alias("evidence"))
    return E.ground(candidates, rows.select(url.alias("url"), page.alias("text"))).select("seq", "reason", "year")
