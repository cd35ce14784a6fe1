"""Which extractor reads a page, by its host and by how far its source is trusted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from catalogspark.functions import text as X
from catalogspark.functions import urls as U
from catalogspark.operators import evidence, markup
from catalogspark.session import stored
from catalogspark.sources import lists

FIELDS = ("page_id", "place", "title", "year", "quote", "evidence_type")
Extractor = Callable[[DataFrame], DataFrame]


def with_route(pages: DataFrame, registry: DataFrame) -> DataFrame:
    """pages (page_id, url, html) of the registry (url, strictness), with `route`. Pages meet their source by its key."""
    r = registry.select(U.source_key(F.col("url")).alias("k"), (F.col("strictness") == "always-fel").alias("trusted")).groupBy("k").agg(F.bool_or("trusted").alias("trusted"))
    on = lambda name: F.contains("host", F.lit(name))
    route = (
        F.when(on("docs.google.com"), F.when(F.col("trusted"), "trusted-sheet").otherwise("sheet"))
        .when(on("reddit.com"), "comments")
        .when(F.col("trusted") & on("github.com"), "markdown")
        .when(F.col("trusted") & on("web.archive.org"), "archive")
        .when(F.col("trusted") & on("letterboxd.com"), "items")
        .otherwise("evidence")
    )
    keyed = X.held(pages, "k", U.source_key(F.col("url")))
    return X.held(keyed.join(r, "k"), "host", U.host(F.col("url"))).withColumn("route", route).drop("k", "trusted", "host")


def _fields(df: DataFrame, *place: str, quote=None, kind: str | None = None, part: int = 0) -> DataFrame:
    """The candidate columns; `place` orders a page's candidates: first by part, then by the numbers that the extractor gives."""
    year = F.coalesce(F.col("year"), F.lit(X.UNKNOWN))
    text = F.col("quote") if quote is None else quote
    at = F.array(F.lit(part).cast("long"), *[F.col(c).cast("long") for c in place]).alias("place")
    return df.select("page_id", at, "title", year.alias("year"), text.alias("quote"), (F.col("evidence_type") if kind is None else F.lit(kind)).alias("evidence_type"))


def _lines(pages: DataFrame, text) -> DataFrame:
    return pages.select("page_id", F.posexplode(F.split(text, r"\R")).alias("line_no", "line"))


def _sheet(trusted: bool) -> Extractor:
    def read(pages: DataFrame) -> DataFrame:
        rows = _lines(pages, F.col("html")).select(F.col("page_id").alias("sheet"), F.col("line_no").alias("row_no"), "line")
        return _fields(lists.sheet_rows(rows, trusted=trusted).withColumnRenamed("sheet", "page_id"), "row_no")

    return read


def _list(label: str) -> Extractor:
    def read(pages: DataFrame) -> DataFrame:
        plain = F.regexp_replace(F.regexp_replace(F.col("html"), r"(?i)</?(?:li|p|br|div|h[1-6])\b[^>]*>", "\n"), "(?s)<[^>]*>", "")
        rows = _lines(pages, X.unescape(plain)).select(F.struct("page_id", "line_no").alias("seq"), "line")
        return _fields(lists.list_lines(rows, label).select("*", "seq.page_id", "seq.line_no"), "line_no")

    return read


def _dated(title: str = "title", year: str = "year"):
    return F.concat(title, F.lit(" ("), year, F.lit(")"))


def _evidence(pages: DataFrame) -> DataFrame:
    table = evidence.table_evidence(markup.table_rows(pages))
    said = evidence.sentence_evidence(markup.text_records(pages))
    items = evidence.list_item_evidence(markup.list_items(pages))
    return _fields(table, "table_no", "row_no").unionByName(_fields(said, "pos", "sentence_no", part=1)).unionByName(_fields(items, "pos", part=2))


#: The extractor of each route: a function of pages (page_id, url, html). Callers may pass others.
EXTRACTORS: dict[str, Extractor] = {
    "sheet": _sheet(False),
    "trusted-sheet": _sheet(True),
    "comments": lambda pages: _fields(lists.comment_lists(pages), "line_no", "pos", quote=_dated(), kind="reddit-list"),
    "markdown": _list("github"),
    "archive": _list("discourse"),
    "items": lambda pages: _fields(lists.item_attributes(pages), "pos", quote=_dated(), kind="letterboxd-list"),
    "evidence": _evidence,
}


def route_sources(pages: DataFrame, registry: DataFrame, extractors: dict[str, Extractor] | None = None) -> tuple[DataFrame, DataFrame]:
    """(candidates, errors) of all registered pages. A page without markup is an error row and stops nothing.

    Pages meet their sources once and are stored by route, so that an extractor reads its own pages.
    """
    routed = stored(with_route(pages, registry).sortWithinPartitions("route"))
    errors = routed.where("html is null").select("page_id", "route", F.lit("no content").alias("error"))
    good = routed.where("html is not null")
    out = None
    for name, extract in (EXTRACTORS | (extractors or {})).items():
        part = extract(good.where(F.col("route") == name).drop("route"))
        if not isinstance(part.schema["place"].dataType, ArrayType):  # an extractor of one's own may number by a single number
            part = part.withColumn("place", F.array(F.col("place").cast("long")))
        part = part.select(*FIELDS).withColumn("route", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out, errors
