"""Text, tables, lists and links of web pages by markup expressions.

Plain text comes from expressions alone. What depends on which element stands in
which (items of nested lists, rows of nested tables, units without units in them)
comes from the walk of functions/tree.py.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.functions import text as X
from catalogspark.functions import tree as T
from catalogspark.functions import urls as U

# Tags that end a text record, and tags without content of their own.
BLOCKS = "address|article|aside|blockquote|dd|details|div|dt|figcaption|figure|footer|h1|h2|h3|h4|h5|h6|header|li|main|nav|p|pre|section|summary"
DEAD = "head|noscript|script|style|template"
MAX_SENTENCE = 16 * 1024

_CUT = "\x01"


def live(html: Column) -> Column:
    """Markup without comments and dead regions."""
    return F.regexp_replace(F.regexp_replace(html, "(?s)<!--.*?-->", ""), rf"(?is)<({DEAD})\b.*?</\1\s*>", "")


def plain(fragment: Column) -> Column:
    """Text of a fragment: tags as spaces, entities resolved, space collapsed."""
    return X.collapse_ws(X.unescape(F.regexp_replace(fragment, "(?s)<[^>]*>", " ")))


def text_of(piece: Column) -> Column:
    """Text between tags: entities resolved, space collapsed."""
    return X.collapse_ws(X.unescape(piece))


def outside_tables(html: Column) -> Column:
    """Markup without its tables, nested ones included; a table that is never ended ends with the page, an end without a table is nothing."""
    return X.once(html, lambda h: F.when(F.rlike(h, F.lit("(?i)</?table")), _outside(h)).otherwise(h))


def _outside(html: Column) -> Column:
    parts = F.split(html, r"(?is)(?=<table\b)|(?<=</table\s{0,9}>)")
    none = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"))

    def step(so_far: Column, part: Column) -> Column:
        begins, ends = F.rlike(part, F.lit(r"(?i)^<table\b")), F.rlike(part, F.lit(r"(?i)</table\s{0,9}>$"))
        depth = so_far["depth"] + begins.cast("int")
        kept = F.when(depth == 0, F.concat(so_far["kept"], F.array(part))).otherwise(so_far["kept"])
        return F.struct(F.greatest(depth - ends.cast("int"), F.lit(0)).alias("depth"), kept.alias("kept"))

    return F.array_join(F.aggregate(parts, none, step)["kept"], _CUT)


def _records(html: Column) -> Column:
    body = outside_tables(live(html))
    body = F.regexp_replace(body, rf"(?i)</?(?:{BLOCKS}|br|hr)\b[^>]*>", _CUT)
    body = F.regexp_replace(body, "(?s)<[^>]*>", "")
    return F.filter(F.transform(F.split(body, _CUT), lambda r: X.collapse_ws(X.unescape(r))), lambda r: r != "")


def text_records(pages: DataFrame) -> DataFrame:
    """(page_id, pos, text): text between block boundaries, tables left out."""
    return pages.select("page_id", F.posexplode(_records(F.col("html"))).alias("pos", "text"))


def list_items(pages: DataFrame) -> DataFrame:
    """(page_id, pos, text) of the list items; an item's text holds that of the items inside it, which are items too."""
    return pages.select("page_id", F.posexplode(F.transform(T.items("html"), text_of)).alias("pos", "text"))


def table_rows(pages: DataFrame) -> DataFrame:
    """(page_id, table_no, row_no, cells, headers): rows of two cells or more under the header row before them.

    Tables count in the order they open. A table's rows include those of tables
    inside it, which are tables of their own as well.
    """
    clean = lambda cells: F.transform(cells, text_of)
    # Cleaned before rows part, so that filters on cells do not clean them once more.
    read = F.transform(T.rows("html"), lambda r: F.struct(r["table_no"].alias("table_no"), r["row_no"].alias("row_no"), clean(r["cells"]).alias("cells"), clean(r["headers"]).alias("headers")))
    some = pages.where(F.rlike("html", F.lit("(?i)<table")))  # others have no row, and need no walk
    return some.select("page_id", F.explode(read).alias("r")).select("page_id", "r.table_no", "r.row_no", "r.cells", "r.headers")


def source_records(texts: DataFrame) -> DataFrame:
    """(doc_id, pos, record): the units a quote must lie in, each once, in the order of the page; lines of plain text."""
    lines = F.split("text", r"\R")
    markup = F.rlike("text", F.lit("<[A-Za-z][^>]*>"))
    # Plain texts need no walk: they go to it as nulls.
    found = F.when(markup, T.records(F.when(markup, F.col("text")))).otherwise(lines)
    records = F.array_distinct(F.filter(F.transform(found, text_of), lambda r: r != ""))
    return texts.select("doc_id", F.posexplode(records).alias("pos", "record"))


def sentences(records: DataFrame, text: str = "text") -> DataFrame:
    """records' keys with (sentence_no, sentence): split after . ! ? before space; over-long ones are left out."""
    keys = [c for c in records.columns if c != text]
    return records.select(*keys, F.posexplode(F.split(text, r"(?<=[.!?])(?U)\s+")).alias("sentence_no", "sentence")).where(F.length("sentence") <= MAX_SENTENCE)


def extract_links(pages: DataFrame, wanted: str, blocked: str) -> DataFrame:
    """(page_id, url): each link once whose label, path and query hold a wanted term and no blocked one."""
    anchors = F.arrays_zip(
        F.regexp_extract_all("html", F.lit(r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a\s*>"""), F.lit(1)).alias("href"),
        F.regexp_extract_all("html", F.lit(r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a\s*>"""), F.lit(2)).alias("label"),
    )
    rows = pages.select("page_id", "url", F.posexplode(anchors).alias("pos", "a")).select("page_id", "pos", F.col("url").alias("base"), X.unescape(F.col("a.href")).alias("href"), plain(F.col("a.label")).alias("label"))
    root = F.concat(U.part(F.col("base"), 1), F.lit("://"), U.part(F.col("base"), 2))
    folder = F.regexp_replace(U.part(F.col("base"), 3), "[^/]*$", "")
    whole = F.rlike("href", F.lit(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"))
    target = (
        F.when(whole, F.col("href"))
        .when(F.startswith("href", F.lit("//")), F.concat(U.part(F.col("base"), 1), F.lit(":"), "href"))
        .when(F.startswith("href", F.lit("/")), F.concat(root, "href"))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), "href"))
    )
    rows = rows.withColumn("target", U.search_url(target)).where("target is not null")
    hay = F.lower(F.replace(F.concat_ws(" ", "label", U.part(F.col("target"), 3), U.part(F.col("target"), 4)), F.lit("-"), F.lit(" ")))
    good = rows.where(F.rlike(hay, F.lit(wanted)) & ~F.rlike(hay, F.lit(blocked)))
    return good.groupBy("page_id", F.col("target").alias("url")).agg(F.min("pos").alias("pos")).select("page_id", "url")
