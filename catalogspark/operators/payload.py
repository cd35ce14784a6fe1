"""Candidates and links out of model responses, as JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.functions import text as X

MAX_CANDIDATES = 500
MAX_LINKS = 100


def _variant(c: Column) -> Column:
    return F.try_parse_json(c)


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _status_ok(v: Column) -> Column:
    """No status or `completed`, and no error details."""
    status = F.try_variant_get(v, "$.status", "string")
    fine = F.coalesce(status == "completed", F.lit(True))

    def bad(name: str) -> Column:
        node = F.try_variant_get(v, f"$.{name}", "variant")
        return node.isNotNull() & ~F.is_variant_null(node)

    return fine & ~bad("error") & ~bad("incomplete_details")


def _items(v: Column, names: tuple[str, ...]) -> Column:
    """The payload itself if it is a list, else the first named list of an accepted object."""
    inner = F.coalesce(*[F.try_variant_get(v, f"$.{n}", "array<variant>") for n in names])
    return F.when(F.startswith(_kind(v), F.lit("ARRAY")), F.try_variant_get(v, "$", "array<variant>")).when(_status_ok(v), inner)


def _text(v: Column, path: str) -> Column:
    """A member that is a JSON string, else null."""
    inner = F.try_variant_get(v, path, "variant")
    return F.when(_kind(inner) == "STRING", F.try_variant_get(v, path, "string"))


def candidates(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (resp_id, source_url, payload): candidates (resp_id, pos, title, year, source_url, evidence), and (resp_id, valid)."""
    # Each response is parsed once, and each candidate read once, whatever is asked of them.
    parsed = X.held(responses.select("resp_id", "source_url", "payload"), "v", _variant(F.col("payload")))
    r = X.held(parsed, "items", _items(F.col("v"), ("items",))).select("resp_id", "source_url", "items").withColumn("fits", F.coalesce(F.size("items") <= MAX_CANDIDATES, F.lit(False)))
    each = r.where("fits").select("resp_id", "source_url", F.posexplode("items").alias("pos", "v"))
    year_node = F.try_variant_get("v", "$.year", "variant")
    year = F.when(year_node.isNull(), F.lit(X.UNKNOWN)).when(_kind(year_node).isin("BIGINT", "TINYINT", "SMALLINT", "INT"), F.try_variant_get("v", "$.year", "string")).otherwise(_text(F.col("v"), "$.year"))
    evidence_node = F.try_variant_get("v", "$.evidence", "variant")
    evidence = F.when(evidence_node.isNull(), F.lit("")).otherwise(_text(F.col("v"), "$.evidence"))
    read = F.struct(X.clean_title(_text(F.col("v"), "$.title")).alias("title"), F.trim(year).alias("year"), F.trim(evidence).alias("evidence"))
    each = X.held(each, "_r", read)
    each = each.withColumns({c: F.col("_r")[c] for c in ("title", "year", "evidence")})
    good = each.where((F.col("title") != "") & F.col("year").isNotNull() & F.col("evidence").isNotNull())
    good = good.select("resp_id", "pos", "title", F.coalesce(F.nullif("year", F.lit("")), F.lit(X.UNKNOWN)).alias("year"), "source_url", "evidence")
    n = good.groupBy("resp_id").agg(F.count(F.lit(1)).alias("n"))
    valid = r.join(n, "resp_id", "left").select("resp_id", (F.col("fits") & ((F.size("items") == 0) | (F.coalesce("n", F.lit(0)) > 0))).alias("valid"))
    return good, valid


def links(responses: DataFrame) -> DataFrame:
    """(resp_id, pos, url) of (resp_id, payload): a list or {urls}/{items}, with or without a code fence."""
    bare = F.trim("payload")
    fenced = F.startswith(bare, F.lit("```"))
    inner = F.when(fenced, F.regexp_replace(F.regexp_replace(bare, r"^`+[^\n]*\n?", ""), "`+$", "")).otherwise(bare)
    items = _items(_variant(inner), ("urls", "items"))
    each = responses.select("resp_id", items.alias("items")).where(F.size("items") <= MAX_LINKS).select("resp_id", F.posexplode("items").alias("pos", "v"))
    return each.select("resp_id", "pos", F.trim(_text(F.col("v"), "$")).alias("url")).where("url != ''")


def response_text(responses: DataFrame) -> DataFrame:
    """(resp_id, text): output_text, else the texts of completed messages joined; null if the response is not usable."""
    v = _variant(F.col("payload"))
    has = lambda node, name: F.try_variant_get(node, f"$.{name}", "variant").isNotNull()
    outputs = F.try_variant_get(v, "$.output", "array<variant>")
    message = lambda o: F.coalesce(_text(o, "$.type") == "message", ~has(o, "type"))
    contents = lambda o: F.coalesce(F.try_variant_get(o, "$.content", "array<variant>"), F.array().cast("array<variant>"))
    usable = lambda c: _status_ok(c) & F.coalesce(_text(c, "$.type") == "output_text", ~has(c, "type")) & _text(c, "$.text").isNotNull()
    texts = F.transform(F.filter(F.flatten(F.transform(F.filter(outputs, message), contents)), usable), lambda c: _text(c, "$.text"))
    whole = F.forall(outputs, _status_ok)
    joined = F.when(F.size(outputs) == 0, F.lit("")).when(whole & (F.size(texts) > 0), F.array_join(texts, ""))
    return responses.select("resp_id", F.when(_status_ok(v), F.when(has(v, "output_text"), _text(v, "$.output_text")).otherwise(joined)).alias("text"))
