"""Evidence predicates: does a text affirm the claim about its own subject?"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.functions import rules as R
from catalogspark.functions import text as X
from catalogspark.operators import markup

QUOTE_CHARS = 500


def signs(c: Column) -> Column:
    """The text as signs of known words; other words stay in lower case, white space goes, the word `and` is a delimiter.

    Phrases of several words or with other marks are replaced one kind at a time; single words by a look into one map.
    """
    out = F.regexp_replace(F.coalesce(c, F.lit("")), rf"\(\s*{X.YEAR}\s*\)", " ")
    single: dict[str, str] = {"and": "&"}
    for kind in R.AS_WRITTEN:
        out = F.regexp_replace(out, R.phrase_pattern(R.LEXICON[kind], any_case=False), f" {R.SIGNS[kind]} ")
    out = F.lower(out)
    for kind, phrases in R.LEXICON.items():
        if kind not in R.AS_WRITTEN:
            single |= {w: R.SIGNS[kind] for w in phrases if w.isalnum()}
            if several := tuple(p for p in phrases if not p.isalnum()):
                out = F.regexp_replace(out, R.phrase_pattern(several), f" {R.SIGNS[kind]} ")
    words = F.split(F.regexp_replace(out, "([a-z0-9]+)", " $1 "), r"\s+")
    known = F.create_map(*[F.lit(x) for kv in single.items() for x in kv])
    return F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(known, w), w)), "")


def _beside(clause: Column) -> Column:
    """What a clause of signs says beside the two markers."""
    return F.trim(F.regexp_replace(clause, f"[{R.SIGNS['first']}{R.SIGNS['second']}]", ""), F.lit(R.EDGES))


def _accepted(clause: Column, rules: R.EvidenceRules) -> Column:
    rest = F.regexp_replace(_beside(clause), rules.settled, "")
    return F.rlike(rest, F.lit(rules.whole))


def _folded(parts: Column, marks: Column, accepted, rest) -> Column:
    """Clauses; one that cannot stand alone takes the next one in if the two together can."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(False).alias("skip"))
    indexed = F.transform(parts, lambda p, i: F.struct(i.alias("i"), p.alias("p")))

    def step(acc: Column, e: Column) -> Column:
        following = F.get(parts, e["i"] + 1)
        joined = F.concat(e["p"], F.get(marks, e["i"]), F.coalesce(following, F.lit("")))
        fold = following.isNotNull() & ~accepted(e["p"]) & accepted(joined) & (rest(joined) != "")
        return F.when(acc["skip"], F.struct(acc["out"].alias("out"), F.lit(False).alias("skip"))).otherwise(
            F.struct(F.array_append(acc["out"], F.when(fold, joined).otherwise(e["p"])).alias("out"), fold.alias("skip"))
        )

    return F.aggregate(indexed, start, step, lambda acc: acc["out"])


_CUT = f"[{R.DELIMITERS}]"
#: The same in a text as it is written.
CLAUSE_END = rf"(?i)(?<!dts):|(?<!dd)\+|[{R.DELIMITERS.replace(':', '').replace('+', '')}]|\band\b"


def _sign_clauses(t: Column, rules: R.EvidenceRules) -> Column:
    parts = F.split(t, _CUT, -1)
    marks = F.regexp_extract_all(t, F.lit(f"({_CUT})"), F.lit(1))
    return _folded(parts, F.concat(marks, F.array(F.lit(""))), lambda x: _accepted(x, rules), _beside)


def subject_clauses(c: Column, rules: R.EvidenceRules = R.DEFAULT) -> Column:
    """Clauses of a text between delimiters, as it is written. The marks in names of sound formats are none."""
    marks = F.concat(F.regexp_extract_all(c, F.lit(f"({CLAUSE_END})"), F.lit(1)), F.array(F.lit("")))
    return _folded(F.split(c, CLAUSE_END, -1), marks, lambda x: _accepted(signs(x), rules), lambda x: _beside(signs(x)))


def _correlated(t: Column, rules: R.EvidenceRules) -> Column:
    has = lambda x, kind: F.contains(x, F.lit(R.SIGNS[kind]))
    told = X.once(_sign_clauses(t, rules), lambda cs: F.forall(cs, lambda x: _accepted(x, rules)) & F.exists(cs, lambda x: has(x, "first") & has(x, "second")))
    return has(t, "first") & has(t, "second") & told


def _unnegated_rival(t: Column, rules: R.EvidenceRules) -> Column:
    return F.contains(F.regexp_replace(t, rules.rival_denied, ""), F.lit(R.SIGNS["rival"]))


def correlated(c: Column, rules: R.EvidenceRules = R.DEFAULT) -> Column:
    """Every clause is about the subject, and one holds both markers."""
    return X.once(signs(c), lambda t: _correlated(t, rules))


def denied(c: Column, rules: R.EvidenceRules = R.DEFAULT) -> Column:
    return F.rlike(signs(c), F.lit(rules.denied))


def unnegated_rival(c: Column, rules: R.EvidenceRules = R.DEFAULT) -> Column:
    """The rival marker stands somewhere without being denied there."""
    return _unnegated_rival(signs(c), rules)


def marked(c: Column) -> Column:
    """Both markers stand in the text: the cheap test in front of all others."""
    return F.rlike(c, F.lit(R.phrase_pattern(R.LEXICON["first"]))) & F.rlike(c, F.lit(R.phrase_pattern(R.LEXICON["second"])))


def excluded(c: Column) -> Column:
    return F.rlike(c, F.lit(R.phrase_pattern(R.LEXICON["excluded"])))


def direct(c: Column, title: Column, rules: R.EvidenceRules = R.DEFAULT) -> Column:
    """The text, its title masked, is correlated evidence that nothing excludes or denies."""
    masked = without_title(c, title)
    told = X.once(signs(masked), lambda t: _correlated(t, rules) & ~F.contains(t, F.lit(R.SIGNS["excluded"])) & ~_unnegated_rival(t, rules) & ~F.rlike(t, F.lit(rules.denied)))
    return marked(c) & F.when(marked(c), told).otherwise(False)


def without_title(c: Column, title: Column) -> Column:
    """Blank out the first mention of the title, in any case."""
    at = F.instr(F.lower(c), F.lower(title))
    return F.when((title != "") & (at > 0), F.overlay(c, F.rpad(F.lit(""), F.length(title), F.lit(" ")), at, F.length(title))).otherwise(c)


def is_device(c: Column) -> Column:
    """Names playback hardware: a brand, a model or a word for it."""
    brands = "|".join(re.escape(d).replace("\\ ", r"[\s-]*") for d in sorted(R.DEVICES, key=len, reverse=True))
    models = "|".join(re.escape(b).replace("\\ ", r"[\s-]*") + rf"[\s-]*[0-9]{{{low},{high}}}" for b, low, high in R.MODELS)
    out = F.rlike(c, F.lit(rf"(?i)(?<![A-Za-z0-9])(?:{brands}|{models})(?![A-Za-z0-9])"))
    for word in R.DEVICE_WORDS:
        out = out | F.contains(F.lower(c), F.lit(word))
    return out


def is_time_stamp(c: Column) -> Column:
    """Day, month, day of the month, year, and a time with am or pm, one after another."""

    def stamped(w: Column) -> Column:
        def here(i: Column) -> Column:
            at = lambda k: F.coalesce(F.get(w, i + k), F.lit(""))
            return at(0).isin(*R.DAYS) & at(1).isin(*R.MONTHS) & F.rlike(at(2), F.lit("^[0-9]{1,2}$")) & F.rlike(at(3), F.lit("^[0-9]{4}$")) & F.rlike(at(4), F.lit("^[0-9]{1,2}:[0-9]{2}$")) & at(5).isin("am", "pm")

        return F.exists(F.sequence(F.lit(0), F.size(w) - 1), here)

    return X.once(F.split(F.trim(F.lower(F.regexp_replace(c, ",", " "))), r"\s+"), stamped)


def looks_like_title(c: Column) -> Column:
    """A film's name rather than hardware, prose or a time stamp."""
    low = F.lower(c)
    first = F.regexp_extract(low, "^([a-z]+)", 1)
    out = F.rlike(c, F.lit("[A-Za-z0-9]")) & (F.length(c) <= 100) & ~is_device(c) & ~is_time_stamp(c) & ~first.isin(*R.DEICTIC)
    for word in R.BANNED_WORDS:
        out = out & ~F.contains(low, F.lit(word))
    return out & ~F.contains(low, F.lit("and/or"))


#: How far the markers may stand from the verb, and from each other.
FROM_VERB, APART = 120, 40
TITLE_CHARS = 81
#: The longest of the words in between that count themselves.
LONGEST = 15


# What a sentence may say before the title.
PLACES = ("spreadsheet", "list", "post", "thread", "forum", "page", "source", "site", "table", "note", "comment", "review")
SAYING = ("says", "lists", "shows", "mentions", "reports")
ENTRIES = ("list", "table", "source", "spreadsheet")
CARRIERS = ("disc", "release", "blu-ray", "bluray", "uhd", "4k", "movie", "film")
#: A place's words before it says something.
BEFORE_PLACE = 5


def subject_of(name: Column) -> Column:
    """The title in what stands before a sentence's verb: without `the disc for`; empty where it reports what some place says, which leaves the title open."""

    def judge(w: Column) -> Column:
        at = lambda i: F.coalesce(F.get(w, i if isinstance(i, Column) else F.lit(i)), F.lit(""))
        bare = lambda i: F.rtrim(at(i), F.lit(",:"))
        place = lambda i: bare(i).isin(*PLACES)
        comma = lambda i: F.endswith(at(i), F.lit(","))
        behind = lambda n: F.lit(n) + (at(n) == "the").cast("int")  # noqa: E731  past an article
        says = F.exists(F.sequence(F.lit(0), F.lit(BEFORE_PLACE)), lambda i: place(i) & bare(i + 1).isin(*SAYING) & (at(i + 2) != ""))
        by_place = F.when((at(0) == "according") & (at(1) == "to"), place(behind(2)) & comma(behind(2))).when(at(0) == "in", place(behind(1)) & comma(behind(1))).otherwise(F.lit(False))
        aside = (at(0) == "for") & F.exists(F.slice(w, 2, F.greatest(F.size(w) - 2, F.lit(0))), lambda x: F.endswith(x, F.lit(",")))
        entry = at(0).isin(*ENTRIES) & (at(1) == "entry:")
        first = (at(0) == "the").cast("int")
        carried = at(first).isin(*CARRIERS) & at(first + 1).isin("for", "of") & (at(first + 2) != "")
        plain = F.array_join(F.slice(F.split(name, r"\s+"), F.when(carried, first + 3).otherwise(1), F.size(w)), " ")
        return F.when(says | by_place | aside | entry, "").otherwise(F.trim(plain, F.lit(" :,-")))

    return X.once(F.split(F.lower(name), r"\s+"), judge)


def dated_title(c: Column) -> Column:
    """(title, year) of a text `Title (YYYY) marker .. marker`, with or without a comma or colon after the year."""
    form = r"(?s)^(.*?)\s+\(([0-9]{4})\)[\s,:]+(.*)$"

    def judge(x: Column) -> Column:
        at = lambda kind: F.regexp_instr(x["rest"], F.lit(R.phrase_pattern(R.LEXICON[kind])))
        p, f = at("first"), at("second")
        plain = F.rlike(x["head"], F.lit(rf"^[A-Za-z0-9][A-Za-z0-9:'&.,!?\- ]{{0,{TITLE_CHARS - 1}}}$"))
        good = plain & (p > 0) & (f > 0) & (F.least(p, f) == 1) & (F.abs(p - f) <= APART + LONGEST)
        return F.struct(F.when(good, x["head"]).otherwise("").alias("title"), F.when(good, x["year"]).otherwise("").alias("year"))

    return X.once(F.struct(F.trim(F.regexp_extract(c, form, 1)).alias("head"), F.regexp_extract(c, form, 2).alias("year"), F.regexp_extract(c, form, 3).alias("rest")), judge)


def sentence_title(c: Column) -> Column:
    """(title, year) of a sentence `Title (YYYY) is .. marker .. marker`; an empty title if it is none.

    The title is what stands before the first binding word that leaves one.
    """
    verb = r"(?i)\s(?:" + "|".join(r"\s+".join(w.split()) for w in sorted(R.BINDING, key=len, reverse=True)) + r")(?![A-Za-z])"
    dated = r"^(.*?)\s+\(([0-9]{4})\)$"

    def read(at: Column) -> Column:
        head, rest = F.trim(F.substr(c, F.lit(1), at - 1)), F.substr(c, at + 1)
        return X.once(F.struct(at.alias("at"), head.alias("head"), F.regexp_instr(rest, F.lit(R.phrase_pattern(R.LEXICON["first"]))).alias("p"), F.regexp_instr(rest, F.lit(R.phrase_pattern(R.LEXICON["second"]))).alias("f")), judge)

    def judge(x: Column) -> Column:
        name = F.when(F.rlike(x["head"], F.lit(dated)), F.regexp_extract(x["head"], dated, 1)).otherwise(x["head"])
        near = (x["p"] > 0) & (x["f"] > 0) & (F.least(x["p"], x["f"]) <= FROM_VERB + LONGEST) & (F.abs(x["p"] - x["f"]) <= APART + LONGEST)
        plain = F.rlike(name, F.lit(rf"^[A-Za-z][A-Za-z0-9:'&.,!?\- ]{{1,{TITLE_CHARS - 1}}}$"))
        good = (x["at"] > 0) & near & plain
        return F.struct(F.when(good, name).otherwise("").alias("title"), F.when(good, F.regexp_extract(x["head"], dated, 2)).otherwise("").alias("year"))

    return X.once(F.regexp_instr(c, F.lit(verb)), read)


def sentence_evidence(records: DataFrame, rules: R.EvidenceRules = R.DEFAULT) -> DataFrame:
    """Candidates from (.., text): sentences `Title is .. marker .. marker` or `Title (YYYY): marker .. marker`. The cheap marker test comes first."""
    s = markup.sentences(records).where(marked(F.col("sentence")))
    titled = lambda v: F.when(v["title"] != "", v).otherwise(dated_title(F.col("sentence")))
    s = X.held(s, "_t", X.once(sentence_title(F.col("sentence")), titled))
    # The whole span before the verb is the subject, and is masked as such; the title is what is left of it.
    s = X.held(s, "title", subject_of(F.col("_t.title"))).withColumns({"_span": F.col("_t.title"), "year": F.col("_t.year")}).drop("_t")
    good = s.where((F.col("title") != "") & looks_like_title(F.col("title")) & direct(F.col("sentence"), F.col("_span"), rules)).drop("_span")
    return good.withColumns({"year": F.when(F.col("year") == "", X.UNKNOWN).otherwise(F.col("year")), "quote": F.substring("sentence", 1, QUOTE_CHARS), "evidence_type": F.lit("sentence")}).drop("sentence")


#: A list item: title, year in brackets, and somewhere behind it the marker with a rate.
LIST_ITEM = r"^\s*(.+?)\s+\(([0-9]{4})\)(.*)$"
LIST_ITEM_BITRATE = R.phrase_pattern(R.LEXICON["second"]) + r"\s*-\s*([0-9]+(?:\.[0-9]+)?)\s*Mb/s"


def list_item_evidence(items: DataFrame) -> DataFrame:
    """Candidates from list items `Title (YYYY) .. FEL - N Mb/s`."""
    good = items.where(F.rlike("text", F.lit(LIST_ITEM))).withColumn("rest", F.regexp_extract("text", LIST_ITEM, 3)).where(F.rlike("rest", F.lit(LIST_ITEM_BITRATE)))
    out = good.withColumns({"title": F.trim(F.regexp_extract("text", LIST_ITEM, 1)), "year": F.regexp_extract("text", LIST_ITEM, 2), "bitrate": F.regexp_extract("rest", LIST_ITEM_BITRATE, 1).cast("double"), "quote": F.substring("text", 1, QUOTE_CHARS), "evidence_type": F.lit("list-item")})
    return out.where(F.rlike("title", F.lit("[A-Za-z0-9]")) & (F.length("title") <= 100) & ~is_device(F.col("title"))).drop("rest", "text")


# Header words of evidence tables.
TITLE_WORDS = ("title", "movie", "film")
STATUS_WORDS = ("dv", "dolby", "vision", "profile", "hdr", "fel", "video", "format", "status", "disc", "layer")
NOTE_WORDS = ("note", "notes", "evidence", "comment", "comments", "source", "proof")
OTHER_WORDS = (
    "group", "release group", "team", "encoder", "uploader", "audio", "sound", "language", "region", "country", "studio", "label", "year", "date",
    "note", "notes", "evidence", "source", "proof", "dv", "dolby", "vision", "profile", "hdr", "video", "format", "status", "disc", "layer",
)
TITLE_HEADER, STATUS_HEADER, NOTE_HEADER, OTHER_HEADER = (R.phrase_pattern(w) for w in (TITLE_WORDS, STATUS_WORDS, NOTE_WORDS, OTHER_WORDS))



def table_evidence(rows: DataFrame, rules: R.EvidenceRules = R.DEFAULT) -> DataFrame:
    """Candidates from table rows (.., cells, headers): a cell under a status header, or none, affirms the row's title, or one under a notes header that names it.

    The title stands under a title header, else under the first header that is
    none of the known others, else in the first cell. A cell that names the title
    with another year speaks against the row.
    """
    first = lambda pattern, wanted: F.array_position(F.transform("headers", lambda h: F.rlike(h, F.lit(pattern)) == F.lit(wanted)), True)
    index = F.when(F.col("headers").isNull(), 1).when(first(TITLE_HEADER, True) > 0, first(TITLE_HEADER, True)).when(first(OTHER_HEADER, False) > 0, first(OTHER_HEADER, False)).otherwise(1)
    keys = [c for c in rows.columns if c not in ("cells", "headers")]
    dated = rf"^(.+?)\s*\(({X.YEAR})\)$"
    split = lambda cell: F.struct(cell.alias("cell"), F.when(F.rlike(cell, F.lit(dated)), F.regexp_extract(cell, dated, 1)).otherwise(cell).alias("title"), F.when(F.rlike(cell, F.lit(dated)), F.regexp_extract(cell, dated, 2)).otherwise(F.lit(X.UNKNOWN)).alias("year"))
    r = X.held(rows, "ti", index.cast("int"))
    r = X.held(r, "_s", X.once(F.coalesce(F.get("cells", F.col("ti") - 1), F.lit("")), split))
    r = r.withColumns({c: F.col("_s")[c] for c in ("cell", "title", "year")}).drop("_s")
    r = r.where((F.col("title") != "") & looks_like_title(F.col("title")))
    placed = F.transform("cells", lambda c, i: F.struct(c.alias("c"), i.alias("i"), F.coalesce(F.get("headers", i), F.lit("status")).alias("h")))
    others = F.filter(placed, lambda p: p["i"] != F.col("ti") - 1)
    # A note may speak of any title, so it has to name this one.
    bound = lambda p: F.rlike(p["h"], F.lit(STATUS_HEADER)) | (F.rlike(p["h"], F.lit(NOTE_HEADER)) & F.contains(F.lower(p["c"]), F.lower("title")))
    r = r.where(marked(F.array_join("cells", " | ")))
    supports = F.exists(others, lambda p: bound(p) & direct(p["c"], F.col("title"), rules)) | direct(F.col("cell"), F.col("title"), rules)
    rival = F.exists(others, lambda p: F.contains(F.lower(p["c"]), F.lower("title")) & (X.year_of(p["c"]) != "") & (F.col("year") != X.UNKNOWN) & (X.year_of(p["c"]) != F.col("year")))
    good = r.where(supports & ~rival)
    return good.select(*keys, "title", "year", F.substring(F.array_join("cells", " "), 1, QUOTE_CHARS).alias("quote"), F.lit("table-row").alias("evidence_type"))


#: A year directly behind a title, in brackets or bare.
BEHIND = rf"^\s*(?:\(\s*({X.YEAR})\s*\)|({X.YEAR})(?![0-9]))"
#: A title that is itself a year, with its year in brackets behind it.
YEAR_TITLE = rf"(?<![\p{{L}}\p{{N}}_]){X.YEAR}(?=\s*\(\s*{X.YEAR}\s*\))"


def _whole(title: Column) -> Column:
    """A pattern of the title as whole words, in any case."""
    return F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}_])\Q"), F.replace(title, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?![\p{L}\p{N}_])"))


def _is_year(c: Column) -> Column:
    return F.rlike(c, F.lit(f"^{X.YEAR}$"))


def _blanked(c: Column, spans: Column) -> Column:
    """The text with spans (begin, size; from 0) made blank."""
    return F.aggregate(spans, c, lambda acc, x: F.overlay(acc, F.rpad(F.lit(""), x["size"], F.lit(" ")), x["begin"] + 1, x["size"]))


def mentions(c: Column, title: Column, year: Column) -> Column:
    """Where a text names a title: (begin, size, year, fits, told, led), in order.

    `size` takes in a year directly behind the name that does not contradict the
    candidate's; `year` is that year and `fits` says that there is one. `told`:
    the rest of the name's clause holds both markers. `led`: the name begins a
    clause that goes on.
    """
    names = F.regexp_extract_all(c, _whole(title), F.lit(0))
    gaps = F.zip_with(F.slice(F.split(c, _whole(title), -1), F.lit(1), F.size(names)), names, lambda g, n: F.struct(F.length(g).alias("gap"), F.length(n).alias("size")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,size:int>>").alias("out"))
    step = lambda acc, x: F.struct((acc["at"] + x["gap"] + x["size"]).alias("at"), F.array_append(acc["out"], F.struct((acc["at"] + x["gap"]).alias("begin"), x["size"].alias("size"))).alias("out"))
    placed = F.aggregate(gaps, start, step, lambda acc: acc["out"])

    def read(m: Column) -> Column:
        head, tail = F.substr(c, F.lit(1), m["begin"]), F.substr(c, m["begin"] + m["size"] + 1)
        found = F.coalesce(F.nullif(F.regexp_extract(tail, BEHIND, 1), F.lit("")), F.regexp_extract(tail, BEHIND, 2))
        fits = (found != "") & (~_is_year(year) | (found == year))
        rest = F.get(F.split(tail, CLAUSE_END, 2), F.lit(0))
        goes_on = F.rlike(F.regexp_replace(rest, rf"^\s*\(\s*{X.YEAR}\s*\)", ""), F.lit(r"[\p{L}\p{N}]"))
        led = F.rlike(head, F.lit(rf"(?:{CLAUSE_END})\s*$|^\s*$")) & goes_on
        return F.struct(m["begin"].alias("begin"), (m["size"] + F.when(fits, F.length(F.regexp_extract(tail, BEHIND, 0))).otherwise(0)).alias("size"), F.when(fits, found).otherwise("").alias("year"), fits.alias("fits"), marked(rest).alias("told"), led.alias("led"))

    return F.when(title == "", F.array()).otherwise(F.transform(placed, read))


def bound(c: Column, title: Column, year: Column) -> Column:
    """(text, subject, year, named): the text without the mention that the claim is about, and that mention's year.

    The claim is about the first mention with a year that fits the candidate's,
    else the first whose clause holds both markers, else the first of all.
    `subject` also lacks the name where it opens another clause that goes on.
    """

    def judge(ms: Column) -> Column:
        first = lambda field: F.get(F.filter(ms, lambda m: m[field]), F.lit(0))
        return X.once(F.coalesce(first("fits"), first("told"), F.get(ms, F.lit(0))), lambda m: out(ms, m))

    def out(ms: Column, m: Column) -> Column:
        text = F.when(m.isNull(), c).otherwise(_blanked(c, F.array(m)))
        others = F.filter(ms, lambda x: x["led"] & (x["begin"] != m["begin"]))
        return F.struct(text.alias("text"), _blanked(text, others).alias("subject"), F.coalesce(m["year"], F.lit("")).alias("year"), m.isNotNull().alias("named"))

    return X.once(mentions(c, title, year), judge)


def years_told(c: Column, title: Column) -> Column:
    """The years a text speaks of: neither names that are years, nor the title where it is one."""
    plain = F.regexp_replace(c, YEAR_TITLE, " ")
    plain = F.when(_is_year(title), F.regexp_replace(plain, _whole(title), F.lit(" "))).otherwise(plain)
    return F.array_distinct(F.regexp_extract_all(plain, F.lit(rf"\b({X.YEAR})\b"), F.lit(1)))


def ground(candidates: DataFrame, pages: DataFrame, rules: R.EvidenceRules = R.DEFAULT) -> DataFrame:
    """Candidates (seq, title, year, source_url, evidence) with `reason`: null if the page bears them out, else the first failed check.

    The year must be the one year that the evidence speaks of. A candidate without
    one takes the year directly behind its title, and is turned away if the
    evidence has another year only. Every clause beside the title must be about
    it. pages holds (url, text). The record units of a page stay one array of that
    page. Null titles, years and evidence count as empty. The reason is computed once
    a row, whatever filters follow.
    """
    p = pages.select(F.col("url").alias("source_url"), "text")
    units = markup.source_records(p.select(F.col("source_url").alias("doc_id"), "text")).groupBy(F.col("doc_id").alias("source_url")).agg(F.collect_list("record").alias("records"))
    plain = p.select("source_url", F.lower(markup.plain(F.col("text"))).alias("page"))
    c = candidates.join(plain, "source_url", "left").join(units, "source_url", "left")
    blank = lambda name: F.coalesce(F.col(name), F.lit(""))
    c = c.withColumns({"_quote": X.collapse_ws(blank("evidence")), "_title": X.collapse_ws(blank("title"))})
    c = c.withColumn("_b", bound(F.col("_quote"), F.col("_title"), blank("year")))
    c = c.withColumn("_years", F.array_distinct(F.concat(F.when(F.col("_b.year") != "", F.array("_b.year")).otherwise(F.array().cast("array<string>")), years_told(F.col("_b.text"), F.col("_title")))))
    quote, text, years = F.lower("_quote"), F.col("_b.text"), F.col("_years")
    dated = _is_year(blank("year"))
    reason = (
        F.when(is_device(F.col("_title")), "device-title")
        .when((quote == "") | (F.col("_title") == "") | ~F.coalesce(F.contains("page", quote), F.lit(False)), "evidence-not-found")
        .when(~F.coalesce(F.exists("records", lambda r: F.contains(F.lower(r), quote)), F.lit(False)), "cross-release-evidence")
        .when(~F.col("_b.named"), "title-not-bound")
        .when(excluded(text) | unnegated_rival(text, rules), "excluded-format")
        .when(denied(text, rules), "negated-fel")
        .when(~marked(text), "missing-affirmative-fel")
        .when(F.size(years) > 1, "ambiguous-year")
        .when(~correlated(F.col("_b.subject"), rules), "cross-release-evidence")
        .when(F.when(dated, ~F.array_contains(years, F.col("year"))).otherwise((F.col("_b.year") == "") & (F.size(years) > 0)), "year-not-in-evidence")
    )
    year = F.when(dated, F.col("year")).otherwise(F.coalesce(F.nullif(F.col("_b.year"), F.lit("")), F.lit(X.UNKNOWN)))
    c = X.held(c, "reason", reason).withColumn("year", F.when(F.col("reason").isNull(), year).otherwise(F.col("year")))
    return c.select(*candidates.columns, "reason")


def rejection_counts(grounded: DataFrame) -> DataFrame:
    return grounded.where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
