"""Column functions on URLs: identity keys, canonical forms and safety checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hosts whose threads have their own identity, and what counts as local.
DISCUSSION_HOSTS = ("reddit.com", "www.reddit.com", "old.reddit.com")
FORUM_HOSTS = ("avsforum.com", "www.avsforum.com")
TOPIC_HOST = "forum.makemkv.com"
SHEET_HOST = "docs.google.com"
MAX_URL = 2048

_SPLIT = r"^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def part(c: Column, index: int) -> Column:
    """1 scheme, 2 authority, 3 path, 4 query, 5 fragment of a trimmed URL; empty if absent."""
    return F.coalesce(F.regexp_extract(F.trim(c), _SPLIT, index), F.lit(""))


def host(c: Column) -> Column:
    """Lower-case host without user info and port."""
    return F.lower(F.regexp_extract(part(c, 2), r"^(?:.*@)?(\[[^\]]*\]|[^:]*)(?::\d*)?$", 1))


def port(c: Column) -> Column:
    return F.regexp_extract(part(c, 2), r"^(?:.*@)?(?:\[[^\]]*\]|[^:]*):(\d+)$", 1).try_cast("int")


def _no_slash(path: Column) -> Column:
    return F.regexp_replace(path, "/+$", "")


def url_key(c: Column) -> Column:
    """https, lower host and path: what identifies a page, whatever its query, fragment and port. Empty if not http(s)."""
    web = F.lower(part(c, 1)).isin("http", "https") & (host(c) != "")
    return F.when(web, F.concat(F.lit("https://"), host(c), _no_slash(part(c, 3)))).otherwise(F.lit(""))


def _sorted_query(c: Column, names: tuple[str, ...] = ()) -> Column:
    pairs = F.filter(F.split(part(c, 4), "&"), lambda p: p != "")
    if names:
        pairs = F.filter(pairs, lambda p: F.substring_index(p, "=", 1).isin(*names))
    pairs = F.transform(pairs, lambda p: F.when(F.contains(p, F.lit("=")), p).otherwise(F.concat(p, F.lit("="))))
    return F.array_join(F.array_sort(pairs), "&")


def source_key(c: Column) -> Column:
    """Identity of a source: threads by number, else scheme, host, port, path and sorted query."""
    scheme = F.when(part(c, 1) == "", F.lit("https")).otherwise(F.lower(part(c, 1)))
    h, path = host(c), _no_slash(part(c, 3))
    thread = F.lower(F.regexp_extract(path, r"/comments/+([^/]+)", 1))
    topic = F.regexp_extract(part(c, 3), r"^/threads/[^/]*\.(\d+)/?$", 1)
    standard = F.when(scheme == "https", F.lit(443)).otherwise(F.lit(80))
    forum = h.isin(*FORUM_HOSTS)
    name = F.when(forum, F.lit("avsforum.com")).otherwise(h)
    place = F.when(F.coalesce(port(c), F.lit(0)).isin(0) | (port(c) == standard), name).otherwise(F.concat(name, F.lit(":"), port(c).cast("string")))
    query = F.when((h == TOPIC_HOST) & F.endswith(path, F.lit("/viewtopic.php")), _sorted_query(c, ("p", "start", "t"))).otherwise(_sorted_query(c))
    gid = F.regexp_extract(part(c, 5), r"^gid=0*(\d+)$", 1)
    sheet = ((h == SHEET_HOST) | F.endswith(h, F.lit("." + SHEET_HOST))) & F.startswith(path, F.lit("/spreadsheets/")) & (gid != "")
    plain = F.concat(scheme, F.lit("://"), place, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")), F.when(sheet, F.concat(F.lit("#gid="), gid)).otherwise(F.lit("")))
    return (
        F.when(h.isin(*DISCUSSION_HOSTS) & (thread != ""), F.concat(F.lit("reddit:"), thread))
        .when(h.isin(*DISCUSSION_HOSTS), F.concat(scheme, F.lit("://reddit.com"), path))
        .when(forum & (topic != ""), F.concat(F.lit("avsforum:"), topic))
        .otherwise(plain)
    )


def search_url(c: Column) -> Column:
    """A found link with lower scheme and host and no closing slash or fragment; null if it is no web page."""
    scheme, path = F.lower(part(c, 1)), part(c, 3)
    short = F.when(path == "/", path).otherwise(_no_slash(path))
    query = F.when(part(c, 4) != "", F.concat(F.lit("?"), part(c, 4))).otherwise(F.lit(""))
    return F.when(scheme.isin("http", "https") & (part(c, 2) != ""), F.concat(scheme, F.lit("://"), F.lower(part(c, 2)), F.when(short == "", F.lit("/")).otherwise(short), query))


def reject_reason(c: Column) -> Column:
    """Why a URL may not be fetched: the first check it fails, or null."""
    h = host(c)
    octets = F.transform(F.split(h, r"\."), lambda x: x.try_cast("int"))
    ip = F.rlike(h, F.lit(r"^\d{1,3}(?:\.\d{1,3}){3}$"))
    a, b = F.try_element_at(octets, F.lit(1)), F.try_element_at(octets, F.lit(2))
    private = ip & ((a.isin(0, 10, 127)) | (a >= 224) | ((a == 169) & (b == 254)) | ((a == 172) & b.between(16, 31)) | ((a == 192) & (b == 168)) | ((a == 100) & b.between(64, 127)))
    labels = F.rlike(h, F.lit(r"^(?=.{1,253}$)(?:[a-z0-9](?:[a-z0-9\-]{0,61}[a-z0-9])?\.)+[a-z0-9](?:[a-z0-9\-]{0,61}[a-z0-9])?\.?$"))
    return (
        F.when(F.length(c) > MAX_URL, F.lit("too-long"))
        .when(F.rlike(c, F.lit(r"%(?![0-9a-fA-F]{2})")), F.lit("bad-escape"))
        .when(F.rlike(c, F.lit(r"[\s\x00-\x1f\x7f\\]")), F.lit("bad-character"))
        .when(~F.lower(part(c, 1)).isin("http", "https"), F.lit("bad-scheme"))
        .when(F.contains(part(c, 2), F.lit("@")), F.lit("user-info"))
        .when(h == "", F.lit("no-host"))
        .when((h == "localhost") | F.endswith(h, F.lit(".localhost")), F.lit("local-host"))
        .when(F.coalesce(port(c), F.lit(1)) == 0, F.lit("bad-port"))
        .when(private, F.lit("private-address"))
        .when(~labels, F.lit("bad-host"))
    )


def safe_url(c: Column) -> Column:
    """Canonical form of an acceptable URL, else null: lower scheme and host, no default port and no fragment."""
    scheme = F.lower(part(c, 1))
    standard = F.when(scheme == "https", F.lit(443)).otherwise(F.lit(80))
    shown = F.when(port(c).isNull() | (port(c) == standard), F.lit("")).otherwise(F.concat(F.lit(":"), port(c).cast("string")))
    path = F.when(part(c, 3) == "", F.lit("/")).otherwise(part(c, 3))
    query = F.when(part(c, 4) != "", F.concat(F.lit("?"), part(c, 4))).otherwise(F.lit(""))
    return F.when(reject_reason(c).isNull(), F.concat(scheme, F.lit("://"), F.regexp_replace(host(c), r"\.$", ""), shown, path, query))


def sheet_export(c: Column) -> Column:
    """A sheet's CSV export: the tab number from the query, else from the fragment, else 0. Null if it is no sheet."""
    sheet = F.regexp_extract(part(c, 3), r"(?:^|/)d/+([^/]+)", 1)
    gid = F.coalesce(*[F.nullif(F.regexp_extract(part(c, i), r"(?:^|&)gid=([^&]+)", 1), F.lit("")) for i in (4, 5)], F.lit("0"))
    return F.when(sheet != "", F.concat(F.lit("https://docs.google.com/spreadsheets/d/"), sheet, F.lit("/gviz/tq?tqx=out:csv&gid="), gid))
