"""Reconciliation in rounds against one candidate after another in plain Python, and its number of rounds."""

import random

import pytest

from catalogspark.operators import components, reconcile
from tests.test_reconcile import frame


def key(title):
    return "".join(c for c in title.lower() if c.isalnum() or c == " ").strip()


def decide(c, rows):
    """match_decision of one dated candidate, written out; titles here name no seasons."""
    shares = {"url": lambda r: c["bluray_url"] and c["bluray_url"] == r["bluray_url"], "work": lambda r: c["tmdb_id"] and (c["tmdb_id"], c["media_type"]) == (r["tmdb_id"], r["media_type"]), "other": lambda r: c["imdb_id"] and c["imdb_id"] == r["imdb_id"]}
    sets = [s for s in ([r for r in rows if f(r)] for f in shares.values()) if s]

    def ok(r):
        if c["tmdb_id"] and c["tmdb_id"] == r["tmdb_id"] and c["media_type"] != r["media_type"]:
            return False
        return all(not c[f] or not r[f] or c[f] == r[f] for f in ("tmdb_id", "imdb_id"))

    same_title = lambda r: key(r["movie_title"]) == key(c["movie_title"]) and r["year"] == c["year"]

    def apart(r):
        if not (c["bluray_url"] and r["bluray_url"] and c["bluray_url"] != r["bluray_url"]):
            return False
        shared = shares["work"](r) or shares["other"](r)
        bare = not any(x[f] for x in (c, r) for f in ("tmdb_id", "imdb_id"))
        return not (same_title(r) and (shared or bare))

    def to(found):
        if not all(ok(r) for r in found):
            return "identity-conflict"
        return None if any(apart(r) for r in found) else found[0]

    if sets:
        ids = [{r["seq"] for r in s} for s in sets]
        links = sum(bool(a & b) for i, a in enumerate(ids) for b in ids[i + 1 :])
        if len(sets) > 1 and links < len(sets) - 1:
            return "identity-conflict"
        by_url = [r for r in rows if shares["url"](r)]
        if len(by_url) == 1:
            return to(by_url)
        common = set.intersection(*ids)
        live = [r for r in rows if r["seq"] in (common or set().union(*ids)) and ok(r)]
        if not live:
            return "identity-conflict"
        if len(live) == 1:
            return to(live)
        narrow = [r for r in live if same_title(r)]
        return to(narrow) if len(narrow) == 1 else "ambiguous-edition"
    titled = [r for r in rows if same_title(r)]
    if not titled:
        return None
    if not all(ok(r) for r in titled):
        return "identity-conflict"
    return to(titled) if len(titled) == 1 else "ambiguous-edition"


def one_by_one(old, new):
    rows = [dict(r, sources=[r["seq"]], added=False) for r in old]
    decisions = {}
    for c in sorted(new, key=lambda r: r["seq"]):
        d = decide(c, rows)
        if isinstance(d, str):
            decisions[c["seq"]] = ("review", None, d)
        elif d is None:
            rows.append(dict(c, sources=[c["seq"]], added=True))
            decisions[c["seq"]] = ("append", None, None)
        else:
            decisions[c["seq"]] = ("merge", d["seq"], None)
            d["sources"].append(c["seq"])
            if not d["tmdb_id"] and c["tmdb_id"]:
                d["tmdb_id"], d["media_type"] = c["tmdb_id"], c["media_type"]
            for f in ("imdb_id", "bluray_url"):
                d[f] = d[f] or c[f]
            if len(c["release_date"]) == 10 and len(d["release_date"]) != 10:
                d["release_date"], d["year"] = c["release_date"], c["year"]
    return rows, decisions


def rows_of(r, n, start):
    out = []
    for i in range(n):
        year = str(r.choice([2000, 2001]))
        out.append(
            dict(seq=start + i, movie_title=f"{r.choice(['Red', 'Blue', 'Green'])} Film", year=year, release_date=year + r.choice(["", "-05-06"]), tmdb_id=r.choice(["", "", "1", "2"]), media_type=r.choice(["movie", "movie", "tv"]),
                 imdb_id=r.choice(["", "", "tt1", "tt2"]), bluray_url=r.choice(["", "", "https://d.example/1", "https://d.example/2", "https://d.example/3"]), quote=str(i))
        )
    return out


@pytest.mark.parametrize("seed", range(1))
def test_rounds_give_what_one_by_one_gives(spark, seed, monkeypatch):
    """Dense blocks: three titles, two years, few ids and pages. Works are not folded at the end, so the rows can be compared."""
    r = random.Random(seed)
    old, new = rows_of(r, 3, 0), rows_of(r, 14, 100)
    monkeypatch.setattr(reconcile, "finalized", lambda catalog: catalog)
    strip = lambda rows: [{k: v for k, v in x.items() if k != "year"} for x in rows]
    rounds = []
    catalog, decisions = reconcile.reconcile(frame(spark, strip(old)), frame(spark, strip(new)), rounds)
    want, verdicts = one_by_one(old, new)
    assert {d.cand: (d.action, d.target, d.reason) for d in decisions.collect()} == verdicts
    facts = lambda x: (x["seq"], x["release_date"], x["tmdb_id"], x["imdb_id"], x["bluray_url"], x["sources"])
    assert sorted((*facts(x), x["is_addition"]) for x in catalog.collect()) == sorted((*facts(x), x["added"]) for x in want)
    assert sum(rounds) == 14 and len(rounds) < 14


def test_ten_thousand_of_one_title(spark):
    """The first is a row, all others merge into it at once, and its sources are all of them."""
    rows = spark.range(10_000).selectExpr("id as seq", "'One Title' as movie_title", "'2001' as release_date", "'Unknown' as studio", "'' as tmdb_id", "'movie' as media_type", "'' as imdb_id", "'' as bluray_url", "'table-row' as evidence_type", "'q' as quote")
    rounds = []
    catalog, _ = reconcile.reconcile(rows.limit(0), rows, rounds)
    found = catalog.collect()
    assert rounds == [1, 9_999]
    assert len(found) == 1 and found[0].is_addition and found[0].sources == list(range(10_000))


def test_sources_of_folded_works(spark):
    """Rows of one proven work become one row, with the sources of all; an old one among them ends its being an addition."""
    same = dict(release_date="2001", tmdb_id="5", imdb_id="tt5", quote="One Way AKA Other Way")
    old = [dict(seq=1, movie_title="One Way", **same)]
    new = [dict(seq=10, movie_title="One Way", release_date="2001"), dict(seq=11, movie_title="Other Way", bluray_url="https://d.example/9", **same), dict(seq=12, movie_title="Lone", release_date="1999")]
    catalog, _ = reconcile.reconcile(frame(spark, old), frame(spark, new))
    assert sorted((r.sources, r.is_addition) for r in catalog.collect()) == [([1, 10, 11], False), ([12], True)]


def test_chain_of_keys(spark):
    """A chain of 3,000 rows, each sharing a key with the next, in a few rounds."""
    links = spark.range(3_000).selectExpr("(id * 7919) % 3000 as id", "id as place").selectExpr("id", "explode(array(place, place + 1)) as key")
    found = components.connected(links)
    assert found.count() == 3_000 and {r.label for r in found.select("label").distinct().collect()} == {0}
