"""Work that grows with the rows, not with their pairs: rows that joins and stored tables hold where many rows share a key."""

from pyspark.sql import functions as F

from catalogspark.operators import lookup, match, reconcile


def joined_rows(df):
    """The most rows that a join of the executed plan put out, and the number of result rows."""
    query = df._jdf.queryExecution()
    rows = query.executedPlan().executeCollect()
    most, todo = 0, [query.executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        metric = node.metrics().get("numOutputRows")
        if "Join" in kind and metric.isDefined():
            most = max(most, metric.get().value())
        todo.extend(node.children().apply(i) for i in range(node.children().size()))
    return most, len(rows)


def test_product_match_meets_two_pages_a_row(spark):
    n = 400
    wanted = spark.range(n).select(F.col("id").alias("seq"), F.lit(0).alias("attempt_no"), F.lit("Red Rain").alias("title"), (F.col("id") % 5).cast("int").alias("wyear"))
    discs = spark.range(n).select(F.col("id").alias("pos"), F.concat(F.lit("http://d.example/movies/red-rain/"), "id").alias("url"), (F.col("id") % 5).cast("int").alias("dyear"))
    most, rows = joined_rows(lookup.product_match(wanted, discs))
    assert rows == n and most <= n


def test_product_match_years_may_be_missing(spark):
    wanted = spark.createDataFrame([(1, 0, "A B", None), (2, 0, "A B", 2001), (3, 0, "A B", 1990), (4, 0, "C", 1990), (5, 0, "C", 1980), (5, 1, "A B", 1980)], "seq long, attempt_no int, title string, wyear int")
    discs = spark.createDataFrame([(0, "http://d/a-b/1", 2005), (1, "http://d/a-b/2", 2000), (2, "http://d/a-b/3", None), (3, "http://d/c/4", 1991)], "pos long, url string, dyear int")
    got = {r.seq: r.url[-3:] for r in lookup.product_match(wanted, discs).collect()}
    assert got == {1: "b/1", 2: "b/2", 3: "b/3", 4: "c/4", 5: "b/3"}


def release_rows(spark, first, n, **columns):
    """n rows (seq from `first`) of a film, all alike but for their numbers."""
    base = {"movie_title": "Red Rain", "release_date": "2001", "studio": "s", "tmdb_id": "7", "media_type": "movie", "imdb_id": "", "bluray_url": "", "evidence_type": "table-row", "quote": "q"}
    return spark.range(first, first + n).select(F.col("id").alias("seq"), *[F.lit(v).alias(k) for k, v in {**base, **columns}.items()])


def stored_sizes(monkeypatch, module):
    """The row counts of all tables that a module stores from now on."""
    sizes = []
    for name in ("stored", "settle"):
        if hasattr(module, name):
            plain = getattr(module, name)

            def counted(df, plain=plain):
                out = plain(df)
                sizes.append(out.count())
                return out

            monkeypatch.setattr(module, name, counted)
    return sizes


def test_match_decision_pairs_classes_not_rows(spark, monkeypatch):
    n = 150
    sizes = stored_sizes(monkeypatch, match)
    cands = release_rows(spark, 0, n).unionByName(release_rows(spark, 1000, n, release_date="Unknown", tmdb_id="")).unionByName(release_rows(spark, 2000, n, movie_title="Other", tmdb_id="8"))
    rows = release_rows(spark, 5000, n).unionByName(release_rows(spark, 6000, 1, movie_title="Other", tmdb_id="9"))
    got = match.match_decision(cands, rows).groupBy("action", "reason").agg(F.count(F.lit(1)).alias("n"), F.max(F.size(F.split("implicated", "; "))).alias("titles")).collect()
    assert {(r.action, r.reason): (r.n, r.titles) for r in got} == {("review", "ambiguous-edition"): (n, n), ("review", "ambiguous-yearless-title"): (n, n), ("review", "identity-conflict"): (n, 1)}
    assert max(sizes) <= 3 * n


def test_reconcile_stores_a_review_text_once(spark, monkeypatch):
    n, texts = 40, []
    for module in (match, reconcile):
        for name in ("stored", "settle"):
            if hasattr(module, name):
                plain = getattr(module, name)
                monkeypatch.setattr(module, name, lambda df, plain=plain: (texts.append(df.where("implicated != ''").count()) if "implicated" in df.columns else None, plain(df))[1])
    old = release_rows(spark, 0, n, tmdb_id="")
    _, decisions = reconcile.reconcile(old, release_rows(spark, 1000, n, release_date="Unknown", tmdb_id=""))
    got = decisions.select("reason", F.size(F.split("implicated", "; ")).alias("titles")).collect()
    assert [(r.reason, r.titles) for r in got] == [("ambiguous-yearless-title", n)] * n
    assert texts and max(texts) == 1


def test_signal_matches_hold_no_pairs(spark):
    n = 60
    rows = lambda first: release_rows(spark, first, n, imdb_id="tt1")
    df = match.signal_matches(rows(0), rows(1000))
    assert df.groupBy("mask").count().collect() == [(6, n * n)]
    assert "Aggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_yearless_pairs_of_one_title_are_dealt_out(spark):
    n = 128
    df = match.yearless_matches(release_rows(spark, 0, n, release_date="Unknown"), release_rows(spark, 1000, n))
    assert df.count() == n * n and df.agg(F.min("n"), F.max("n")).first() == (n, n)
    assert "share" in df._jdf.queryExecution().optimizedPlan().toString()


def test_lookup_joins_kinds_of_works_not_works(spark, monkeypatch):
    n = 300
    sizes = stored_sizes(monkeypatch, lookup)
    works = spark.range(n).selectExpr("id AS tmdb_id", "'red rain' AS title", "'red rain of may' AS original_title", "'2001-01-01' AS release_date", "CAST(id % 50 AS INT) AS vote_count", "CAST(id % 7 AS DOUBLE) AS popularity", "'/p.jpg' AS poster_path")
    asked = spark.createDataFrame([(1, "Red Rain", "2001"), (2, "Red May", "2001"), (3, "Red Rain", "1990")], "seq long, title string, year string")
    got = {r.seq: (r.tmdb_id, r.score) for r in lookup.scored_lookup(asked, works).collect()}
    # Points of votes first where the base earns them (44 to 49 votes give as many), then popularity, then the first id.
    assert got == {1: (48, 185), 2: (6, 80), 3: (48, 95)}
    assert sizes and max(sizes) <= 3
