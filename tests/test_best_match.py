"""The bounded search for the best match, against all pairs."""

import random

import pytest

from catalogspark.operators import compare


def all_pairs(left, right):
    out = {}
    for title, year in left:
        words = set(title.split())
        best = 100 if (title, year) in right else 0
        for other, _ in right:
            more = set(other.split())
            if words and more:
                best = max(best, round(100 * len(words & more) / max(len(words), len(more))))
        out[title, year] = best
    return out


def table(spark, rows, first):
    return spark.createDataFrame([(first + i, t, y) for i, (t, y) in enumerate(rows)], "seq long, title string, year string")


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    r = random.Random(seed)
    words = ["the", "of"] + [f"w{i}" for i in range(40)]
    title = lambda: " ".join(r.choice(words[: r.choice([2, 8, 42])]) for _ in range(r.randint(1, 9)))
    right = [(title(), "2000") for _ in range(150)] + [("", "2000")]
    left = [(title(), "2000") for _ in range(150)] + [right[3], (right[4][0], "1999"), ("nothing shared", "2000"), ("", "2001")]
    rows = table(spark, left, 0)
    want = all_pairs(left, set(right))
    found = {left[x.seq]: x.match_percent for x in compare.best_match(rows, table(spark, right, 1000)).collect()}
    assert found == want


def test_a_common_word_makes_no_pairs(spark):
    """Titles that share only their commonest word get their result from the floor; nothing is left to pair."""
    left = [(f"the left{i}", "2000") for i in range(60)]
    right = [(f"the right{i} part", "2000") for i in range(60)] + [("the", "2000")]
    found = compare.best_match(table(spark, left, 0), table(spark, right, 1000)).collect()
    assert {x.match_percent for x in found} == {50}
    titles = lambda rows: spark.createDataFrame([(t, sorted(set(t.split()))) for t, _ in rows], "mk string, t array<string>")
    assert compare.best_overlaps(titles(left), titles(right)).count() == 60


def test_empty_tables(spark):
    none = table(spark, [], 0)
    assert compare.best_match(none, none).count() == 0
    assert [x.match_percent for x in compare.best_match(table(spark, [("a b", "1")], 0), none).collect()] == [0]
