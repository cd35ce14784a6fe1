import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, `rank` int"


def corpus(seed: int = 5) -> list[tuple[int, str | None]]:
    """Documents with copies, near copies, shared passages and lines, and odd texts."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(400)] + ["Éa", "ñu", "x#", "<b>", "CC"]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passages, lines, bases = [prose(70) for _ in range(3)], [prose(12) for _ in range(4)], [prose(120) for _ in range(3)]
    out: list[tuple[int, str | None]] = []
    for i in range(90):
        kind = i % 9
        if kind == 0:
            text = prose(r.randint(1, 150))
        elif kind == 1:
            text = prose(30) + "\n" + r.choice(passages) + "\n" + prose(5)
        elif kind == 2:
            text = r.choice(bases)
        elif kind in (3, 4):
            w = r.choice(bases).split()
            for _ in range(r.randint(1, 6)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            text = " ".join(w)
        elif kind == 5:
            text = "\n".join(r.choice(lines) + r.choice(["", "", " q"]) for _ in range(5)) + "\n\n" + prose(9) + "\n"
        elif kind == 6:
            text = prose(25) + "\t" + r.choice(["Released under the MIT License.", "all rights  reserved, all rights reserved", "GNU General Public\nLicense", "CC-BY"])
        elif kind == 7:
            text = "ab cd, " * r.randint(0, 90)
        else:
            text = r.choice(["", None, " \n\t ", "word", "a b", "é" * 60, "x" * 3000, r.choice(passages)[7:]])
        out.append((1000 + 7 * i if i % 11 else i, text))
    return [*out, out[1], out[20]]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    data = [(i, t, None if i % 5 == 0 else "en", None if i % 13 == 0 else ["hot", "hot", "a", "b"][i % 4], None, "clash", 1) for i, t in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
