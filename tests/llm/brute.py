"""Plain Python versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

SPACE = " \t\n\v\f\r"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def removed_spans(items_by_doc, window):
    first = {}
    for d, items in sorted(items_by_doc, key=lambda x: x[0]):
        for i in range(len(items) - window + 1):
            first.setdefault(tuple(items[i : i + window]), d)
    out = []
    for d, items in items_by_doc:
        gone = [False] * len(items)
        for i in range(len(items) - window + 1):
            if first[tuple(items[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out.append((d, items, gone))
    return out


def op2(rows):
    out = []
    for d, data, gone in removed_spans([(d, (t or "").encode()) for d, t in rows], 50):
        kept = bytes(x for x, g in zip(data, gone) if not g)
        out.append((d, len(data), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def op6(rows):
    out = []
    for d, items, gone in removed_spans([(d, words(t)) for d, t in rows], 50):
        kept = " ".join(x for x, g in zip(items, gone) if not g)
        out.append((d, len(items), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def op1(rows):
    phrases = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}
    out = []
    for d, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
        at = {k: [i for i in range(len(w)) if w[i : i + len(p)] == p] for k, p in phrases.items()}
        every = sorted(i for x in at.values() for i in x)
        out.append((d, len(w), len(every), every[0] if every else None, every[-1] if every else None, ",".join(sorted(k for k, x in at.items() if x))))
    return sorted(out, key=str)


def op7(rows):
    out = []
    for d, t in rows:
        t = t or ""
        w = words(t)
        grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        hit = set()
        for i, g in enumerate(grams):
            if grams.count(g) > 1:
                hit |= set(range(i, i + 8))
        lines = [x for x in t.split("\n") if x.strip(SPACE)]
        n_rep = len(hit)
        failed = len(w) < 20 or 100 * n_rep > 30 * len(w)
        out.append((d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), n_rep, failed))
    return sorted(out)


def shingles(t):
    w = words(lower(t))
    return frozenset([tuple(w)]) if 0 < len(w) < 5 else frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def op10(rows, percent=85):
    sets = [(d, shingles(t)) for d, t in rows]
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if x and y and 100 * len(x & y) >= percent * len(x | y)]
    part = components({d for d, _ in rows}, links)
    return sorted((d, len(s), part[d], d == part[d]) for d, s in sets)


def char_runs(line, n=8):
    return {line[i : i + n] for i in range(max(1, len(line) - n + 1))}


def op3(rows, percent=80):
    """Every line with a word, with the place of the first line of its component."""
    lines = sorted((d, i, x) for d, t in rows for i, x in enumerate((t or "").split("\n")) if x.strip(SPACE))
    distinct = sorted({x for _, _, x in lines})
    sets = [char_runs(x) for x in distinct]
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if 100 * len(a & b) >= percent * len(a | b)]
    part = components(range(len(distinct)), links)
    index = {x: i for i, x in enumerate(distinct)}
    home = {}
    for d, i, x in lines:
        home.setdefault(part[index[x]], (d, i))
    return sorted((d, i, *home[part[index[x]]], (d, i) == home[part[index[x]]]) for d, i, x in lines)


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def keeps(t):
    """The current policy of the quality rules."""
    (_, n, chars, symbols, dup, rep, failed) = op7([(0, t)])[0]
    lines = [x for x in (t or "").split("\n") if x.strip(SPACE)]
    return not (failed or 5 * symbols > n or (len(lines) >= 4 and 2 * dup > len(lines)) or chars < 2 * n or chars > 25 * n)


def unit(*parts):
    return (int(hashlib.md5(":".join(parts).encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def copies(rows):
    """Copies of each (doc_id, source) row: inverse Poisson draws with the mean total * sqrt(n) / sum(sqrt) / n, for means that one draw serves."""
    n = Counter(s for _, s in rows)
    weights = sum(math.sqrt(x) for x in n.values())
    out = []
    for d, s in rows:
        rate = math.sqrt(n[s]) / weights * len(rows) / n[s]
        u, k, term, total = unit("mixture", "" if d is None else str(d)), 0, math.exp(-rate), math.exp(-rate)
        while total < u:
            k += 1
            term *= rate / k
            total += term
        out.append(k)
    return out
