"""Which elements of a page stand inside which: one walk over its tags, for what regular expressions cannot tell.

The walk is linear in the page. It runs on Arrow batches inside tasks; all that
follows on its results (entities, spaces, headers, evidence) is column work.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as S

TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)\b[^>]*>")
DEAD = re.compile(r"(?is)<!--.*?-->|<(head|noscript|script|style|template)\b.*?</\1\s*>")

# Tags without an end, and tags whose text may be a record of its own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROWS = frozenset("tr li p".split())
BLOCKS = frozenset("address article aside blockquote dd div dt figcaption figure footer h1 h2 h3 h4 h5 h6 header main nav section td th".split())
RECORDS = ROWS | BLOCKS
STRINGS = S.ArrayType(S.StringType())
ROW_LIST = S.ArrayType(S.StructType([S.StructField("table_no", S.IntegerType()), S.StructField("row_no", S.IntegerType()), S.StructField("cells", STRINGS), S.StructField("headers", STRINGS)]))
ROW_ARROW = pa.list_(pa.struct([("table_no", pa.int32()), ("row_no", pa.int32()), ("cells", pa.list_(pa.string())), ("headers", pa.list_(pa.string()))]))

#: An opening tag ends what is open of the first set, up to the nearest tag of the second.
ENDS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol"})),
    "tr": (frozenset({"tr"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "p": (frozenset({"p"}), RECORDS - {"p"}),
}


@dataclass
class Node:
    tag: str
    first: int  # its pieces of text are first .. last - 1
    last: int = 0
    until: int = 0  # the elements inside it are those after it, up to this number


def walk(html: str) -> tuple[list[str], list[Node]]:
    """A page's pieces of text, line breaks as pieces of their own, and its elements in the order they open.

    An end tag ends the nearest open element of its name with all in it; one
    without such an element is passed over. What is never ended ends with the page.
    """
    html = DEAD.sub("", html)
    pieces: list[str] = []
    nodes: list[Node] = []
    stack: list[int] = []
    names: Counter[str] = Counter()

    def end(depth: int) -> None:
        while len(stack) > depth:
            node = nodes[stack.pop()]
            node.last, node.until = len(pieces), len(nodes)
            names[node.tag] -= 1

    at = 0
    for m in TAG.finditer(html):
        pieces.append(html[at : m.start()])
        at, tag = m.end(), m[2].lower()
        if tag == "br":
            pieces.append("\n")
        if tag in VOID:
            continue
        if m[1]:
            if names[tag]:
                end(next(d for d in range(len(stack) - 1, -1, -1) if nodes[stack[d]].tag == tag))
            continue
        ended, within = ENDS.get(tag, (frozenset(), frozenset()))
        if any(names[t] for t in ended):
            for d in range(len(stack) - 1, -1, -1):
                if nodes[stack[d]].tag in ended:
                    end(d)
                    break
                if nodes[stack[d]].tag in within:
                    break
        nodes.append(Node(tag, len(pieces)))
        stack.append(len(nodes) - 1)
        names[tag] += 1
    pieces.append(html[at:])
    end(0)
    return pieces, nodes


def item_texts(html: str | None) -> list[str]:
    """The text of each list item, with that of the items inside it."""
    pieces, nodes = walk(html or "")
    return [" ".join(pieces[n.first : n.last]) for n in nodes if n.tag == "li"]


def table_cells(html: str | None) -> list[tuple[int, int, list[str], list[str] | None]]:
    """(table, row, cells, headers) of rows with two cells or more; headers are the cells of the last row before it in its table that has header cells alone.

    A table's rows and a row's cells are all inside it, those of nested tables too;
    nested tables are tables of their own besides.
    """
    pieces, nodes = walk(html or "")
    out, table = [], -1
    for i, t in enumerate(nodes):
        if t.tag != "table":
            continue
        table, headers, number = table + 1, None, -1
        for r in range(i + 1, t.until):
            if nodes[r].tag != "tr":
                continue
            number += 1
            cells = [n for n in nodes[r + 1 : nodes[r].until] if n.tag in ("td", "th")]
            texts = [" ".join(pieces[n.first : n.last]) for n in cells]
            if len(cells) < 2:
                continue
            if all(n.tag == "th" for n in cells):
                headers = texts
            else:
                out.append((table, number, texts, headers))
    return out


def record_texts(text: str | None) -> list[str]:
    """Lines of the units that a quote has to lie in: each table row, each item or paragraph without such a unit in it, each other block without any block in it; the whole page's where it has none."""
    pieces, nodes = walk(text or "")
    out: list[str] = []
    # From the last element on: how many elements of each kind open at or after it.
    rows, records = [0] * (len(nodes) + 1), [0] * (len(nodes) + 1)
    for i in range(len(nodes) - 1, -1, -1):
        rows[i], records[i] = rows[i + 1] + (nodes[i].tag in ROWS), records[i + 1] + (nodes[i].tag in RECORDS)
    for i, n in enumerate(nodes):
        inside = rows if n.tag in ROWS else records
        if n.tag in RECORDS and (n.tag == "tr" or inside[i + 1] == inside[n.until]):
            out += " ".join(pieces[n.first : n.last]).splitlines()
    return out if any(x.strip() for x in out) else " ".join(pieces).splitlines()


@F.pandas_udf(STRINGS)
def items(html: pd.Series) -> pd.Series:
    return html.map(item_texts)


@F.arrow_udf(ROW_LIST)
def rows(html: pa.Array) -> pa.Array:
    return pa.array([[dict(zip(("table_no", "row_no", "cells", "headers"), r, strict=True)) for r in table_cells(h)] for h in html.to_pylist()], ROW_ARROW)


@F.pandas_udf(STRINGS)
def records(text: pd.Series) -> pd.Series:
    return text.map(record_texts)
