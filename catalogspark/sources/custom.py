"""Extractors of a user's own, as table functions beside the built-in routes."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.functions import udtf

RETURNS = "page_id long, place int, title string, year string, quote string, evidence_type string"
#: (html) -> (title, year or "", quote) for each candidate of a page, in the order of the page.
PageReader = Callable[[str], Iterator[tuple[str, str, str]]]


def as_extractor(read: PageReader, kind: str) -> Callable[[DataFrame], DataFrame]:
    """A plain function of one page's text as an extractor for `route_sources`.

    It runs as a table function over the pages, partitioned by page, so Spark spreads
    the pages and a page's candidates keep their places. Each call makes a few rows,
    which as an Arrow batch a call would cost more than the reading. The function must
    be importable on the executors, or picklable.
    """

    class Pages:
        def eval(self, page: Row) -> Iterator[tuple]:
            for place, (title, year, quote) in enumerate(read(page["html"])):
                yield page["page_id"], place, title, year or "Unknown", quote, kind

    def extract(pages: DataFrame) -> DataFrame:
        spark = pages.sparkSession
        name = f"pages_{re.sub('[^a-z0-9]', '_', kind.lower())}"
        spark.udtf.register(name, udtf(Pages, returnType=RETURNS, useArrow=False))
        return spark.sql(f"SELECT * FROM {name}(TABLE(SELECT page_id, html FROM {{pages}}) PARTITION BY page_id)", pages=pages.select("page_id", "html"))

    return extract


def colon_lines(html: str) -> Iterator[tuple[str, str, str]]:
    """Lines `Title :: YYYY` of a page without markup; the year may be missing."""
    for line in re.sub(r"<[^>]*>", "\n", html).splitlines():
        title, mark, year = line.partition("::")
        if mark and title.strip():
            yield title.strip(), year.strip(), line.strip()

