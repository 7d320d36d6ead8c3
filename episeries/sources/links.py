"""Report links out of HTML index pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episeries.functions.domains import REPORT_HREF, REPORT_TITLE
from episeries.functions.textnum import replace_literals, whole_number

ANCHOR = r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""
# Character references that matter in titles and addresses.
BLANK_REFERENCES = [("&nbsp;", " "), ("&#160;", " "), ("\u00a0", " ")]
OTHER_REFERENCES = [("&ordm;", "º"), ("&#186;", "º"), ("&amp;", "&")]


def anchors(pages: DataFrame, page: str, html: str = "html") -> DataFrame:
    """One row per anchor: page, position on the page, href, title."""
    found = pages.select(
        page, F.posexplode(F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(0))).alias("pos", "_a")
    )
    inner = F.regexp_replace(F.regexp_extract("_a", ANCHOR, 2), "<[^>]*>", "")
    return found.select(
        page,
        "pos",
        replace_literals(F.regexp_extract("_a", ANCHOR, 1), OTHER_REFERENCES).alias("href"),
        replace_literals(inner, BLANK_REFERENCES + OTHER_REFERENCES).alias("title"),
    )


def report_number(title: Column) -> Column:
    """59 out of ``Informe nº 59. Situación …``."""
    pattern = rf"{REPORT_TITLE}\s*([0-9]+)\s*\."
    return whole_number(F.regexp_extract(F.lower(title), pattern, 1))


def link_table(
    pages: DataFrame,
    page: str,
    href_pattern: str = REPORT_HREF,
    key: Callable[[Column], Column] = report_number,
    html: str = "html",
) -> DataFrame:
    """One link per key: the last on its page, the earliest page winning.

    The pick is an aggregate, so it is combined before the exchange.
    """
    links = (
        anchors(pages, page, html)
        .filter(F.col("href").rlike(href_pattern))
        .select(key(F.col("title")).alias("number"), "href", page, "pos")
        .filter(F.col("number").isNotNull())
    )
    return links.groupBy("number").agg(
        F.min_by("href", F.struct(F.col(page), -F.col("pos"))).alias("href")
    )
