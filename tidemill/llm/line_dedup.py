"""Line deduplication by site-relative frequency.

Lines that stand in more than a given share of a host's pages are boilerplate of that host and are dropped
from its pages. Lines are compared by the MD5 of their text, so that keys are short; a line counts once for a
page. Counting combines before the shuffle, so a host or a line that many pages share is no burden on one
task; what joins by a frequent line is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import numbered, text_or_empty
from tidemill.session import stored

#: Lines in more than this share of a host's pages are dropped, if they stand on this many pages at least: of
#: one page alone the share says nothing, it shares all lines with itself.
MOST_SHARE, LEAST_PAGES = 0.3, 2
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without."""
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)://([^/?#]*)", 1), F.lit("")), _UPPER, _UPPER.lower())


def lines(html: Column) -> Column:
    """The pieces of a page between tags and line ends, without white space around them, no empty ones."""
    cut = F.split(F.regexp_replace(text_or_empty(html), "<[^>]*>", "\n"), "\n", -1)
    return F.filter(F.transform(cut, lambda x: F.regexp_replace(x, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")), lambda x: x != "")


def without_boilerplate(
    pages: DataFrame, url: str = "url", html: str = "html", key: str = "page_id", most_share: float = MOST_SHARE, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """One row for each row of ``pages``: the key, ``host, n_lines, n_dropped`` and ``kept``, the array of lines
    that stay, in order.

    Null urls and urls without ``://`` have no host: all their lines stay. Null and empty pages have no lines.
    A repeated row counts as a page. A line that is dropped stands on ``least_pages`` pages at least.
    """
    rows = numbered(pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"))).select(
        "rid", "key", host(F.col("url")).alias("host"), lines(F.col("html")).alias("lines")
    )
    marks = F.transform("lines", lambda x: F.unhex(F.md5(x)))
    held = stored(rows.where("host <> ''").select("rid", "host", F.array_distinct(marks).alias("marks")), "lines")
    sites = held.groupBy("host").agg(F.count("*").alias("pages"))
    each = held.select("rid", "host", F.explode("marks").alias("mark"))
    counts = each.groupBy("host", "mark").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    common = counts.join(sites, "host").where(F.col("n") > most_share * F.col("pages")).select("host", "mark")
    dropped = each.join(common, ["host", "mark"]).groupBy("rid").agg(F.collect_list("mark").alias("dropped"))
    out = rows.join(dropped, "rid", "left")
    kept = F.filter("lines", lambda x: ~F.array_contains(F.coalesce("dropped", F.array().cast("array<binary>")), F.unhex(F.md5(x))))
    return out.select(F.col("key").alias(key), "host", F.size("lines").cast("long").alias("n_lines"), kept.alias("kept")).select(
        key, "host", "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"), "kept"
    )
