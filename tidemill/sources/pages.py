"""Items and links of stored HTML pages, by regular expressions inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions.text import parse_price
from tidemill.operators.relational import recode

# The shape of an item on a catalogue page.
ITEM = r'(?s)<article class="product_pod">(.*?)</article>'
ITEM_TITLE = r'<h3>\s*<a[^>]*\btitle="([^"]*)"'
ITEM_PRICE = r'<p class="price_color">([^<]*)</p>'
ITEM_STOCK = r'(?s)<p class="[^"]*availability[^"]*">(?:\s*<i[^>]*></i>)?\s*([^<]*?)\s*</p>'
ITEM_STARS = r'<p class="star-rating\s+([A-Za-z]+)'
NEXT_LINK = r'(?s)<li class="next">\s*<a[^>]*\bhref="([^"]*)"'
ANY_LINK = r'<a[^>]*\bhref="([^"]*)"'


def extract_items(pages: DataFrame, key: str = "page_id", html: str = "html", stamp: Column | None = None) -> DataFrame:
    """One row per item: title, price, stars (0 if unknown), availability, extraction time."""
    items = pages.select(key, F.explode(F.regexp_extract_all(F.col(html), F.lit(ITEM), F.lit(1))).alias("i"))
    word = F.regexp_extract("i", ITEM_STARS, 1)
    return items.select(
        key,
        F.regexp_extract("i", ITEM_TITLE, 1).alias("titulo"),
        parse_price(F.regexp_extract("i", ITEM_PRICE, 1)).alias("precio"),
        recode(word, fv.STAR_WORDS, F.lit(0)).alias("rating"),
        F.regexp_extract("i", ITEM_STOCK, 1).alias("disponibilidad"),
        (stamp if stamp is not None else F.current_timestamp()).alias("fecha_extraccion"),
    )


def site_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^(https?://[^/?#]+)", 1)


def absolute(href: Column, base: Column) -> Column:
    """Link resolved against its page: full links stay, rooted ones take the site, others the folder."""
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"([^/:])/[^/]*$", "$1")
    return (
        F.when(href.rlike("^https?://"), href)
        .when(href.startswith("/"), F.concat(site_of(base), href))
        .otherwise(F.concat(folder, F.lit("/"), href))
    )


def next_url(pages: DataFrame, url: str = "url", html: str = "html", pattern: str = NEXT_LINK) -> DataFrame:
    """The page's next link as an absolute address; null on the last page."""
    href = F.regexp_extract(F.col(html), pattern, 1)
    return pages.withColumn("next_url", F.when(href != "", absolute(href, F.col(url))))


def links(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Every link of every page, absolute, with its position."""
    found = pages.select(key, url, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(ANY_LINK), F.lit(1))).alias("place", "href"))
    return found.select(key, "place", absolute(F.col("href"), F.col(url)).alias("link"))
