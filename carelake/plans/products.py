"""Product lists from shop pages, kept one row per product and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_of_column, day
from ..operators.cards import SiteSpec, extract_cards
from ..operators.dedup import first_per_key, latest_per_key
from ..operators.merge import merge_upsert

PRODUCT_COLUMNS = """scrape_date timestamp_ntz, product_id string, product_sku string, product_name string,
    current_price double, original_price double, discount_percentage double, discount_badge string,
    rating string, reviews string, url string, image_url string"""
DAILY_UPDATED = ["current_price", "original_price", "discount_percentage", "discount_badge", "image_url"]


def daily_keys() -> list:
    return ["product_name", day("scrape_date")]


def product_snapshot(pages: DataFrame, spec: SiteSpec, scraped_at, page_order: str = "page_id", key: str = "product_name") -> DataFrame:
    """One row per product of a scrape: the first card in page order."""
    cards = extract_cards(pages, spec, keep=[page_order])
    first = first_per_key(cards, [key], [F.col(page_order).asc(), F.col("position").asc()])
    return first.select(
        as_of_column(scraped_at).alias("scrape_date"),
        "product_id", "product_sku", "product_name", "current_price", "original_price",
        "discount_percentage", "discount_badge",
        F.lit(None).cast("string").alias("rating"), F.lit(None).cast("string").alias("reviews"),
        "url", "image_url", "full_html_snippet",
    )


def latest_per_day(scrapes: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    """The last scrape of each product and day; all old snapshots may be in the input."""
    return latest_per_key(scrapes, daily_keys(), "scrape_date", tiebreak or ["url"])


def merge_daily(target: DataFrame, scrapes: DataFrame, updated: list[str] | None = None, tiebreak: list[str] | None = None) -> DataFrame:
    """Upsert by product and day: prices are updated, new product days inserted whole."""
    source = latest_per_day(scrapes, tiebreak)
    return merge_upsert(target, source, daily_keys(), updated or [c for c in DAILY_UPDATED if c in target.columns])
