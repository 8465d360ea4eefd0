"""Raw pages to capture records, and response dumps to results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcapture.functions.text import strip_base64_images, text_window
from webcapture.operators.balance import balanced_by_bytes
from webcapture.operators.pages import metadata, page_events, render_with_fallback, with_fallback
from webcapture.operators.requests import limit_per_request
from webcapture.operators.responses import av_records, classify, parse_records, scholar_results, scrape_records, search_results, split_outcomes
from webcapture.sources.writers import render_capture, render_parsed


def capture_pages(
    df: DataFrame,
    exclude=None,
    include=None,
    empty_tags: bool = False,
    partitions: int | None = None,
    max_chars: int | None = None,
    start: int = 0,
    balance: bool = False,
) -> DataFrame:
    """Pages ``(page_id, url, html)`` to captures with ``export_text``.

    A page whose Markdown comes out as exactly ``""`` is rendered again from all its events, without
    any selector; ``used_fallback`` marks it. The events of a page hold both answers, so there is no
    second read and no join, and the job also runs on a stream. There is no shuffle either, unless
    ``partitions`` asks for one: give it when few large row groups would leave cores idle. With
    ``balance`` the pages are dealt to them by bytes, after a first pass over the lengths: for tables where few pages
    hold most of the bytes. ``max_chars`` and ``start`` keep a window of the Markdown. A page without HTML (null) has the outcome ``empty``, no Markdown
    and no success; ``write_exports`` passes it over.
    """
    pages = df.select("page_id", "url", "html")
    if balance:
        if partitions is None:
            raise ValueError("balance needs a number of partitions")
        pages = balanced_by_bytes(pages, "html", ["page_id", "url"], partitions)
    elif partitions is not None:
        pages = pages.repartition(partitions)
    pages = pages.withColumn("_found", F.col("html").isNotNull())
    events = page_events(pages, exclude, include, empty_tags).drop("html")
    found = F.col("_found")
    captured = events.select(
        "page_id",
        "_found",
        F.col("url").alias("_requested"),
        metadata("events").alias("_meta"),
        render_with_fallback("events").alias("_text"),
    )
    records = captured.select(
        "page_id",
        F.coalesce("_meta.canonical", "_meta.ogUrl", "_requested").alias("url"),
        "_meta.title",
        "_meta.description",
        "_meta.language",
        F.when(found, strip_base64_images(text_window("_text.markdown", max_chars, start))).alias("markdown"),
        (found & F.col("_text.used_fallback")).alias("used_fallback"),
        F.lit(None).cast("double").alias("creditsUsed"),
        found.alias("success"),
        F.when(found, "ok").otherwise("empty").alias("outcome"),
        F.when(~found, "page has no HTML").alias("message"),
    )
    return render_capture(records)


def flatten_search(
    df: DataFrame, limit_col: str | None = None, kinds=("web", "news", "images")
) -> tuple[DataFrame, DataFrame]:
    """Search responses to result rows, at most ``limit_col`` per response and kind, and the quarantine."""
    good, bad = split_outcomes(classify(df, "search"))
    if limit_col is None:
        return search_results(good, kinds), bad
    rows = search_results(good, kinds, carry=(limit_col,))
    return limit_per_request(rows, limit_col).drop(limit_col), bad


def flatten_scrapes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scrape responses to capture records with ``export_text``, and the quarantine."""
    good, bad = split_outcomes(classify(df, "scrape"))
    return render_capture(scrape_records(good)), bad


def flatten_scholar(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scholar responses to papers, and the quarantine."""
    good, bad = split_outcomes(classify(df, "scholar"))
    return scholar_results(good), bad


def flatten_parse(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Responses for parsed documents to records with ``export_text``, and the quarantine."""
    good, bad = split_outcomes(classify(df, "parse"))
    return render_parsed(parse_records(good)), bad


def flatten_av(df: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Audio or video responses to records, and the quarantine."""
    good, bad = split_outcomes(classify(df, kind))
    return av_records(good, kind), bad


def scrapes_with_fallback(first: DataFrame, second: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``flatten_scrapes``; a record with empty Markdown is replaced by that of the good second
    response with the same id, if there is one. ``used_fallback`` marks it."""
    good, bad = split_outcomes(classify(first, "scrape"))
    again = split_outcomes(classify(second, "scrape"))[0]
    retried = scrape_records(again).withColumn("has_data", F.lit(True))
    return render_capture(with_fallback(scrape_records(good), retried, "response_id")), bad
