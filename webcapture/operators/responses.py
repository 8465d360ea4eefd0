"""Flattening of captured API responses, held as VARIANT in column ``v``, and their outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcapture.functions.text import percent_decode, repair_newlines
from webcapture.functions.variant import (
    boolean_false,
    credits_used,
    error_reason,
    is_large,
    is_object,
    large_markdown,
    number,
    pick,
    resolved_url,
    string_only,
    truthy,
)

# The members kept of an item of each kind, and where its list lies.
ITEM_FIELDS = {
    "web": ("title", "description", "url"),
    "news": ("title", "snippet", "url", "date"),
    "images": ("title", "imageUrl", "url"),
    "scholar": ("title", "abstract", "paperId", "primaryId", "score"),
}
_ITEM_PATH = {
    "web": "$.data.web",
    "news": "$.data.news",
    "images": "$.data.images",
    "scholar": "$.results",
}


def _items(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, _ITEM_PATH[kind], "array<variant>")


def _item_columns(item: Column, kind: str) -> list[Column]:
    return [
        pick(item, field, as_type="double" if field == "score" else "string").alias(field)
        for field in ITEM_FIELDS[kind]
    ]


def _results(df: DataFrame, kind: str) -> DataFrame:
    exploded = df.select("response_id", F.posexplode(_items(F.col("v"), kind)).alias("pos", "item"))
    return exploded.select("response_id", "pos", *_item_columns(F.col("item"), kind))


def web_results(df: DataFrame) -> DataFrame:
    """One row per web item in response order; a non-object item gives an all-null row, a list that
    is missing or no list gives none."""
    return _results(df, "web")


def news_results(df: DataFrame) -> DataFrame:
    return _results(df, "news")


def image_results(df: DataFrame) -> DataFrame:
    return _results(df, "images")


def scholar_results(df: DataFrame) -> DataFrame:
    return _results(df, "scholar")


def search_results(df: DataFrame, kinds=("web", "news", "images"), carry=()) -> DataFrame:
    """Items of the asked kinds with a ``kind`` tag, missing fields null; ``carry`` names further
    columns of the response to keep.

    The result is that of a union of the single kinds, but each response is read and parsed once: the
    lists are concatenated before they are exploded.
    """
    def tagged(kind):
        def item(x, i):
            return F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("pos"), x.alias("item"))

        empty = F.array().cast("array<struct<kind:string,pos:int,item:variant>>")
        return F.coalesce(F.transform(_items(F.col("v"), kind), item), empty)

    def field(name):
        holders = [kind for kind in kinds if name in ITEM_FIELDS[kind]]
        value = pick("r.item", name)
        return (value if len(holders) == len(kinds) else F.when(F.col("r.kind").isin(holders), value)).alias(name)

    rows = df.select("response_id", *carry, F.explode(F.concat(*[tagged(k) for k in kinds])).alias("r"))
    fields = dict.fromkeys(f for kind in kinds for f in ITEM_FIELDS[kind])
    return rows.select("response_id", *carry, "r.kind", "r.pos", *[field(name) for name in fields])


def search_envelope(df: DataFrame) -> DataFrame:
    """Add ``envelope``: success, the three lists and credits, values passed through as VARIANT."""
    v = F.col("v")

    def raw_items(kind):
        def item(x):
            return F.struct(*[pick(x, f, as_type="variant").alias(f) for f in ITEM_FIELDS[kind]])

        shape = "array<struct<{}>>".format(",".join(f"{f}:variant" for f in ITEM_FIELDS[kind]))
        return F.coalesce(F.transform(_items(v, kind), item), F.array().cast(shape)).alias(kind)

    return df.withColumn(
        "envelope",
        F.struct(
            pick(v, "success", as_type="variant").alias("success"),
            F.struct(*[raw_items(k) for k in ("web", "news", "images")]).alias("data"),
            pick(v, "creditsUsed", as_type="variant").alias("creditsUsed"),
        ),
    )


def _markdown(df: DataFrame, strict: bool, repair: bool) -> Column:
    text = string_only("v", "data", "markdown")
    if "raw" in df.columns:
        text = F.when(is_large("raw"), large_markdown("raw")).otherwise(text)
    text = percent_decode(text, strict=strict)
    return repair_newlines(text) if repair else text


def _meta(name: str, as_type: str = "string") -> Column:
    return pick("v", "data", "metadata", name, as_type=as_type).alias(name)


def _success() -> Column:
    """True, false or null as the JSON has it; any other type is null."""
    value = F.try_variant_get("v", "$.success", "variant")
    return F.when(F.schema_of_variant(value) == "BOOLEAN", F.try_variant_get(value, "$", "boolean")).alias("success")


def scrape_records(df: DataFrame, strict: bool = False, repair: bool = True) -> DataFrame:
    """Capture records; Markdown is decoded and, unless ``repair`` is off, its literal newlines mended."""
    return df.select(
        "response_id",
        _success(),
        _meta("proxyUsed"),
        _meta("title"),
        _meta("description"),
        resolved_url("v", F.col("target_url")).alias("url"),
        _meta("language"),
        _markdown(df, strict, repair).alias("markdown"),
        credits_used("v", "scrape").alias("creditsUsed"),
    )


def parse_records(df: DataFrame, strict: bool = False, repair: bool = True) -> DataFrame:
    return df.select(
        "response_id",
        _meta("title"),
        resolved_url("v", F.col("target_url")).alias("url"),
        _meta("language"),
        credits_used("v", "parse").alias("creditsUsed"),
        _markdown(df, strict, repair).alias("markdown"),
    )


def av_records(df: DataFrame, kind: str) -> DataFrame:
    if kind not in ("audio", "video"):
        raise ValueError("kind must be audio or video")
    return df.select(
        "response_id",
        credits_used("v", "av").alias("creditsUsed"),
        _meta("title"),
        _meta("description"),
        pick("v", "data", kind).alias(kind),
        _success(),
    )


def credit_snapshots(df: DataFrame) -> DataFrame:
    def field(name):
        return number("v", "data", name).alias(name)

    return df.select(
        "response_id",
        field("remainingCredits"),
        field("planCredits"),
        F.try_to_timestamp(pick("v", "data", "billingPeriodStart")).alias("billingPeriodStart"),
        F.try_to_timestamp(pick("v", "data", "billingPeriodEnd")).alias("billingPeriodEnd"),
    )


def classify(df: DataFrame, kind: str = "scrape", status_col: str | None = None) -> DataFrame:
    """Add ``outcome``, first match wins, and ``message`` for everything that is not ok."""
    v, raw = F.col("v"), F.col("raw")
    chain = []
    if status_col is not None:
        chain.append((~F.col(status_col).between(200, 299), "http_error"))
    chain += [
        (raw.isNull() | ~raw.rlike(r"[^\s\x1c-\x1f\x85\p{Z}]") | F.is_variant_null(v), "empty"),
        (v.isNull(), "unparseable"),
        (~is_object(v), "malformed"),
        (truthy(v, "error"), "error"),
        (boolean_false(v, "success"), "upstream_false"),
    ]
    if kind != "scholar":
        chain.append((~is_object(v, "data"), "missing_data"))
    outcome = F.lit("ok")
    for test, label in reversed(chain):
        outcome = F.when(F.coalesce(test, F.lit(False)), F.lit(label)).otherwise(outcome)
    labelled = df.withColumn("outcome", outcome)
    return labelled.withColumn("message", _message())


def _message() -> Column:
    outcome = F.col("outcome")
    fixed = (
        F.when(outcome == "empty", "response is empty")
        .when(outcome == "unparseable", "response is not JSON")
        .when(outcome == "malformed", "response is not an object")
        .when(outcome == "missing_data", "response is missing data object")
    )
    return F.when(outcome != "ok", F.coalesce(fixed, error_reason("v")))


def split_outcomes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the quarantine with the reason of each failure."""
    good = df.filter(F.col("outcome") == "ok").drop("outcome", "message")
    return good, df.filter(F.col("outcome") != "ok").drop("v")
