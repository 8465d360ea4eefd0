"""Checks on tables of requests, and the filters that requests ask for."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcapture.functions.recency import CODES, recency_error
from webcapture.functions.selectors import selectors_error
from webcapture.functions.text import _col, bind, strip

# Extensions of documents that can be parsed, result limits, longest timeout in seconds.
DOCUMENT_EXTENSIONS = (".html", ".htm", ".pdf", ".docx", ".doc", ".odt", ".rtf", ".xlsx", ".xls")
MAX_RESULTS = {"search": 100, "scholar": 500}
DEFAULT_RESULTS = 20
MAX_TIMEOUT_S = 9223372036
# Groups in which top papers are first cut to k.
_BUCKETS = 256


def clamp_limit(c) -> Column:
    """Keep 1 to 100, else 20."""
    c = _col(c)
    return F.when(c.between(1, 100), c).otherwise(F.lit(DEFAULT_RESULTS))


def file_extension(c) -> Column:
    """Lower-cased extension of the last path segment, with its dot; blank when there is none."""
    return F.lower(F.regexp_extract(_col(c), r"(\.[^./]*)\z", 1))


def supported_documents(df: DataFrame, name_col: str) -> DataFrame:
    return df.filter(file_extension(name_col).isin(*DOCUMENT_EXTENSIONS))


def _blank(name: str) -> Column:
    return F.coalesce(strip(name), F.lit("")) == ""


def validate_requests(df: DataFrame, kind: str) -> DataFrame:
    """Add ``reject_reason``: that of the first failing rule, null for a good row.

    Search and scholar rows have query, search_num, timeout_s (search also search_time); scrape rows
    output, url, timeout_s (and include_tags, exclude_tags); parse rows output, url, file, timeout_s.
    """
    timeout = F.col("timeout_s")
    timeout_rules = [
        (timeout <= 0, "timeout must be an integer greater than 0"),
        (timeout > MAX_TIMEOUT_S, "timeout is too large"),
    ]
    if kind in MAX_RESULTS:
        top = MAX_RESULTS[kind]
        rules = [
            (_blank("query"), "query is required"),
            (~F.col("search_num").between(1, top), f"search_num must be an integer from 1 to {top}"),
            *timeout_rules,
        ]
        if kind == "search" and "search_time" in df.columns:
            rules.append((recency_error("search_time").isNotNull(), recency_error("search_time")))
    elif kind == "scrape":
        rules = [
            (_blank("output"), "output is required"),
            (_blank("url"), "url is required"),
            *timeout_rules,
        ]
        for name in ("include_tags", "exclude_tags"):
            if name in df.columns:
                problem = selectors_error(name)
                rules.append((problem.isNotNull(), F.concat(F.lit(name + " "), problem)))
    elif kind == "parse":
        has_file = ~_blank("file")
        rules = [
            (_blank("output"), "output is required"),
            (~_blank("url") & has_file, "only one of url or file may be provided"),
            (_blank("url") & _blank("file"), "one of url or file is required"),
            *timeout_rules,
            (
                has_file & ~file_extension(strip("file")).isin(*DOCUMENT_EXTENSIONS),
                "file extension must be one of: " + ", ".join(DOCUMENT_EXTENSIONS),
            ),
        ]
    else:
        raise ValueError(f"unknown kind {kind!r}")
    reason = F.lit(None).cast("string")
    for test, text in reversed(rules):
        text = F.lit(text) if isinstance(text, str) else text
        reason = F.when(F.coalesce(test, F.lit(False)), text).otherwise(reason)
    return df.withColumn("reject_reason", reason)


def split_requests(df: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    checked = validate_requests(df, kind)
    reason = F.col("reject_reason")
    return checked.filter(reason.isNull()).drop("reject_reason"), checked.filter(reason.isNotNull())


_SPAN = {
    "qdr:h": "INTERVAL 1 HOUR",
    "qdr:d": "INTERVAL 1 DAY",
    "qdr:w": "INTERVAL 7 DAY",
    "qdr:m": "INTERVAL 1 MONTH",
    "qdr:y": "INTERVAL 1 YEAR",
}


def recent(df: DataFrame, ts_col: str, code, as_of) -> DataFrame:
    """Rows of the last hour, day, week, month or year before ``as_of``; a null code keeps all rows.

    With a fixed code both bounds fold to literals and reach the file scan.
    """
    ts = F.col(ts_col)
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    if isinstance(code, Column):

        def in_time(known_code):
            start = F.lit(None).cast("timestamp")
            for known, span in _SPAN.items():
                start = F.when(known_code == known, as_of - F.expr(span)).otherwise(start)
            return known_code.isNull() | ((ts > start) & (ts <= as_of))

        return df.filter(bind(code, in_time))
    if code is None:
        return df
    if code not in CODES:
        raise ValueError(f"unknown recency code {code!r}")
    return df.filter((ts > as_of - F.expr(_SPAN[code])) & (ts <= as_of))


def has_all(arr, wanted) -> Column:
    """True when every wanted value is present."""
    wanted = wanted if isinstance(wanted, Column) else F.array(*[F.lit(w) for w in wanted]).cast("array<string>")
    present = F.coalesce(_col(arr), F.array().cast("array<string>"))
    return F.size(F.array_except(wanted, present)) == 0


def in_date_window(df: DataFrame, cols, frm: str | None = None, to: str | None = None) -> Column:
    """True when any of the columns lies in the inclusive window; an absent bound is open.

    Bounds are ``yyyy-MM-dd`` and the upper one covers its whole day. Date and timestamp columns are
    compared as they are, so that the bounds can reach the file scan.
    """
    low = dt.date.fromisoformat(frm) if frm else None
    high = dt.date.fromisoformat(to) if to else None
    hit = F.lit(False)
    for name in [cols] if isinstance(cols, str) else cols:
        is_text = isinstance(df.schema[name].dataType, T.StringType)
        value = F.try_to_timestamp(F.col(name)) if is_text else F.col(name)
        test = value.isNotNull()
        if low is not None:
            test = test & (value >= F.lit(low))
        if high is not None:
            test = test & (value < F.lit(high + dt.timedelta(days=1)))
        hit = hit | test
    return hit


def fresh_captures(
    df: DataFrame, key: str, ts: str, as_of, max_age_ms: int = 172_800_000, tie: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Per key the newest capture not older than ``max_age_ms`` at ``as_of``, and the keys without one.

    The first result reads only the window of time, the second only keys and times. Both keep one
    candidate per key and map task, so a key that holds much of the table costs no more than any other.
    """
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    oldest = as_of - F.expr(f"make_dt_interval(0, 0, 0, {max_age_ms / 1000:.3f})")
    in_time = (F.col(ts) >= oldest) & (F.col(ts) <= as_of)
    rest = [c for c in df.columns if c != key]
    # A total order: of captures with the newest time (and ``tie``), the one with the largest hash.
    plain = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = F.struct(ts, *([tie] if tie else []), F.xxhash64(*plain))
    newest = df.filter(in_time).groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_newest"))
    fresh = newest.select(key, *[F.col("_newest")[c].alias(c) for c in rest])
    any_fresh = df.groupBy(key).agg(F.max(F.when(in_time, 1).otherwise(0)).alias("_fresh"))
    return fresh, any_fresh.filter("_fresh = 0").select(key)


def limit_per_request(df: DataFrame, n_col, pos: str = "pos") -> DataFrame:
    """First results of every request and kind.

    ``pos`` counts from 0 within a response and kind without gaps, so the limit is a plain filter. A null
    limit is the default of ``DEFAULT_RESULTS``; a limit below 1 leaves nothing.
    """
    limit = n_col if isinstance(n_col, Column) else F.lit(n_col) if isinstance(n_col, int) else F.col(n_col)
    return df.filter(F.col(pos) < F.coalesce(limit, F.lit(DEFAULT_RESULTS)))


def top_papers(
    df: DataFrame, k: int = 5, partition: str | None = None, score: str = "score", tie: str = "paperId"
) -> DataFrame:
    """The k best by score, then id; per ``partition`` when one is given.

    Both forms keep at most k rows per map task (and key) before any shuffle. The rows of all tasks are then
    first cut to k in each of ``_BUCKETS`` groups (of each key), so that no task sees k of every task, even
    where one key holds most rows.
    """
    if not 1 <= k <= MAX_RESULTS["scholar"]:
        raise ValueError("k must be from 1 to 500")
    order = [F.col(score).desc_nulls_last(), F.col(tie).asc()]
    bucket = F.pmod(F.xxhash64(tie), F.lit(_BUCKETS))
    rank = F.row_number().over(Window.partitionBy(*([partition] if partition else []), "_bucket").orderBy(*order))
    df = df.withColumn("_bucket", bucket).withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_bucket", "_rank")
    if partition is None:
        return df.orderBy(*order).limit(k)
    rank = F.row_number().over(Window.partitionBy(partition).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")
