"""Page cleaning, Markdown and metadata.

A page is one row throughout: HTML is read once into an array of events, and the outputs are built
from that array inside the row, so nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcapture.functions.html_events import BLOCK, html_events
from webcapture.functions.selectors import compile_selectors, resolve_exclude_list
from webcapture.functions.text import _col, bind

# The skeleton of a page is a short string of marks, one slot per piece of content. Line breaks and
# emphasis are settled on the skeleton alone, then the contents go into their slots; so no pattern ever
# scans the text itself.
_SLOT = "\x0e"
_MARKER_END = "\x01"  # end of a list marker
_NEWLINE = "\x03"  # fence line of a pre block
_INDENT, _QUOTE = "\x12", "\x13"  # prefix of a line inside a list item or a quotation
_BR, _LINE, _PARA = "\x1c", "\x1d", "\x1e"  # hard break, line break, paragraph break
_STRONG, _STRONG_END, _EM, _EM_END = "\x05", "\x06", "\x07", "\x08"

_LISTS = ("ul", "ol", "menu")
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_PARA_TAGS = sorted(
    BLOCK.difference(_HEADINGS, "li tr td th ul ol menu pre hr optgroup option".split())
)


def page_events(
    df: DataFrame, exclude=None, include=None, empty_tags: bool = False, with_raw: bool = False, wanted: str = "all"
) -> DataFrame:
    """Add ``events``. Selectors are compiled here, so an unsupported one fails before the job."""
    dropped = compile_selectors(resolve_exclude_list(exclude, empty_tags))
    kept = compile_selectors(resolve_exclude_list(include, empty_tags=True))
    return df.withColumn("events", html_events(F.col("html"), dropped, kept, with_raw, wanted))


def clean_html(events) -> Column:
    """Source text of the kept events."""
    return F.array_join(F.filter(_col(events), lambda e: e["keep"])["raw"], "")


def _marks(e: Column) -> Column:
    """Skeleton marks of one event."""
    kind, tag, val, cell, lit = e["kind"], e["tag"], e["val"], e["cell"], F.lit
    nothing, blank = lit(""), lit(" ")
    prefix = F.when(
        e["quote"] + e["indent"] > 0,
        F.concat(F.repeat(lit(_QUOTE), e["quote"]), F.repeat(lit(_INDENT), e["indent"])),
    ).otherwise(nothing)
    slot = F.concat(prefix, lit(_SLOT))
    # Inside a table cell everything stays on the line of its row.
    para = F.when(cell, blank).otherwise(lit(_PARA))
    line = F.when(cell, blank).otherwise(lit(_LINE))
    list_break = F.when(e["indent"] > 0, line).otherwise(para)
    code = (tag == "code") & ~e["pre"]

    text = (
        F.when(e["pre"], slot)
        .when(val == " ", blank)
        .otherwise(
            F.concat(
                F.when(val.startswith(" "), blank).otherwise(nothing),
                slot,
                F.when(val.endswith(" "), blank).otherwise(nothing),
            )
        )
    )
    number = F.when(e["n"] > 0, F.concat(e["n"].cast("string"), lit(". "))).otherwise(lit("- "))
    opening = (
        F.when(tag.isin(*_PARA_TAGS), para)
        .when(tag == "a", F.when(_is_link(e), F.concat(prefix, lit("["))).otherwise(nothing))
        .when(tag == "li", F.concat(line, prefix, number, lit(_MARKER_END)))
        .when(tag.isin("b", "strong"), F.concat(prefix, lit(_STRONG)))
        .when(tag.isin("i", "em"), F.concat(prefix, lit(_EM)))
        .when(tag == "br", F.when(cell, blank).otherwise(lit(_BR)))
        .when(
            tag.isin(*_HEADINGS),
            F.concat(para, prefix, F.repeat(lit("#"), F.substring(tag, 2, 1).cast("int")), blank),
        )
        .when(tag.isin(*_LISTS), list_break)
        .when(tag.isin("td", "th"), blank)
        .when(tag == "tr", F.concat(line, prefix, lit("|")))
        .when((tag == "img") & _is_link(e), slot)
        .when(code, F.concat(prefix, lit("`")))
        .when(tag == "pre", F.concat(para, prefix, lit("```" + _NEWLINE), prefix))
        .when(tag == "hr", F.concat(para, prefix, lit("---"), para))
        .otherwise(nothing)
    )
    closing = (
        F.when(tag.isin(*_PARA_TAGS, *_HEADINGS), para)
        .when((tag == "a") & _is_link(e), lit("](" + _SLOT + ")"))
        .when(tag == "li", line)
        .when(tag.isin("b", "strong"), lit(_STRONG_END))
        .when(tag.isin("i", "em"), lit(_EM_END))
        .when(tag.isin(*_LISTS), list_break)
        .when(tag.isin("td", "th"), lit(" |"))
        .when(
            (tag == "tr") & (e["n"] > 0),
            F.concat(lit(_LINE), prefix, lit("|"), F.repeat(lit(" --- |"), e["n"])),
        )
        .when(code, lit("`"))
        .when(tag == "pre", F.concat(lit(_NEWLINE), prefix, lit("```" + _PARA)))
        .otherwise(nothing)
    )
    return (
        F.when(kind == "text", text)
        .when(kind == "open", opening)
        .when(kind == "close", closing)
        .when(kind == "gap", para)
        .otherwise(nothing)
    )


def _is_link(e: Column) -> Column:
    return F.coalesce(F.trim(e["val"]) != "", F.lit(False))


def _content(e: Column) -> Column:
    """What goes into the slot of an event, null where it has none; follows the slots of the marks."""
    kind, tag, val, lit = e["kind"], e["tag"], e["val"], F.lit
    line_start = F.concat(lit("\n"), F.repeat(lit("> "), e["quote"]), F.repeat(lit("  "), e["indent"]))
    cell_text = F.replace(F.trim(val), lit("|"), lit("\\|"))
    image = F.concat(lit("!["), F.coalesce(e["alt"], lit("")), lit("]("), F.trim(val), lit(")"))
    return (
        F.when((kind == "text") & e["pre"], F.regexp_replace(val, lit("\r?\n"), line_start))
        .when((kind == "text") & (val != " "), F.when(e["cell"], cell_text).otherwise(F.trim(val)))
        .when((kind == "close") & (tag == "a") & _is_link(e), F.trim(val))
        .when((kind == "open") & (tag == "img") & _is_link(e), image)
    )


def _piece(e: Column) -> Column:
    return F.struct(_marks(e).alias("marks"), _content(e).alias("content"))


def _settle(skeleton: Column) -> Column:
    """Resolve the marks of a skeleton; every step is one linear scan over character classes."""
    any_break = f" {_BR}{_LINE}{_PARA}"
    at_run = f"(?<![{any_break}])"
    openers, closers = _STRONG + _EM, _STRONG_END + _EM_END
    steps = (
        # White space moves out of emphasis; emphasis around nothing vanishes.
        (f"{at_run}([{any_break}]+)([{closers}]+)", "$2$1"),
        (f"(?<![{openers}])([{openers}]++)([{any_break}]+)", "$2$1"),
        (f"{_STRONG}{_STRONG_END}|{_EM}{_EM_END}", ""),
        (f"{_STRONG}{_STRONG_END}|{_EM}{_EM_END}", ""),
        (f"{_MARKER_END}[{any_break}]*", ""),
        (f"{at_run}[{any_break}]*{_PARA}[{any_break}]*", "\n\n"),
        (f"{at_run}[ {_LINE}]*{_BR}[ {_LINE}]*{_BR}[{any_break}]*", "\n\n"),
        (f"{at_run}[ {_LINE}]*{_BR}[ {_LINE}]*", "  \n"),
        (f"{at_run} *{_LINE}[ {_LINE}]*", "\n"),
        (" {3,}| {2}(?!\n)", " "),
        # Line prefixes hold only at the start of a line.
        (f"(?<=[^\n{_NEWLINE}{_INDENT}{_QUOTE}])[{_INDENT}{_QUOTE}]+", ""),
        (r"\A\s+|(?<!\s)\s+\z", ""),
        (_INDENT, "  "),
        (_QUOTE, "> "),
        (_NEWLINE, "\n"),
        (f"[{_STRONG}{_STRONG_END}]", "**"),
        (f"[{_EM}{_EM_END}]", "*"),
    )
    for pattern, replacement in steps:
        skeleton = F.regexp_replace(skeleton, pattern, replacement)
    return skeleton


def render_markdown(events, kept_only: bool = True) -> Column:
    """Markdown of the kept events, or of all of them. Text is not escaped, so it stays searchable."""
    events = _col(events)
    if kept_only:
        events = F.filter(events, lambda e: e["keep"])

    def fill(pieces):
        gaps = F.split(_settle(F.array_join(pieces["marks"], "")), _SLOT, -1)
        contents = F.array_compact(pieces["content"])
        both = F.zip_with(gaps, contents, lambda g, c: F.concat(g, F.coalesce(c, F.lit(""))))
        return F.array_join(both, "")

    return bind(F.transform(events, _piece), fill)


def render_with_fallback(events) -> Column:
    """Struct of ``markdown`` and ``used_fallback``: the kept events, or all of them where those give
    exactly ``""``. The second rendering runs only there."""
    events = _col(events)

    def state(markdown, tries):
        return F.struct(markdown.alias("markdown"), tries.alias("tries"))

    return F.aggregate(
        F.array(F.filter(events, lambda e: e["keep"]), events),
        state(F.lit(""), F.lit(0)),
        lambda acc, es: F.when(
            acc["markdown"] == "", state(render_markdown(es, kept_only=False), acc["tries"] + 1)
        ).otherwise(acc),
        lambda acc: F.struct(acc["markdown"], (acc["tries"] == 2).alias("used_fallback")),
    )


def _first(events: Column, test, field: str = "val") -> Column:
    found = F.filter(events, lambda e: test(e) & (F.trim(e[field]) != ""))
    return F.trim(F.regexp_replace(F.get(found, 0)[field], r"[ \t\n\f\r]+", " "))


def metadata(events) -> Column:
    """Struct of title, description, language, canonical URL and og:url; null where absent."""

    def fields(heads):
        def meta(name):
            return _first(heads, lambda e: (e["tag"] == "meta") & (F.lower(e["alt"]) == name))

        title = _first(heads, lambda e: e["kind"] == "title")
        canonical = _first(
            heads,
            lambda e: (e["tag"] == "link")
            & F.array_contains(F.split(F.lower(e["alt"]), " "), "canonical"),
        )
        return F.struct(
            F.coalesce(title, meta("og:title")).alias("title"),
            F.coalesce(meta("description"), meta("og:description")).alias("description"),
            _first(heads, lambda e: e["tag"] == "html").alias("language"),
            canonical.alias("canonical"),
            meta("og:url").alias("ogUrl"),
        )

    heads = F.filter(
        _col(events), lambda e: (e["kind"] == "title") | e["tag"].isin("meta", "link", "html")
    )
    return bind(heads, fields)


def clean_pages(df: DataFrame, exclude=None, include=None, empty_tags: bool = False) -> DataFrame:
    """Delete every element, with its subtree, that an exclusion matches; with ``include`` keep only
    the matching subtrees first. The remaining source text is untouched."""
    events = page_events(df, exclude, include, empty_tags, with_raw=True, wanted="kept")
    return events.select("page_id", "url", clean_html("events").alias("clean_html"))


def pages_to_markdown(df: DataFrame, exclude=None, include=None, empty_tags: bool = False) -> DataFrame:
    events = page_events(df, exclude, include, empty_tags, wanted="kept")
    return events.select("page_id", "url", render_markdown("events", kept_only=False).alias("markdown"))


def page_metadata(df: DataFrame) -> DataFrame:
    """One row per page: title, description, language, ogUrl, and url: the canonical one, else ogUrl, else as asked."""
    events = page_events(df, empty_tags=True, wanted="head")
    found = events.select("page_id", F.col("url").alias("_requested"), metadata("events").alias("m"))
    return found.select(
        "page_id",
        "m.title",
        "m.description",
        "m.language",
        F.coalesce("m.canonical", "m.ogUrl", "_requested").alias("url"),
        "m.ogUrl",
    )


def with_fallback(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Replace an empty first result by the second one.

    Only a Markdown of exactly ``""`` from a response that did not fail qualifies, and the second
    result counts only if it succeeded and has a data object. Both sides carry ``key``, ``success``
    and ``markdown``; ``second`` also ``has_data``. Only qualifying keys reach the join: the other
    first rows are passed through without a shuffle. Give a stored table as ``first``, since it is
    read twice; ``capture_pages`` does the same for raw pages without a join.
    """
    empty = F.coalesce(F.col("markdown") == "", F.lit(False)) & F.coalesce(F.col("success"), F.lit(True))
    value_columns = [c for c in first.columns if c != key]
    usable = second.filter(F.coalesce(F.col("success"), F.lit(True)) & F.col("has_data"))
    usable = usable.select(F.col(key), F.struct(*value_columns).alias("_second"))
    retried = first.filter(empty).join(usable, key, "left")
    used = F.col("_second").isNotNull()
    retried = retried.select(
        key,
        *[F.when(used, F.col("_second")[c]).otherwise(F.col(c)).alias(c) for c in value_columns],
        used.alias("used_fallback"),
    )
    untouched = first.filter(~empty).select(key, *value_columns, F.lit(False).alias("used_fallback"))
    return untouched.unionByName(retried)
