"""Text repair and windowing as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space, for use inside a character class.
WS = r"\s\x1c-\x1f\x85\p{Z}"

_BLANKS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
_MAX_INT = 2**31 - 1


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, fn) -> Column:
    """``fn`` applied to a value that is computed once, however often ``fn`` uses it."""
    return F.get(F.transform(F.array(value), fn), 0)


def strip(c) -> Column:
    """Remove Unicode white space from both ends (Spark's trim knows only the blank)."""
    return F.btrim(_col(c), F.lit(_BLANKS))


def percent_decode(c, strict: bool = False) -> Column:
    """Decode ``%XX`` escapes as UTF-8 and keep ``+``.

    Lenient mode keeps malformed escapes as they are; strict mode returns the whole input
    unchanged when any escape is malformed.
    """
    c = _col(c)
    plus_safe = F.replace(c, F.lit("+"), F.lit("%2B"))
    if strict:
        decoded = F.coalesce(F.try_url_decode(plus_safe), c)
    else:
        decoded = F.url_decode(F.regexp_replace(plus_safe, "%(?![0-9A-Fa-f]{2})", "%25"))
    return F.when(c.contains("%"), decoded).otherwise(c)


def repair_newlines(c) -> Column:
    """Turn the two characters backslash and n into a line feed."""
    return F.replace(_col(c), F.lit("\\n"), F.lit("\n"))


def text_window(c, max_chars, start=0) -> Column:
    """``[start, start + max_chars)`` in code points.

    A missing or non-positive ``max_chars`` returns the whole text whatever ``start`` is; a missing
    or negative ``start`` counts as 0. Both may be integers or integer columns.
    """
    c = _col(c)

    def as_long(v):
        if isinstance(v, Column):
            return v.cast("long")
        return F.lit(int(v) if isinstance(v, int) else None).cast("long")

    size, begin = as_long(max_chars), as_long(start)
    begin = F.when(begin >= 0, F.least(begin, F.lit(_MAX_INT - 1))).otherwise(F.lit(0))
    taken = F.least(size, F.lit(_MAX_INT)).cast("int")
    return F.when(size > 0, F.substring(c, (begin + 1).cast("int"), taken)).otherwise(c)


def strip_base64_images(c) -> Column:
    """Drop inline base64 image payloads; the alt text around them stays.

    Every place that begins a payload is looked at by itself: a repeated group in one pattern over the
    whole text would recurse as often as it repeats, and a hostile page would overflow the stack.
    """
    begin, payload = "data:image/", r"""\A[^,\s()"']*+(?<=;base64),[A-Za-z0-9+/=_-]*+"""

    def without(parts):
        def rest(part):
            return F.when(part.rlike(payload), F.regexp_replace(part, payload, "")).otherwise(F.concat(F.lit(begin), part))

        return F.concat(F.get(parts, 0), F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), rest), ""))

    return bind(F.split(_col(c), begin, -1), without)


def stable_unique(arr) -> Column:
    """First occurrence of each element, order kept."""
    return F.array_distinct(_col(arr))


def to_compact_json(c) -> Column:
    """One line of JSON without blanks; null members stay."""
    return F.to_json(_col(c), {"ignoreNullFields": "false"})


def export_path(name, directory=".") -> Column:
    """Path of the Markdown file for an export name: its last path segment with ``.md`` ensured."""
    directory = directory if isinstance(directory, Column) else F.lit(directory)
    name = strip(name)
    no_slash = F.regexp_replace(name, "(?<!/)/+\\z", "")
    base = (
        F.when(name == "", F.lit("."))
        .when(name.rlike(r"\A/+\z"), F.lit("/"))
        .otherwise(F.substring_index(no_slash, "/", -1))
    )
    base = F.when(F.lower(base).endswith(".md"), base).otherwise(F.concat(base, F.lit(".md")))
    joined = F.concat(F.coalesce(strip(directory), F.lit("")), F.lit("/"), base)
    # "." segments and doubled slashes vanish; an empty directory means the current one.
    tidy = F.regexp_replace(F.regexp_replace(joined, r"/(?:\./)+", "/"), "//+", "/")
    tidy = F.regexp_replace(tidy, r"\A(?:\./)+", "")
    blank_dir = F.coalesce(strip(directory), F.lit("")) == ""
    return F.when(blank_dir, F.regexp_replace(tidy, r"\A/+", "")).otherwise(tidy)
