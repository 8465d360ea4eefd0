"""Tolerant access to JSON held as VARIANT: a missing or badly typed level yields null, never an error."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

from webcapture.functions.text import _col

#: Bytes of text beyond which Spark cannot hold the parsed value.
VARIANT_BYTES = 128 << 20
# Members that the flattening reads, at the root and in "data"; the Markdown is read as text.
_ROOT = ("success", "message", "error", "upstream", "creditsUsed", "results", "headers")
_DATA = (
    "metadata", "web", "news", "images", "audio", "video",
    "remainingCredits", "planCredits", "billingPeriodStart", "billingPeriodEnd",
)
_ANY_LENGTH = {"maxStringLen": str((1 << 31) - 1)}


def _path(keys) -> str:
    return "$" + "".join(f'["{k}"]' if "'" in k else f"['{k}']" for k in keys)


def parsed_bodies(c) -> Column:
    """Array with the one element ``parse_body`` gives.

    Exploding it makes the parsed value a column of its own: the optimizer copies a projected
    expression into the filters above it, and every copy would parse again.
    """
    c = _col(c)

    def checked(wrapped):
        single = (
            F.try_variant_get(wrapped, "$[1]", "variant").isNull()
            & F.try_variant_get(wrapped, "$[0][1]", "variant").isNull()
        )
        in_object = F.try_parse_json(F.concat(F.lit('{"x":'), c, F.lit("}"))).isNotNull()
        whole = single & (~c.rlike(r"\]\s*(?:\]|\z)") | in_object)
        return F.when(whole, F.try_variant_get(wrapped, "$[0][0]", "variant"))

    return F.transform(F.array(F.try_parse_json(F.concat(F.lit("[["), c, F.lit("]]")))), checked)


def _members() -> str:
    data = ",".join(["markdown:string", *(f"{k}:variant" for k in _DATA)])
    return "struct<" + ",".join([*(f"{k}:variant" for k in _ROOT), f"data:struct<{data}>"]) + ">"


def is_large(c) -> Column:
    """True for a body that is longer than a parsed value may be."""
    return F.coalesce(F.octet_length(_col(c)) > VARIANT_BYTES, F.lit(False))


def _pulled(c: Column) -> Column:
    """The members of a body of any length, pulled from the text as they pass; null unless it is one value."""
    rows = F.from_json(F.concat(F.lit("[["), c, F.lit("]]")), f"array<array<{_members()}>>", _ANY_LENGTH)
    in_object = F.from_json(F.concat(F.lit('{"x":'), c, F.lit("}")), "struct<x:string>", _ANY_LENGTH)["x"].isNotNull()
    whole = (F.size(rows) == 1) & (F.size(F.get(rows, 0)) == 1) & (~c.rlike(r"\]\s*(?:\]|\z)") | in_object)
    return F.when(whole, F.get(F.get(rows, 0), 0))


def large_body(c) -> Column:
    """A body beyond ``VARIANT_BYTES`` as VARIANT: the members that this library reads, without the Markdown.

    Nothing of the text is parsed into a value but those members. Null if it is not one JSON object.
    """
    found = _pulled(_col(c))
    return F.get(F.transform(F.array(found), lambda x: F.try_parse_json(F.to_json(x.withField("data", x["data"].dropFields("markdown"))))), 0)


def large_markdown(c) -> Column:
    """``data.markdown`` of a body beyond ``VARIANT_BYTES``, null where no member of that name is a string."""
    c = _col(c)
    has_string = c.rlike(r'"markdown"\s*:\s*"')
    rows = F.from_json(c, "struct<data:struct<markdown:string>>", _ANY_LENGTH)
    return F.when(has_string, rows["data"]["markdown"])


def parse_body(c) -> Column:
    """Text to VARIANT, null unless the whole text is one JSON value.

    Spark's parser stops after the first value and ignores what follows it. Inside two brackets such
    a rest is an error or a second element, unless it closes brackets itself; texts where that could
    be are parsed once more inside an object, where a bracket cannot follow the value.
    """
    return F.get(parsed_bodies(c), 0)


def pick(v, *keys: str, default=None, as_type: str = "string") -> Column:
    """Walk object keys; a missing key or a non-object on the way gives ``default``.

    A JSON null that is present stays null and does not take the default.
    """
    v = _col(v)
    value = F.try_variant_get(v, _path(keys), as_type)
    if default is None:
        return value
    present = F.try_variant_get(v, _path(keys), "variant").isNotNull()
    return F.when(present, value).otherwise(F.lit(default).cast(as_type))


def is_object(v, *keys: str) -> Column:
    """True when the value at the path is a JSON object."""
    return F.try_variant_get(_col(v), _path(keys), "map<string,variant>").isNotNull()


def string_only(v, *keys: str) -> Column:
    """The value at the path if it is a JSON string, else null."""
    value = F.try_variant_get(_col(v), _path(keys), "variant")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def boolean_false(v, *keys: str) -> Column:
    """True only for a JSON ``false``; strings and numbers do not count."""
    value = F.try_variant_get(_col(v), _path(keys), "variant")
    return F.coalesce(
        (F.schema_of_variant(value) == "BOOLEAN") & ~F.try_variant_get(value, "$", "boolean"),
        F.lit(False),
    )


def truthy(v, *keys: str) -> Column:
    """False for a missing value, null, false, 0, "", [] and {}; true for everything else."""
    value = F.try_variant_get(_col(v), _path(keys), "variant")
    text = F.to_json(value)
    return value.isNotNull() & ~text.rlike(r'\A(?:null|false|-?0(?:\.0*)?(?:[eE][+-]?\d+)?|""|\[\]|\{\})\z')


def resolved_url(v, target=None) -> Column:
    """First non-blank string among metadata url, sourceURL and ogUrl, else the requested URL."""
    found = [string_only(v, "data", "metadata", key) for key in ("url", "sourceURL", "ogUrl")]
    found = [F.when(u.rlike(r"[^\s\x1c-\x1f\x85\p{Z}]"), u) for u in found]
    return F.coalesce(*found, _col(target) if target is not None else F.lit(None).cast("string"))


def number(v, *keys: str) -> Column:
    """The number at the path as it is given, fractions included; null where there is none."""
    value = pick(v, *keys, as_type="double")
    return F.when(F.abs(value) <= sys.float_info.max, value)


def number_text(c) -> Column:
    """A number as JSON writes it: whole ones without a fraction, up to the size that a double holds exactly."""
    c = _col(c)
    whole = (c == F.floor(c)) & (F.abs(c) <= 2**53)
    return F.when(whole, c.cast("long").cast("string")).otherwise(c.cast("string"))


def credits_used(v, scope: str) -> Column:
    """Credits by record kind: search reads the root, scrape the metadata, parse and av both."""
    root = number(v, "creditsUsed")
    meta = number(v, "data", "metadata", "creditsUsed")
    if scope == "search":
        return root
    if scope == "scrape":
        return meta
    if scope in ("parse", "av"):
        return F.coalesce(meta, root)
    raise ValueError(f"unknown scope {scope!r}")


def error_reason(v) -> Column:
    """First non-null of message and error, else the same inside ``upstream`` to any depth."""
    v = _col(v)

    def here(x):
        return F.coalesce(
            F.try_variant_get(x, "$.message", "string"), F.try_variant_get(x, "$.error", "string")
        )

    # The nesting is at most the number of "upstream" keys in the text.
    depth = F.regexp_count(F.to_json(v), F.lit('"upstream":'))
    nested = F.aggregate(
        F.sequence(F.lit(0), depth),
        F.struct(v.alias("at"), F.lit(None).cast("string").alias("reason")),
        lambda acc, _: F.struct(
            F.try_variant_get(acc["at"], "$.upstream", "variant").alias("at"),
            F.coalesce(acc["reason"], here(acc["at"])).alias("reason"),
        ),
        lambda acc: acc["reason"],
    )
    return F.coalesce(here(v), F.when(is_object(v, "upstream"), nested), F.lit("unknown error"))
