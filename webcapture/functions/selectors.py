"""Selector lists as columns, and selectors compiled once on the driver."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from webcapture.functions.text import _col, strip
from webcapture.functions.variant import parse_body

# The built-in boilerplate selectors, in order.
DEFAULT_EXCLUDES = (
    "script",
    "style",
    "noscript",
    "form",
    "input",
    "button",
    "select",
    "textarea",
    "nav",
    ".nav",
    ".navbar",
    ".navigation",
    ".menu",
    ".menubar",
    "header",
    "footer",
    "aside",
    '[class*="logo"]',
    '[class*="brand"]',
    '[id*="logo"]',
    'img[alt*="logo"]',
    'img[src*="logo"]',
    '[id*="brand"]',
    '[class^="category--"]',
    '[id^="category--"]',
    '[class$="--category"]',
    '[id$="--category"]',
    '[class^="skip"]',
    '[class*="accessib"]',
    ".sr-only",
    ".visually-hidden",
    '[class*="-ad-"]',
    '[class*="_ad_"]',
    '[class$="-ad"]',
    '[class$="_ad"]',
    '[class^="ad-"]',
    '[class^="ad_"]',
    '[class*="advert"]',
    ".sidebar",
    "#sidebar",
    '[class*="sidebar"]',
    '[class*="sider"]',
    '[class^="menu-"]',
    '[class^="menu_"]',
    '[class$="_module"]',
    '[class$="-module"]',
    '[class*="breadcrumb"]',
    '[class*="pagination"]',
    '[class*="relate"]',
    '[class*="recommend"]',
    '[class*="trending"]',
    '[class^="header-"]',
    '[class$="-header"]',
    '[class^="header_"]',
    '[class$="_header"]',
    '[class*="footer"]',
    '[class$="-offset"]',
    '[class*="-offset-"]',
    '[class$="_offset"]',
    '[class*="_offset_"]',
)


def _clean(items: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(items, strip), lambda s: s != ""))


def _listed(text: Column) -> Column:
    """A JSON array whose items are strings or null, else null."""
    items = F.try_variant_get(parse_body(text), "$", "array<variant>")
    return F.when(F.forall(items, lambda x: F.schema_of_variant(x).isin("STRING", "VOID")), items)


def parse_selectors(c) -> Column:
    """Comma text or a JSON string array to a clean, stably unique list.

    Blank text gives null, which differs from an empty list; bad JSON gives null and a
    ``selectors_error``.
    """
    text = strip(c)
    strings = F.transform(_listed(text), lambda x: F.try_variant_get(x, "$", "string"))
    return (
        F.when(text == "", F.lit(None).cast("array<string>"))
        .when(text.startswith("["), _clean(strings))
        .otherwise(_clean(F.split(text, ",")))
    )


def selectors_error(c) -> Column:
    """Reason why a selector text is rejected, else null."""
    text = strip(c)
    return F.when(
        text.startswith("[") & _listed(text).isNull(),
        F.lit("must be a comma-separated string or JSON string array"),
    )


def resolve_excludes(user=None, empty_tags: bool = False) -> Column:
    """Built-in selectors, then the user's; ``empty_tags`` drops the built-in ones only."""
    none = F.array().cast("array<string>")
    user = none if user is None else F.coalesce(_clean(_col(user)), none)
    if empty_tags:
        return user
    return F.array_distinct(F.concat(F.array(*[F.lit(s) for s in DEFAULT_EXCLUDES]), user))


def resolve_exclude_list(user=None, empty_tags: bool = False) -> list[str]:
    """``resolve_excludes`` for a list that is known on the driver."""
    cleaned = [s.strip() for s in user or [] if isinstance(s, str) and s.strip()]
    return list(dict.fromkeys(([] if empty_tags else list(DEFAULT_EXCLUDES)) + cleaned))


class Compound(NamedTuple):
    """One element test: a tag name (or None), attribute tests and compounds sought inside."""

    tag: str | None
    attrs: tuple[tuple[str, str, str], ...]
    has: tuple["Compound", ...]


class Selector(NamedTuple):
    """The tested element and, going outwards, its ``(is_parent, compound)`` conditions."""

    subject: Compound
    outer: tuple[tuple[bool, Compound], ...]


_SIMPLE = re.compile(
    r"""(?P<tag>(?<![\w.#\])])[A-Za-z][\w-]*|(?<![\w.#\])])\*)
      | \.(?P<cls>[\w-]+) | \#(?P<id>[\w-]+)
      | \[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[*^$~|]?=)\s*(?P<val>"[^"]*"|'[^']*'|[^\]"'\s]+)\s*)?\]
      | :has\((?P<has>[^()]*)\)""",
    re.X,
)
# A compound ends at white space or ">" outside brackets, parentheses and quotes.
_COMPOUND = re.compile(r"""(?:\[(?:"[^"]*"|'[^']*'|[^\]"'])*\]|:has\([^()]*\)|[^\s>\[])+""")
_COMMA = re.compile(r""",(?=(?:[^"'\[\]()]|"[^"]*"|'[^']*'|\[(?:"[^"]*"|'[^']*'|[^\]"'])*\]|\([^()]*\))*\Z)""")


def _compound(text: str, whole: str, inside_has: bool = False) -> Compound:
    tag, attrs, has, at = None, [], [], 0
    while at < len(text):
        m = _SIMPLE.match(text, at)
        if m is None or (m["has"] is not None and inside_has):
            raise ValueError(f"unsupported selector: {whole!r}")
        at = m.end()
        if m["tag"]:
            tag = None if m["tag"] == "*" else m["tag"].lower()
        elif m["cls"]:
            attrs.append(("class", "~=", m["cls"]))
        elif m["id"]:
            attrs.append(("id", "=", m["id"]))
        elif m["attr"]:
            value = m["val"] or ""
            attrs.append((m["attr"].lower(), m["op"] or "", value[1:-1] if value[:1] in "\"'" else value))
        else:
            has = [_compound(part.strip(), whole, True) for part in m["has"].split(",")]
    if not text:
        raise ValueError(f"unsupported selector: {whole!r}")
    return Compound(tag, tuple(attrs), tuple(has))


def compile_selectors(selectors) -> tuple[Selector, ...]:
    """Compile a selector list; an unsupported form raises here, before any job starts."""
    rules = []
    for listed in selectors:
        for text in _COMMA.split(listed):
            parts, joins, at, text = [], [], 0, text.strip()
            while at < len(text):
                gap = re.compile(r"\s*(>?)\s*").match(text, at)
                m = _COMPOUND.match(text, gap.end())
                if m is None or (gap[1] and not parts):
                    raise ValueError(f"unsupported selector: {listed!r}")
                if parts:
                    joins.append(bool(gap[1]))
                parts.append(_compound(m[0], listed))
                at = m.end()
            if not parts or any(p.has for p in parts[:-1]):
                raise ValueError(f"unsupported selector: {listed!r}")
            outer = tuple(zip(reversed(joins), reversed(parts[:-1])))
            rules.append(Selector(parts[-1], outer))
    return tuple(dict.fromkeys(rules))


def compound_matches(rule: Compound, tag: str, attrs: dict[str, str]) -> bool:
    """Test tag and attributes; attribute tests see the whole attribute string."""
    if rule.tag is not None and rule.tag != tag:
        return False
    for name, op, want in rule.attrs:
        have = attrs.get(name)
        if have is None:
            return False
        if op == "~=":
            ok = want in have.split()
        elif op == "*=":
            ok = want != "" and want in have
        elif op == "^=":
            ok = want != "" and have.startswith(want)
        elif op == "$=":
            ok = want != "" and have.endswith(want)
        elif op == "|=":
            ok = have == want or have.startswith(want + "-")
        else:
            ok = op == "" or have == want
        if not ok:
            return False
    return True
