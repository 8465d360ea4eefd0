"""HTML text to a flat array of events.

Spark has no HTML reader and its xpath functions need well-formed XML, so this module holds the one
piece of per-row Python: a single linear pass that finds tags, closes what real pages leave open, and
marks which events the selectors keep. Everything made from the events (clean HTML, Markdown,
metadata) is built by Column expressions in ``webcapture.operators.pages``.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import functions as F

from webcapture.functions.batches import pieces
from webcapture.functions.selectors import Selector, compound_matches

# Fixed values of the HTML standard: void, raw-text and block elements, and what an opening tag ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style iframe noembed noframes xmp textarea title".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav noscript ol "
    "optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
P_ENDERS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
# Opening tag: (open elements it ends, elements the search does not leave).
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, set()),
}
P_SCOPE = {"button", "caption", "object", "table", "td", "th"}
END_SCOPE = {"caption", "table", "td", "th"}
TABLE_PARTS = {"caption", "table", "tbody", "tfoot", "thead", "tr"}
LISTS = {"ul", "ol", "menu"}
# Elements that carry state for the events inside them.
STATEFUL = LISTS | {"blockquote", "li", "pre", "table", "td", "th", "tr"}
# Levels of quotes and lists that a Markdown line shows; deeper ones lose the prefix, never the content.
MAX_PREFIX = 100
# Attributes carried by the events: (value, second value) per tag.
CARRIED = {
    "a": ("href", "title"),
    "html": ("lang", None),
    "img": ("src", "alt"),
    "link": ("href", "rel"),
    "meta": ("content", "name"),
}
# Tags that Markdown or metadata is made from; the others give events only where the source is wanted.
TELLING = BLOCK | set(CARRIED) | {"b", "br", "code", "em", "i", "strong"}
# What an opening tag ends: (open elements, elements the search does not leave).
ENDERS = {
    tag: tuple(x for x in (IMPLIED_END.get(tag), ({"p"}, P_SCOPE) if tag in P_ENDERS else None) if x)
    for tag in P_ENDERS | set(IMPLIED_END)
}

_START = re.compile(r"<(?=[A-Za-z!?]|/[A-Za-z])")
_MARKUP = re.compile(
    r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^"'=>]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+)> |
        <!--.*?(?:-->|\Z) | <[!?][^>]*>""",
    re.S | re.X,
)
_BLANKS = re.compile(r"[ \t\n\f\r]+")
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")

_FIELDS = [
    ("kind", "string", pa.string()),
    ("tag", "string", pa.string()),
    ("raw", "string", pa.string()),
    ("val", "string", pa.string()),
    ("alt", "string", pa.string()),
    ("quote", "int", pa.int32()),
    ("indent", "int", pa.int32()),
    ("n", "bigint", pa.int64()),
    ("pre", "boolean", pa.bool_()),
    ("cell", "boolean", pa.bool_()),
    ("keep", "boolean", pa.bool_()),
]
EVENTS_DDL = "array<struct<{}>>".format(",".join(f"{name}:{ddl}" for name, ddl, _ in _FIELDS))


def _text(s: str) -> str:
    return unescape(s) if "&" in s else s


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, dq, sq, bare in _ATTR.findall(source):
        found.setdefault(name.lower(), _text(dq or sq or bare))
    return found


class Rules:
    """Selectors of one list, grouped so that most elements are tested against few of them."""

    def __init__(self, selectors: tuple[Selector, ...]):
        self.by_tag: dict[str, list[Selector]] = {}
        self.by_attr: dict[str, list[Selector]] = {}
        self.any: list[Selector] = []
        self.has = tuple({c for s in selectors for c in s.subject.has})
        self.tags = {s.subject.tag for s in selectors if s.subject.tag} | {c.tag for c in self.has if c.tag}
        # Compounds that an element without attributes can meet whatever its tag.
        self.universal = any(c.tag is None and not c.attrs for c in self.has)
        # Conditions on ancestors per selector, from the outermost one inwards.
        self.chains = {s: tuple(reversed(s.outer)) for s in selectors if s.outer}
        for s in selectors:
            if s.subject.tag is not None:
                self.by_tag.setdefault(s.subject.tag, []).append(s)
            elif s.subject.attrs:
                self.by_attr.setdefault(s.subject.attrs[0][0], []).append(s)
            else:
                self.any.append(s)

    def chain_steps(self, tag, attrs, parent):
        """Chain steps that end at this element, and those that end at it or at an ancestor.

        A step counts only if the step before it ends at the parent, or at any ancestor, as the
        selector asks; so every element costs one look at each step, however deep it lies.
        """
        here, above = set(), parent[1] if parent else frozenset()
        for s, chain in self.chains.items():
            for i, (_, compound) in enumerate(chain):
                if i and not (parent and (s, i - 1) in parent[0 if chain[i - 1][0] else 1]):
                    continue
                if compound_matches(compound, tag, attrs):
                    here.add((s, i))
        return here, above | here if here else above

    def matches(self, tag, attrs, parent) -> tuple[bool, tuple]:
        """Whether the element matches already, and the ``:has`` alternatives left to decide."""
        waiting = []
        groups = [self.by_attr[name] for name in attrs if name in self.by_attr]
        if tag in self.by_tag:
            groups.append(self.by_tag[tag])
        for group in (*groups, self.any):
            for s in group:
                if s.outer and not (parent and (s, len(s.outer) - 1) in parent[0 if s.outer[0][0] else 1]):
                    continue
                if compound_matches(s.subject, tag, attrs):
                    if not s.subject.has:
                        return True, ()
                    waiting.append(frozenset(s.subject.has))
        return False, tuple(waiting)


class _Open:
    """An open element: where its events begin, and what the two lists of selectors say of it."""

    __slots__ = ("tag", "attrs", "first", "hit", "waiting", "inside", "steps")

    def __init__(self, tag, attrs, first):
        self.tag, self.attrs, self.first = tag, attrs, first
        # Per list, where it says anything: matched at once, and ``:has`` alternatives to be decided.
        self.hit = self.waiting = self.inside = self.steps = None


class _Page:
    """State of one pass over one page; ``out`` collects its events as rows."""

    def __init__(self, rules, with_raw):
        self.out: list[tuple] = []
        self.rules, self.with_raw = rules, with_raw
        self.lists_in_use = [which for which in (0, 1) if rules[which] is not None]
        in_use = [rules[which] for which in self.lists_in_use]
        # Most elements have no attribute and a tag that no selector names; they skip the rules.
        self.tags_in_rules = frozenset(tag for r in in_use for tag in r.tags)
        self.has_chains = any(r.chains for r in in_use)
        self.always = self.has_chains or any(r.any or r.universal for r in in_use)
        self.stack: list[_Open] = []
        # Stack positions of the open elements: by tag, of blocks, and of those that hold end tags in.
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.scopes: list[int] = []
        self.spans: tuple[list, list] = ([], [])
        self.quote = self.pre = self.cell = 0
        self.lists: list[list] = []
        self.tables: list[list] = []

    def emit(self, kind, tag="", raw="", val=None, alt=None, n=0, indent=None):
        self.out.append(
            (
                kind,
                tag,
                raw if self.with_raw else None,
                val,
                alt,
                min(self.quote, MAX_PREFIX),
                min(len(self.lists) if indent is None else indent, MAX_PREFIX),
                n,
                self.pre > 0,
                self.cell > 0,
            )
        )

    def close_from(self, at, raw=""):
        """Close the open elements from the top of the stack down to position ``at``."""
        while len(self.stack) > at + 1:
            self.leave("")
        if len(self.stack) > at:
            self.leave(raw)

    def leave(self, raw):
        el = self.stack.pop()
        tag = el.tag
        self.places[tag].pop()
        if tag in BLOCK:
            self.blocks.pop()
        if tag in END_SCOPE:
            self.scopes.pop()
        n = 0
        if tag in STATEFUL:
            if tag in LISTS:
                self.lists.pop()
            elif tag == "blockquote":
                self.quote -= 1
            elif tag == "table":
                self.tables.pop()
            elif tag == "td" or tag == "th":
                self.cell -= 1
            elif tag == "tr" and self.tables:
                table = self.tables[-1]
                table[0] += 1
                n = table[1] if table[0] == 1 else 0
        if self.with_raw or tag in TELLING:
            self.emit("close", tag, raw, el.attrs.get("href") if tag == "a" else None, None, n)
        if tag == "pre":
            self.pre -= 1
        if el.inside and self.stack:
            self.found_inside(el.inside)
        if el.hit is not None:
            self.close_spans(el)

    def close_spans(self, el):
        for which in self.lists_in_use:
            if el.hit[which] or any(not has.isdisjoint(el.inside or ()) for has in el.waiting[which]):
                if which:
                    self.emit("gap")
                self.spans[which].append((el.first, len(self.out)))

    def found_inside(self, compounds):
        parent = self.stack[-1]
        parent.inside = compounds if parent.inside is None else parent.inside | compounds

    def end_implied(self, tag):
        places = self.places
        for ends, scope in ENDERS[tag]:
            if not any(places.get(t) for t in ends):
                continue
            edge = max((places[t][-1] for t in scope if places.get(t)), default=-1)
            open_ = [places[t] for t in ends if places.get(t) and places[t][-1] > edge]
            if open_:
                self.close_from(min(own[bisect_right(own, edge)] for own in open_))

    def apply_rules(self, el):
        """Record what the selectors say of an element that is about to open."""
        parent = self.stack[-1] if self.stack else None
        hit, waiting, steps = [False, False], [(), ()], [None, None]
        for which in self.lists_in_use:
            rules = self.rules[which]
            above = parent.steps[which] if parent and parent.steps else None
            hit[which], waiting[which] = rules.matches(el.tag, el.attrs, above)
            if rules.chains:
                steps[which] = rules.chain_steps(el.tag, el.attrs, above)
            if rules.has and parent:
                found = {c for c in rules.has if compound_matches(c, el.tag, el.attrs)}
                if found:
                    self.found_inside(found)
        if any(hit) or any(waiting):
            el.hit, el.waiting = hit, waiting
        if self.has_chains:
            el.steps = steps

    def enter(self, tag, attr_text, raw):
        if tag in ENDERS:
            self.end_implied(tag)
        attrs = _attributes(attr_text) if attr_text else {}
        el = _Open(tag, attrs, len(self.out))
        if attrs or self.always or tag in self.tags_in_rules:
            self.apply_rules(el)
        n, indent = 0, None
        if tag in STATEFUL:
            if tag == "li":
                indent = max(len(self.lists) - 1, 0)
                if self.lists:
                    step, n = self.lists[-1]
                    self.lists[-1][1] = n + step
            elif tag == "pre":
                self.pre += 1
            elif self.tables and tag == "tr":
                self.tables[-1][1] = 0
            elif self.tables and (tag == "td" or tag == "th"):
                self.tables[-1][1] += 1
        if self.with_raw or tag in TELLING:
            val = alt = None
            if tag in CARRIED:
                first, second = CARRIED[tag]
                val, alt = attrs.get(first), attrs.get(second)
                if tag == "meta" and alt is None:
                    alt = attrs.get("property")
            self.emit("open", tag, raw, val, alt, n, indent)
        if tag in VOID:
            if el.hit is not None:
                for which in self.lists_in_use:
                    if el.hit[which]:
                        self.spans[which].append((el.first, len(self.out)))
            return
        at = len(self.stack)
        self.stack.append(el)
        self.places.setdefault(tag, []).append(at)
        if tag in BLOCK:
            self.blocks.append(at)
        if tag in END_SCOPE:
            self.scopes.append(at)
        if tag in STATEFUL:
            if tag in LISTS:
                start = attrs.get("start", "")
                first_n = int(start) if re.fullmatch(r"[0-9]{1,18}", start) else 1
                # Step and next number; bullets stay at 0.
                self.lists.append([1, first_n] if tag == "ol" else [0, 0])
            elif tag == "blockquote":
                self.quote += 1
            elif tag == "table":
                # Rows closed, and cells of the current row.
                self.tables.append([0, 0])
            elif tag == "td" or tag == "th":
                self.cell += 1

    def end(self, tag, raw):
        if self.places.get(tag):
            at = self.places[tag][-1]
            # A stray inline end tag does not end the blocks opened after it, nor any a table cell.
            behind_block = tag not in BLOCK and self.blocks and self.blocks[-1] > at
            behind_cell = tag not in TABLE_PARTS and self.scopes and self.scopes[-1] > at
            if not behind_block and not behind_cell:
                return self.close_from(at, raw)
        if self.with_raw:
            self.emit("other", tag, raw)

    def text(self, source):
        val = unescape(source) if "&" in source else source
        # Outside pre, runs of blanks count as one.
        if not self.pre and ("\n" in val or "  " in val or "\t" in val or "\r" in val):
            val = _BLANKS.sub(" ", val)
        self.emit("text", "", source, val)

    def raw_text(self, tag, source):
        """Content of a raw-text element; only the title is of use outside the source itself."""
        if source and (self.with_raw or tag == "title"):
            self.emit(tag, "", source, _BLANKS.sub(" ", _text(source)) if tag == "title" else None)

    def scan(self, html):
        at = look = 0
        size, find, match, with_raw = len(html), html.find, _MARKUP.match, self.with_raw
        while at < size:
            begin = find("<", look)
            if begin < 0:
                self.text(html[at:])
                break
            markup = match(html, begin)
            if markup is None:
                if _START.match(html, begin):
                    # A tag that never ends: the rest is text.
                    self.text(html[at:])
                    break
                look = begin + 1
                continue
            if begin > at:
                self.text(html[at:begin])
            at = look = markup.end()
            ending, tag, attr_text = markup.groups()
            raw = html[begin:at] if with_raw else ""
            if tag is None:
                if with_raw:
                    self.emit("other", "", raw)
                continue
            tag = tag.lower()
            if ending:
                self.end(tag, raw)
                continue
            self.enter(tag, attr_text, raw)
            if tag in RAW_TEXT:
                closing = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                stop = closing.start() if closing else size
                self.raw_text(tag, html[at:stop])
                at = look = stop
        self.close_from(0)

    def keep(self):
        """Per event: inside an included span (or no list given) and inside no excluded one."""
        size = len(self.out)
        depth = []
        for spans in self.spans:
            steps = [0] * (size + 1)
            for first, stop in spans:
                steps[first] += 1
                steps[stop] -= 1
            depth.append(list(accumulate(steps[:-1])))
        if self.rules[1] is None:
            return [d == 0 for d in depth[0]]
        return [excluded == 0 < included for excluded, included in zip(*depth)]


# Events that metadata is read from.
HEAD_TAGS = frozenset(("html", "link", "meta"))
# A batch is turned into Arrow piece by piece, which bounds the Python objects alive at a time.
_EVENTS_PER_PIECE = 100_000


def _list_array(rows, keep, offsets):
    columns = [*zip(*rows), keep] if rows else [[] for _ in _FIELDS]
    columns = [pa.array(values, type=f[2]) for values, f in zip(columns, _FIELDS)]
    structs = pa.StructArray.from_arrays(columns, fields=[pa.field(f[0], f[2]) for f in _FIELDS])
    return pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), structs)


def scan_batch(pages, exclude, include, with_raw=False, wanted="all"):
    """Events of every page in an Arrow string array, as an Arrow list array.

    ``wanted`` is "all", "kept" for kept events only, or "head" for those of the metadata.
    """
    rules = Rules(exclude), Rules(include) if include else None
    pieces, rows, keep, offsets = [], [], [], [0]
    for html in pages:
        if html.is_valid:
            page = _Page(rules, with_raw)
            page.scan(html.as_py())
            found, flags = page.out, page.keep()
            if wanted == "kept":
                found = [row for row, flag in zip(found, flags) if flag]
                flags = [True] * len(found)
            elif wanted == "head":
                at = [i for i, row in enumerate(found) if row[0] == "title" or row[1] in HEAD_TAGS]
                found, flags = [found[i] for i in at], [flags[i] for i in at]
            rows += found
            keep += flags
        offsets.append(len(rows))
        if len(rows) >= _EVENTS_PER_PIECE:
            pieces.append(_list_array(rows, keep, offsets))
            rows, keep, offsets = [], [], [0]
    pieces.append(_list_array(rows, keep, offsets))
    return pa.concat_arrays(pieces)


def scan_pieces(batches, exclude, include, with_raw=False, wanted="all"):
    """As ``scan_batch`` for each piece of the batches, so a worker holds a batch and the events of one piece."""
    for pages in pieces(batches):
        yield scan_batch(pages, exclude, include, with_raw, wanted)


def html_events(
    html, exclude: tuple[Selector, ...], include: tuple[Selector, ...] = (), with_raw: bool = False, wanted: str = "all"
):
    """Events of an HTML column; ``raw`` source slices are filled only when asked for."""

    @F.arrow_udf(EVENTS_DDL)
    def events(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return scan_pieces(batches, exclude, include, with_raw, wanted)

    # Not deterministic for the optimizer's sake: it would copy the call into filters above it.
    return events.asNondeterministic()(html)
