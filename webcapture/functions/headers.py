"""Header text and header records to maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webcapture.functions.text import _col, bind, strip
from webcapture.functions.variant import _path, is_object, parse_body, string_only

# The characters of a header name, and the methods that begin a request line.
_TOKEN = r"\A[A-Za-z0-9!#$%&'*+\-.^_`|~]+\z"
_START = r"\A(?:HTTP/|(?:CONNECT|DELETE|GET|HEAD|OPTIONS|PATCH|POST|PUT|TRACE) )"


def _last_wins(entries: Column) -> Column:
    """Array of (name, at, value) to a map. Of entries with one name, the one with the largest place counts."""

    def kept(rows):
        last = F.filter(rows, lambda row, i: (i == F.size(rows) - 1) | (F.get(rows, i + 1)["name"] != row["name"]))
        return F.map_from_entries(F.transform(last, lambda row: F.struct(row["name"], row["value"])))

    return bind(F.sort_array(entries), kept)


def merge_headers(base, override) -> Column:
    """Right side wins per key; keys are case-sensitive. Entries are sorted, so the time is that of a sort."""
    empty = F.create_map().cast("map<string,string>")

    def merged(both):
        def entries(side, at):
            pairs = F.map_entries(F.coalesce(both[side], empty))
            return F.transform(pairs, lambda e: F.struct(e["key"].alias("name"), F.lit(at).alias("at"), e["value"].alias("value")))

        given = both["left"].isNotNull() | both["right"].isNotNull()
        return F.when(given, _last_wins(F.concat(entries("left", 0), entries("right", 1))))

    return bind(F.struct(_col(base).alias("left"), _col(override).alias("right")), merged)


def _line(line: Column) -> Column:
    """What a header line is by itself, and its name and value."""
    bare, colon = strip(line), F.instr(line, ":")
    name = strip(F.substring_index(line, ":", 1))
    kind = (
        F.when(bare == "", "blank")
        .when(bare.rlike(_START), "start")
        .when(bare.startswith(":"), "pseudo")
        .when((colon > 0) & name.rlike(_TOKEN), "header")
        .otherwise("bad")
    )
    return F.struct(
        kind.alias("kind"),
        line.rlike(r"\A[ \t]").alias("indented"),
        bare.alias("bare"),
        name.alias("name"),
        strip(F.substring(line, colon + 1, F.length(line))).alias("value"),
    )


def _runs(rows: Column, begins, of) -> Column:
    """``of`` applied to each stretch of ``rows`` that begins where ``begins(row, place)`` holds."""

    def cut(places):
        def run(begin, k):
            return bind(F.slice(rows, begin + 1, F.coalesce(F.get(places, k + 1), F.size(rows)) - begin), lambda r: of(r, k))

        return F.transform(places, run)

    return bind(F.array_compact(F.transform(rows, lambda row, i: F.when(begins(row, i), i))), cut)


def _header(lines: Column, at: Column) -> Column:
    """The one header of a line and the indented lines after it.

    All lines after the first that can be a header continue it. Its text is what it adds to the value of its
    name: ``, `` and its own value unless that is empty, then each continuation after a blank.
    """

    def found(both):
        run, first = both["run"], both["first"]
        head = F.get(run, first - 1)
        before = F.slice(run, 1, F.when(first == 0, F.size(run)).otherwise(first - 1))
        tail = F.transform(F.slice(run, first + 1, F.size(run)), lambda x: F.concat(F.lit(" "), x["bare"]))
        own = F.when(head["value"] == "", "").otherwise(F.concat(F.lit(", "), head["value"]))
        return F.struct(
            head["name"].alias("name"),
            at.alias("at"),
            F.concat(own, F.array_join(tail, "")).alias("value"),
            F.exists(before, lambda x: x["kind"] == "bad").alias("bad"),
        )

    first = F.array_position(F.transform(lines, lambda x: x["kind"]), "header").cast("int")
    return bind(F.struct(lines.alias("run"), first.alias("first")), found)


def _joined(headers: Column) -> Column:
    """Headers sorted by name and place to a map: what they add is put together, without the first separator."""

    def value(run, _):
        text = F.array_join(F.transform(run, lambda x: x["value"]), "")
        bare = bind(text, lambda t: F.when(t.startswith(", "), F.substring(t, 3, F.length(t))).otherwise(F.substring(t, 2, F.length(t))))
        return F.struct(F.get(run, 0)["name"].alias("name"), bare.alias("value"))

    def grouped(rows):
        return F.map_from_entries(_runs(rows, lambda row, i: (i == 0) | (F.get(rows, i - 1)["name"] != row["name"]), value))

    return bind(F.sort_array(headers), grouped)


def parse_header_block(c) -> Column:
    """HTTP header text to a map; null when any line is bad or no header is left.

    Start lines and ``:pseudo`` lines are skipped, continuation lines folded, repeats joined. Lines are cut into
    runs of one header each, runs sorted by name: a block of n lines takes the time of sorting them.
    """
    text = strip(c)

    def parsed(lines):
        def blocks(rows):
            return _runs(rows, lambda row, i: (i == 0) | ~row["indented"], _header)

        def checked(headers):
            named = F.filter(headers, lambda h: h["name"].isNotNull())
            good = ~F.exists(headers, lambda h: h["bad"])
            return F.when(good & F.exists(headers, lambda h: h["name"].isNotNull()), _joined(named))

        # Blank lines and start lines change nothing, unless a start line is indented and continues a header.
        telling = F.filter(lines, lambda x: (x["kind"] != "blank") & (x["indented"] | (x["kind"] != "start")))
        bad = F.exists(lines, lambda x: ~x["indented"] & (x["kind"] == "bad"))
        return F.when(~bad, bind(bind(telling, blocks), checked))

    return F.when(text != "", bind(F.transform(F.split(text, r"\r*\n"), _line), parsed))


# Members that mark an array of cookies rather than of headers.
_COOKIE_KEYS = (
    "domain", "expirationDate", "hostOnly", "httpOnly", "path", "sameSite", "secure", "session", "storeId",
)


def _records(items: Column) -> Column:
    """Array of {name, value} objects to a map; the last repeat of a name wins."""

    def merged(pairs):
        good = F.forall(
            pairs, lambda p: F.coalesce(p["name"].rlike(_TOKEN) & p["value"].isNotNull(), F.lit(False))
        )
        return F.when((F.size(pairs) > 0) & good, _last_wins(pairs))

    def pair(x, i):
        return F.struct(
            strip(string_only(x, "name")).alias("name"), i.alias("at"), string_only(x, "value").alias("value")
        )

    return bind(F.transform(items, pair), merged)


def parse_header_json(c) -> Column:
    """JSON headers to a map: a plain object of strings, ``{"headers": [...]}`` or a bare array of
    ``{name, value}`` records. Anything else, cookie exports included, gives null."""

    def as_headers(v):
        members = F.try_variant_get(v, "$", "map<string,variant>")
        all_strings = F.forall(F.map_values(members), lambda x: F.schema_of_variant(x) == "STRING")
        plain = F.transform_values(members, lambda _, x: F.try_variant_get(x, "$", "string"))
        bare = F.try_variant_get(v, "$", "array<variant>")
        cookies = F.exists(
            bare,
            lambda x: F.greatest(
                *[F.try_variant_get(x, _path([k]), "variant").isNotNull() for k in _COOKIE_KEYS]
            ),
        )
        return (
            F.when(is_object(v) & all_strings, plain)
            .when(is_object(v), _records(F.try_variant_get(v, "$.headers", "array<variant>")))
            .when(bare.isNotNull() & ~cookies, _records(bare))
            .otherwise(F.lit(None).cast("map<string,string>"))
        )

    return bind(parse_body(strip(c)), as_headers)


def parse_headers(c) -> Column:
    """Header text in either form; text that starts with a brace or bracket is JSON."""
    return F.when(strip(c).rlike(r"\A[{\[]"), parse_header_json(c)).otherwise(parse_header_block(c))
