"""Search over captured text: lines, line ranges, outlines and keyword profiles.

Lines are counted from 1 and end at a line feed; a final line feed opens no further line.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcapture.functions.text import _col

#: Keywords without a special character from which on one automaton finds all of them in one pass.
MANY = 32
_SPECIAL = re.compile(r"[\\^$.|?*+()\[\]{}]|\A\Z")
_COUNTS = "array<struct<keyword: string, hits: int>>"


def _lines(text) -> Column:
    text = _col(text)
    body = F.when(text.endswith("\n"), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    # Blank text has no line at all.
    return F.when(text != "", F.split(body, "\n", -1))


def text_lines(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One row per line: ``key, line_no, line``."""
    exploded = df.select(key, F.posexplode(_lines(text)).alias("_pos", "line"))
    return exploded.select(key, (F.col("_pos") + 1).alias("line_no"), "line")


def grep_lines(df: DataFrame, pattern: str, key: str, text: str = "text") -> DataFrame:
    """Lines that match a regular expression; only those become rows."""
    numbered = F.transform(_lines(text), lambda line, i: F.struct((i + 1).alias("line_no"), line.alias("line")))
    hits = df.select(key, F.explode(F.filter(numbered, lambda x: x["line"].rlike(pattern))).alias("_hit"))
    return hits.select(key, "_hit.line_no", "_hit.line")


def read_lines(df: DataFrame, start: int, end: int, key: str, text: str = "text") -> DataFrame:
    """Lines ``start`` to ``end``, both included; a range past the end gives what exists.

    The range is cut from the array of lines before it is exploded.
    """
    start = max(start, 1)
    if end < start:
        return text_lines(df, key, text).filter(F.lit(False))
    wanted = F.slice(_lines(text), start, end - start + 1)
    exploded = df.select(key, F.posexplode(wanted).alias("_pos", "line"))
    return exploded.select(key, (F.col("_pos") + start).alias("line_no"), "line")


def outline(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One row per document: size in characters, lines, and headings as ``(line_no, level, title)``."""
    heads = F.filter(
        F.transform(
            _lines(text),
            lambda line, i: F.struct(
                (i + 1).cast("int").alias("line_no"),
                F.length(F.regexp_extract(line, r"\A(#{1,6})\s", 1)).alias("level"),
                line.alias("title"),
            ),
        ),
        lambda h: h["level"] > 0,
    )
    titled = F.transform(
        heads,
        lambda h: F.struct(
            h["line_no"], h["level"], F.trim(F.regexp_replace(h["title"], r"\A#{1,6}\s+", "")).alias("title")
        ),
    )
    return df.select(
        key,
        F.length(text).alias("n_chars"),
        F.coalesce(F.size(_lines(text)), F.lit(0)).alias("n_lines"),
        F.coalesce(titled, F.array().cast("array<struct<line_no:int,level:int,title:string>>")).alias("headings"),
    )


def _found(shared) -> Callable:
    """Counts of each literal keyword in each text: places that do not overlap, from the left."""

    def find(batches):
        import ahocorasick

        given = Counter(shared.value)
        automaton = ahocorasick.Automaton()
        for k, word in enumerate(given):
            automaton.add_word(word, (k, len(word)))
        automaton.make_automaton()
        words, times = list(given), list(given.values())
        for batch in batches:
            rows = []
            for text in batch.column("_text").to_pylist():
                counts: dict[int, int] = {}
                free: dict[int, int] = {}
                for last, (k, size) in automaton.iter(text or ""):
                    if last - size >= free.get(k, -1):
                        counts[k], free[k] = counts.get(k, 0) + 1, last
                rows.append([{"keyword": words[k], "hits": hits} for k, hits in counts.items() for _ in range(times[k])])
            kind = pa.list_(pa.struct([("keyword", pa.string()), ("hits", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)], names=[*batch.schema.names, "_found"])

    return find


def _keyword_counts(df: DataFrame, keywords, key: str, text: str) -> DataFrame:
    """``key`` and ``_counts``: of each document the keywords found, and how often.

    Keywords are regular expressions. Many literal ones become one automaton, built once per task, so that the
    plan does not grow with them and each text is read once; the others stay Column expressions.
    """
    literal = [k for k in keywords if not _SPECIAL.search(k)]
    if len(literal) < MANY:
        literal = []
    apart = [k for k in keywords if not literal or _SPECIAL.search(k)]
    rows, found = df.select(key, F.col(text).alias("_text")), F.array().cast(_COUNTS)
    if literal:
        shared = df.sparkSession.sparkContext.broadcast(literal)
        schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema)
        rows, found = rows.mapInArrow(_found(shared), f"{schema}, _found {_COUNTS}"), F.col("_found")
    counted = [F.struct(F.lit(k).alias("keyword"), F.regexp_count("_text", F.lit(k)).alias("hits")) for k in apart]
    every = F.concat(found, F.filter(F.array(*counted), lambda c: c["hits"] > 0)) if counted else found
    return rows.select(F.col(rows.columns[0]), every.alias("_counts"))


def keyword_hits(df: DataFrame, keywords, key: str, text: str = "text") -> DataFrame:
    """Hits of each keyword pattern per document, documents without a hit left out.

    A keyword given twice has two rows; null text has no hits. Any number of literal keywords may be given.
    """
    rows = _keyword_counts(df, keywords, key, text)
    each = rows.select(F.col(rows.columns[0]), F.explode("_counts").alias("c"))
    return each.select(F.col(rows.columns[0]), "c.keyword", "c.hits")


def keyword_ranking(df: DataFrame, keywords, key: str, text: str = "text") -> DataFrame:
    """Documents with any hit, total hits and number of keywords found, best first."""
    rows = _keyword_counts(df, keywords, key, text)
    id_col = rows.columns[0]

    def totals(found):
        return F.struct(F.aggregate(found, F.lit(0), lambda a, c: a + c["hits"]).alias("hits"), F.size(found).alias("n_keywords"))

    # Exploded, so that the filter and the sums share one run of the patterns.
    ranked = rows.select(id_col, F.explode(F.transform(F.array("_counts"), totals)).alias("_t")).select(id_col, "_t.hits", "_t.n_keywords")
    return ranked.filter("hits > 0").orderBy(F.col("hits").desc(), F.col(id_col))
