import random
import re
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from webcapture.functions.recency import recency_code, recency_error
from webcapture.functions.text import (
    export_path,
    percent_decode,
    repair_newlines,
    stable_unique,
    strip,
    strip_base64_images,
    text_window,
    to_compact_json,
)


def soup(alphabet, n, size, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(size))) for _ in range(n)]


def test_percent_decode_is_unquote(column):
    values = soup(["%", "2", "0", "C3", "%C3%A9", "%E4%BD%A0", "é", "a", "+", "\\n", "z", "%%"], 400, 12)
    # Runs of broken UTF-8 may give another number of replacement characters.
    values = [v for v in values if "\ufffd" not in unquote(v)] + ["hello%20world%21", "a%20b%zz+100%", "", None]
    assert column(values, percent_decode("c")) == [None if v is None else unquote(v) for v in values]


def test_percent_decode_strict(column):
    values = ["a%20b", "a%20b%zz", "50%", "a+b%2B", "%e4%bd%a0", None]
    assert column(values, percent_decode("c", strict=True)) == ["a b", "a%20b%zz", "50%", "a+b+", "你", None]


def test_repair_newlines(column):
    assert column([r"a\nb\\n", "a\nb", None], repair_newlines("c")) == ["a\nb\\\n", "a\nb", None]


@pytest.mark.parametrize(
    "size,start", [(5, 0), (5, 6), (5, -1), (0, 3), (-1, 3), (None, 3), (99, 0), (3, 40), (2**40, 2**40), (2, None), ("5", 1)]
)
def test_text_window_is_slicing(column, size, start):
    values = ["hello world", "", "a😀b😀c", None]
    begin = start if isinstance(start, int) and start >= 0 else 0
    whole = not isinstance(size, int) or size <= 0
    want = [v if v is None or whole else v[begin : begin + size] for v in values]
    assert column(values, text_window("c", size, start)) == want


def test_text_window_columns(spark):
    df = spark.createDataFrame([("abcdef", 3, 1), ("abcdef", None, 1), ("abcdef", 2, -4)], "t string, n int, s int")
    got = [r.x for r in df.select(text_window("t", F.col("n"), F.col("s")).alias("x")).collect()]
    assert got == ["bcd", "abcdef", "ab"]


def test_strip_is_python_strip(column):
    values = soup([" ", "\t", "\n", "\u3000", "\u00a0", "\u2003", "\x1f", "\x85", "a", "b c", "\u200b"], 300, 9)
    assert column(values, strip("c")) == [v.strip() for v in values]


def test_strip_base64_images(column):
    values = [
        "![a](data:image/png;base64,iVBORw0KGgo=) t",
        "![a](data:image/svg+xml;charset=utf-8;base64,AAAA)",
        "data:text/plain;base64,AAAA stays",
        "x" * 1000 + "data:image/" * 50,
    ]
    assert column(values, strip_base64_images("c")) == ["![a]() t", "![a]()", values[2], values[3]]


def test_stable_unique(column):
    values = [" ".join(v) for v in soup("abcde", 50, 20)]
    got = column(values, F.array_join(stable_unique(F.split("c", " ")), " "))
    assert got == [" ".join(dict.fromkeys(v.split(" "))) for v in values]


def test_compact_json_keeps_nulls(spark):
    row = spark.range(1).select(to_compact_json(F.struct(F.lit("é<&>").alias("a"), F.lit(None).cast("int").alias("b"))).alias("x"))
    assert row.first().x == '{"a":"é<&>","b":null}'


@pytest.mark.parametrize(
    "name,directory,want",
    [
        ("article", ".", "article.md"),
        (" a/b/c ", "", "c.md"),
        ("x.MD", "out", "out/x.MD"),
        ("dir/x/", "./out//deep/", "out/deep/x.md"),
        ("x", "/abs", "/abs/x.md"),
        ("x", " ", "x.md"),
        ("a.md.txt", "./././o", "o/a.md.txt.md"),
    ],
)
def test_export_path(column, name, directory, want):
    assert column([name], export_path("c", directory)) == [want]


# The wording of the phrases this follows, matched with Python's own idea of words.
UNITS = [
    ("qdr:y", r"\b(?:y|yr|yrs|year|years)\b|年|last\s+year|past\s+year|\d+\s*y\b"),
    ("qdr:m", r"\b(?:mo|mos|month|months)\b|月|last\s+month|past\s+month|\d+\s*mo\b"),
    ("qdr:w", r"\b(?:w|wk|wks|week|weeks)\b|周|星期|last\s+week|past\s+week|\d+\s*w\b"),
    ("qdr:d", r"\b(?:d|day|days)\b|天|日|daily|last\s+day|past\s+day|\d+\s*d\b"),
    ("qdr:h", r"\b(?:h|hr|hrs|hour|hours)\b|小时|past\s+hour|last\s+hour|\d+\s*h\b"),
]


def code_of(text):
    text = (text or "").strip().lower()
    if text.startswith("qdr:"):
        return text if text in [c for c, _ in UNITS] else None
    return next((code for code, pattern in UNITS if re.search(pattern, text, re.I)), None)


def test_recency_code_against_python(column):
    parts = ["year", "years", "Yr", "y", "mo", "months", "week", "WK", "d", "day", "daily", "hour", "h", "24", "7", "２", "_", " ",
             "\u3000", "last ", "past  ", "年", "月", "周", "星期", "天", "日", "小时", "最近", "过去", "é", "ly", "qdr:", "-"]
    values = soup(parts, 1500, 5) + ["qdr:h", "QDR:D", "qdr:z", "", None, "24h", "过去24h内", "过去7天", "last yearly", "someday"]
    assert column(values, recency_code("c")) == [code_of(v) for v in values]


def test_recency_strict(column):
    values = [" Hour", "day", "weeks", "", None]
    assert column(values, recency_code("c", strict=True)) == ["qdr:h", "qdr:d", None, None, None]
    assert [e is not None for e in column(values, recency_error("c"))] == [False, False, True, False, False]
