import json
import random
import re

from webcapture.functions.headers import merge_headers, parse_header_block, parse_header_json, parse_headers
from pyspark.sql import functions as F


def test_header_block(column):
    cases = [
        ("HTTP/1.1 200 OK\r\nA: 1\r\nB:2\r\n", {"A": "1", "B": "2"}),
        ("GET / HTTP/1.1\nHost: x:80", {"Host": "x:80"}),
        (":authority: x\nA: 1\n  more\n\tyet", {"A": "1 more yet"}),
        ("A: 1\nA: 2\nA:\na: 3", {"A": "1, 2", "a": "3"}),
        ("A:\nA: 2", {"A": "2"}),
        ("A: 1\n:p: q\n B: 2", {"A": "1", "B": "2"}),
        ("A: 1\nGET /x\n more", {"A": "1 more"}),
        ("A: 1\n\n\nB: 2", {"A": "1", "B": "2"}),
        ("A 1", None),
        ("A: 1\nbad name: 2", None),
        ("Ä: 1", None),
        ("HTTP/1.1 200 OK", None),
        ("  ", None),
        (None, None),
    ]
    assert column([c for c, _ in cases], parse_header_block("c")) == [w for _, w in cases]


def test_header_json(column):
    cases = [
        ({"headers": [{"name": " A ", "value": "1"}, {"name": "B", "value": ""}]}, {"A": "1", "B": ""}),
        ([{"name": "A", "value": "1"}, {"name": "A", "value": "2", "extra": 1}], {"A": "2"}),
        ({"A": "1", "b c": "2"}, {"A": "1", "b c": "2"}),
        ({}, {}),
        ({"A": 1}, None),
        ({"headers": []}, None),
        ({"headers": [{"name": "A"}]}, None),
        ({"headers": [{"name": "a b", "value": "1"}]}, None),
        ({"headers": {"A": "1"}}, None),
        ({"cookies": [{"name": "A", "value": "1"}]}, None),
        ([{"name": "A", "value": "1", "domain": "x"}], None),
        ([1], None),
        ([], None),
    ]
    assert column([json.dumps(c) for c, _ in cases], parse_header_json("c")) == [w for _, w in cases]
    assert column(["{bad", "", None], parse_header_json("c")) == [None, None, None]


def test_merge_and_dispatch(column):
    base = parse_headers(F.lit("A: 1\nb: 2"))
    got = column(['{"A":"x","B":"y"}', "B: z", "", None], merge_headers(base, parse_headers("c")))
    kept = {"A": "1", "b": "2"}
    assert got == [{"A": "x", "b": "2", "B": "y"}, {**kept, "B": "z"}, kept, kept]
    assert column(["", None], merge_headers(parse_headers("c"), parse_headers("c"))) == [None, None]


def plain_fold(text):
    """The header block line by line, as its rules read."""
    found, last = {}, ""
    for line in re.split(r"\r*\n", text.strip()):
        bare, (name, colon, value) = line.strip(), line.partition(":")
        name, value = name.strip(), value.strip()
        if not bare:
            continue
        if line[0] in " \t" and last:
            found[last] = f"{found[last]} {bare}".strip()
        elif bare.startswith(("GET ", "HTTP/")):
            continue
        elif bare.startswith(":"):
            last = ""
        elif colon and re.fullmatch(r"[A-Za-z-]+", name):
            old, last = found.get(name, ""), name
            found[name] = f"{old}, {value}" if old and value else old or value
        else:
            return None
    return found or None


def test_header_block_against_plain_fold(column):
    rng = random.Random(5)
    lines = ["A: 1", "A:", "A: , x", "B:2", "B:", "a: 3", "C-D:  v w ", "", "  ", "HTTP/1.1 200", " GET / x", ":p: q", " :i: j", " E: 4", "\tmore", " A: 5", " , z"]
    blocks = ["\n".join(rng.choice(lines) for _ in range(rng.randint(1, 12))) for _ in range(1500)]
    blocks += [b + rng.choice(["\nbad", "\n bad", "\r\nb c: 1", "\n\tx"]) for b in blocks[:500]]
    got = column(blocks, parse_header_block("c"))
    assert got == [plain_fold(b) for b in blocks]
    assert sum(g is None for g in got) > 50


def test_long_headers_are_linear(spark):
    """20,000 headers of one block, of one record list, and both merged, within the time of a few sorts."""
    n = 20_000
    block = "\n".join(f"N{i * 7919 % n}: v{i}\n more" if i % 3 == 0 else f"S{i % 50}: {i}" for i in range(n))
    records = json.dumps({"headers": [{"name": f"N{i * 7 % n}", "value": str(i)} for i in range(n)]})
    df = spark.createDataFrame([(block, records)], "b string, j string")
    row = df.select(
        parse_header_block("b").alias("block"), parse_header_json("j").alias("json"),
        merge_headers(parse_header_block("b"), parse_header_json("j")).alias("merged"),
    ).first()
    assert len(row.block) == len(range(0, n, 3)) + 50
    assert row.block["S1"] == ", ".join(str(i) for i in range(1, n, 50) if i % 3)
    assert row.json == {f"N{i * 7 % n}": str(i) for i in range(n)}
    assert row.merged == {**row.block, **row.json}
