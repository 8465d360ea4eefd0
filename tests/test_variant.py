import json
import random

import pytest
from pyspark.sql import functions as F

from webcapture.functions.variant import boolean_false, error_reason, is_object, parse_body, pick, string_only, truthy


def body(c="c"):
    return parse_body(c)


def loads(text):
    try:
        return json.loads(text)
    except (TypeError, ValueError):
        return "bad"


def test_parse_body_takes_whole_values_only(column):
    rng = random.Random(3)
    parts = ['{"a":1}', "[1]", "[[2]]", "]", "}", ",", " ", "null", "1", '"x"', '{"b":[[3]]}', "]]", "junk", ":"]
    values = ["".join(rng.choice(parts) for _ in range(rng.randrange(6))) for _ in range(1500)] + [None]
    got = column(values, F.to_json(body()))
    want = [loads(v) for v in values]
    assert [g is None for g in got] == [w == "bad" for w in want]
    assert all(json.loads(g) == w for g, w in zip(got, want) if g is not None)


def test_pick(column):
    values = ['{"a":{"b":5}}', '{"a":5}', '{"a":{"b":null}}', "{}", "[1]", None, '{"a":{"b":"x"}}']
    assert column(values, pick(body(), "a", "b")) == ["5", None, None, None, None, None, "x"]
    assert column(values, pick(body(), "a", "b", default="d")) == ["5", "d", None, "d", "d", "d", "x"]
    assert column(['{"it\'s":1}'], pick(body(), "it's")) == ["1"]


@pytest.mark.parametrize("value", [None, False, 0, 0.0, "", [], {}, True, 1, -2.5, "0", " ", [0], {"a": None}, 1e-9])
def test_truthy_is_python_truth(column, value):
    assert column([json.dumps({"error": value})], truthy(body(), "error")) == [bool(value)]


def test_typed_tests(column):
    values = ['{"s":"x"}', '{"s":false}', '{"s":{}}', '{"s":"false"}', "{}", '{"s":[]}']
    assert column(values, string_only(body(), "s")) == ["x", None, None, "false", None, None]
    assert column(values, boolean_false(body(), "s")) == [False, True, False, False, False, False]
    assert column(values, is_object(body(), "s")) == [False, False, True, False, False, False]


def test_error_reason(column):
    deep = {"message": "deep"}
    for _ in range(30):
        deep = {"upstream": deep}
    cases = [
        ({"message": "m", "error": "e"}, "m"),
        ({"message": None, "error": "e"}, "e"),
        ({"error": True}, "true"),
        ({"message": 5}, "5"),
        ({"upstream": {"error": "inner"}}, "inner"),
        ({"upstream": [{"error": "x"}]}, "unknown error"),
        ({"upstream": {}}, "unknown error"),
        ({}, "unknown error"),
        (deep, "deep"),
    ]
    assert column([json.dumps(c) for c, _ in cases], error_reason(body())) == [w for _, w in cases]
