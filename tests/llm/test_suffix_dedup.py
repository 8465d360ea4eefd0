import hashlib
import random

import pytest

from webcapture.llm.suffix_dedup import remove_repeats


def brute(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    places = {}
    for i, text in enumerate(raw):
        for j in range(len(text) - length + 1):
            places.setdefault(text[j : j + length], []).append((i, j))
    gone = [bytearray(len(t)) for t in raw]
    for found in places.values():
        if len(found) > 1:
            for i, j in found:
                gone[i][j : j + length] = b"\1" * length
    out = []
    for (doc, _), text, marks in zip(rows, raw, gone, strict=True):
        runs = sum(1 for j, m in enumerate(marks) if m and (j == 0 or not marks[j - 1]))
        out.append((doc, len(text), sum(marks), runs, hashlib.sha256(bytes(b for b, m in zip(text, marks, strict=True) if not m)).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **how):
    df = spark.createDataFrame([(*row, "x") for row in rows], "doc_id long, text string, h string")
    got = remove_repeats(df, **how).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got), key=str)


@pytest.mark.parametrize("most", [12_000, 2])
def test_against_brute_force(spark, most):
    rng = random.Random(most)
    pieces = ["".join(rng.choice("abcdé \n") for _ in range(rng.randint(5, 90))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(pieces)[rng.randint(0, 5) :] + rng.choice("xyzß") for _ in range(rng.randint(1, 6)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "short"), (103, "a" * 500), (104, "\0" * 90), (None, rows[0][1]), (7, rows[7][1]), (8, rows[9][1])]
    assert found(spark, rows, length=40, gram=12, most=most) == brute(rows, 40)


def test_empty_table(spark):
    assert found(spark, [], length=40, gram=12) == []
