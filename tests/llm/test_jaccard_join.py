import collections
import random
import re

import pytest

from webcapture.llm.components import components
from webcapture.llm.jaccard_join import jaccard_components


def brute(rows, k, num, den):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        whole = {tuple(words)} if words else set()
        sets.append({tuple(words[j : j + k]) for j in range(len(words) - k + 1)} if len(words) >= k else whole)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    seen = set()
    for found in holders.values():
        for a in found:
            for b in found:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    overlap = len(sets[a] & sets[b])
                    if den * overlap >= num * (len(sets[a]) + len(sets[b]) - overlap):
                        parent[max(root(a), root(b))] = min(root(a), root(b))
    low = {}
    for i, (doc, _) in enumerate(rows):
        known = [x for x in (low.get(root(i)), doc) if x is not None]
        low[root(i)] = min(known, default=None)
    return sorted(((d, len(sets[i]), low[root(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for _ in range(40):
        base = [rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.choice([1, 2, 3, 4, 5, 8, 12, 13, 18, 22, 30, 60, 120]))]
        for _ in range(rng.choice([1, 1, 3, 8, 25])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(words) + 1)
                if rng.random() < 0.5:
                    words.insert(at, rng.choice("xyzABC"))
                elif len(words) > 1:
                    words.pop(min(at, len(words) - 1))
            out.append((len(out), rng.choice([" ", "\n", "  "]).join(words)))
    out += [(5000, None), (5001, ""), (5002, " \n"), (None, "q w e r t y"), (None, "q w e r t y"), (3, "q w e r t y"), (4, out[4][1])]
    return [*out, (6000, "long " + "w v u " * 20000), (6001, "long " + "w v u " * 20000 + "x")]


@pytest.mark.parametrize("k,num", [(3, 90), (5, 80), (3, 50)])
def test_against_brute_force(spark, rows, k, num):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, cls int")
    got = sorted(map(tuple, jaccard_components(df, k=k, num=num, sketch_bits=12).collect()), key=str)
    assert got == brute(rows, k, num, 100)


def test_empty_table(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components_of_a_chain(spark):
    chain = spark.range(300).selectExpr("(id * 37) % 301 a", "((id + 1) * 37) % 301 b").union(spark.createDataFrame([(900, 901), (900, 900)], "a long, b long"))
    got = {r.node: r.component for r in components(chain).collect()}
    assert set(got.values()) == {0, 900} and len(got) == 301
