"""The divergence audit against sums written out term by term."""

import random
import re
from collections import Counter

import numpy as np
from webcapture.llm import divergence as audit


def plain(docs, least, top=50):
    words = [(r[0] or "", r[1] or "", re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (r[2] or "").encode()))) for r in docs]
    found = []
    for lang in {w[0] for w in words}:
        own = [w for w in words if w[0] == lang]
        seen = Counter(t for w in own for t in set(w[2]))
        kept = sorted(t for t, n in seen.items() if n >= least)
        counts = {s: Counter(t for w in own if w[1] == s for t in w[2] if t in set(kept)) for s in {w[1] for w in own}}
        share = lambda c, v=len(kept): {t: 1 + 10**9 * (c[t] + 5) // (c.total() + 5 * v) for t in kept}
        whole, each = share(sum(counts.values(), Counter())), {s: share(c) for s, c in counts.items()}
        for s, p in each.items():
            far = sorted((-sum(abs(p[t] - q[t]) for t in kept), o.encode()) for o, q in each.items() if o != s)
            more = sorted((whole[t] - p[t], t) for t in kept if counts[s][t] and p[t] > whole[t])
            for part, items in (("pair", far), ("term", more[:top])):
                found += [(lang, s, part, item.decode(), -value, n + 1) for n, (value, item) in enumerate(items)]
    return sorted(found)


def test_divergence(spark):
    rng = random.Random(3)
    vocabulary = [f"{c}{d}é"[: 2 + (k % 2)] for k, (c, d) in enumerate((c, d) for c in "abcdefghijkl" for d in "mnopq")]
    docs = [(rng.choice(["en", "de"]), f"s{int(rng.random() ** 2 * 13)}", " ".join(rng.choices(vocabulary, k=rng.randrange(40)))) for _ in range(300)]
    docs += [(None, None, "Alone WORDS"), ("en", "none", None), ("en", "none", ""), ("fr", "a", "zu selten"), ("fr", "b", None), ("en", "s1", "AM an;am_1 am " * 9000)] + docs[:5] * 3
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "lang string, source string, text string, term string, rank int")
    for side in (8, 16, 256):
        got = sorted(map(tuple, audit.divergence(df, least_docs=12, side=side, top_terms=20).select("lang", "source", "part", "item", "value", "rank").collect()))
        assert got == plain(docs, 12, 20)
    assert audit.divergence(df.limit(0)).collect() == []


def test_long_texts_are_tallied_in_pieces(monkeypatch):
    monkeypatch.setattr(audit, "WORD_BYTES", 64)
    data = np.frombuffer(b"one two three " * 100 + b"x" * 300, np.uint8)
    parts = list(audit._pieces(data, np.array([0, len(data)])))
    assert len(parts) > 5 and b"".join(p.tobytes() for p, _ in parts) == data.tobytes()
    assert all(len(p) == o[-1] for p, o in parts)


def test_quadtrees_price_what_is_empty():
    rng = np.random.default_rng(1)
    for rows_a, rows_b, width in ((16, 16, 16), (3, 14, 11), (1, 1, 2)):
        zero_a, zero_b = rng.integers(0, 50, rows_a), rng.integers(0, 50, rows_b)
        dense = []
        for zero in (zero_a, zero_b):
            has = (rng.random((16, 16)) < 0.1) & (np.arange(16)[:, None] < len(zero)) & (np.arange(16) < width)
            full = np.zeros((16, 16), np.int64)
            full[: len(zero)] = zero[:, None]
            dense += [np.where(has, rng.integers(0, 1000, (16, 16)), full), has]
        a, has_a, b, has_b = dense
        want = np.abs(a[:rows_a, None, :width] - b[None, :rows_b, :width]).sum(axis=2)
        assert (audit.joint(a, b, has_a, has_b, zero_a, zero_b, width, leaf=2) == want).all()
