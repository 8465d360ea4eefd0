"""Toxicity by compression: windows, lengths, what is learned, and texts of every odd kind."""

import random
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from webcapture.llm import toxicity as tox
from webcapture.llm.common import utf8

SYLLABLES = [a + b for a in ("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha") for b in ("a", "e", "i", "o", "u")]


def prose(rng, words, rude=0.0):
    say = lambda: rng.choice(["blockhead", "numbskull", "dimwit", "scoundrel"]) if rng.random() < rude else "".join(rng.choices(SYLLABLES, k=rng.randrange(1, 4)))
    return " ".join(say() for _ in range(words))


def tables(spark, n):
    rng = random.Random(11)
    toxic = [rng.random() < 0.3 for _ in range(n)]
    docs = [(i, prose(rng, rng.randrange(20, 200), 0.08 * t), "x") for i, t in enumerate(toxic)]
    docs += [(n, None, ""), (n + 1, "", ""), (None, "no id", ""), (3, "again", ""), (n + 2, prose(rng, 60000), ""), (n + 3, "ab" * 300000, ""), (n + 4, "you blockhead numbskull dimwit " * 20, "")]
    labels = [(i, int(t), 0) for i, t in enumerate(toxic) if i % 2] + [(None, 1, 0), (5, None, 0), (10**9, 1, 0)]
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int, text int"), toxic


def test_toxic_texts_are_told_apart(spark):
    docs, labels, toxic = tables(spark, 1600)
    rows = tox.toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 1600]
    assert np.mean([r.predicted == toxic[r.doc_id] for r in held]) > 0.9
    own = {r.doc_id: r for r in rows}
    assert own[1604].predicted == 1 and own[1602].predicted == 0 and own[1600].score == own[1601].score
    assert sorted(map(tuple, tox.toxicity(docs.repartition(7), labels).collect()), key=str) == sorted(map(tuple, rows), key=str)


def test_little_to_learn_from(spark):
    docs, labels, _ = tables(spark, 10)
    assert {r.score for r in tox.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert {r.score for r in tox.toxicity(docs, labels.filter("toxic = 1")).collect()} == {1.0}
    assert tox.toxicity(docs.limit(0), labels).collect() == []
    assert len(tox.toxicity(docs, labels).collect()) == docs.count()


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs, labels, _ = tables(spark, 300)
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    assert sorted(map(str, tox.toxicity(docs, labels).collect())) == sorted(map(str, tox.toxicity(docs, turned).collect()))


def test_windows_are_the_text():
    texts = ["", "one two  three", "x" * 50, None, "a " * 30, "wordlongerthanten and", " "]
    data, offsets = utf8(pa.array(texts))
    starts, ends, first = tox.windows(data, offsets, 10)
    for k, text in enumerate(texts):
        own = [data[a:b].tobytes().decode() for a, b in zip(starts[first[k] : first[k + 1]], ends[first[k] : first[k + 1]], strict=True)]
        assert "".join(own) == (text or "") and all(0 < len(w) <= 20 for w in own)


def test_lengths_are_those_of_the_library():
    rng = random.Random(2)
    text = prose(rng, 400).encode()
    data = np.frombuffer(text, np.uint8)
    starts = np.arange(0, len(data) - 64, 64)
    compressor = tox._compressor(text[:500])
    got = tox.lengths(compressor, data, starts, starts + 64)
    assert got.tolist() == [len(compressor.compress(text[a : a + 64])) for a in starts]
    assert isinstance(compressor, zstandard.ZstdCompressor)
