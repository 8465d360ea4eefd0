"""Registered queries without SQL, as they are registered, against plain versions on the smallest tables."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq

import __spark_entry__ as entry
import corpus_pipeline
from webcapture.llm.packing import best_fit, bins
from webcapture.llm.token_words import tokenizer

SF = "/root/testdata/sf0.001"


def documents():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


def encoded(name, texts):
    found = tokenizer(public_tokenizers.path(name)).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [e.ids for e in found]


def test_token_counts_as_registered(spark):
    docs = documents()
    got = sorted(map(tuple, entry.queries()["op4_token_counts"](spark, SF).collect()))
    counts = [len(ids) for ids in encoded("byte_bpe_50k.json", [d["text"] for d in docs])]
    assert got == sorted((d["doc_id"], len((d["text"] or "").encode()), n, n > 1024) for d, n in zip(docs, counts, strict=True))


def test_languages_as_registered(spark):
    docs = {d["doc_id"]: d for d in documents()}
    got = {r.doc_id: r for r in entry.queries()["op3_langid"](spark, SF).collect()}
    assert set(got) == set(docs)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())
    held = [i for i, r in got.items() if r.held_out and docs[i]["lang"]]

    def grams(text):
        text = "".join(c if c.isalpha() else " " for c in (text or "").lower())
        return Counter(text[k : k + n] for n in (1, 2, 3) for k in range(len(text) - n + 1))

    whole = {}
    for i, d in docs.items():
        if not got[i].held_out and d["lang"]:
            whole.setdefault(d["lang"], Counter()).update(grams(d["text"]))
    logs = {lang: ({g: np.log((n + 0.5) / c.total()) for g, n in c.items()}, np.log(0.5 / c.total())) for lang, c in whole.items()}
    plain = {i: max(logs, key=lambda lang: sum(n * logs[lang][0].get(g, logs[lang][1]) for g, n in own.items())) for i in held for own in [grams(docs[i]["text"])]}
    assert sum(got[i].lang_pred == docs[i]["lang"] for i in held) >= sum(plain[i] == docs[i]["lang"] for i in held) - len(held) // 50


def placed(rows, capacity):
    """Pieces of each document, once sequences are seen to be without gaps and not longer than the capacity."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), len(sequences)


def pieces(docs, capacity):
    found = Counter()
    for (doc, _), tokens in zip(docs, encoded("word_bpe_49k.json", [t for _, t in docs]), strict=True):
        ids = [*tokens, 0]
        found.update((doc, k // capacity, k, len(ids[k : k + capacity]), zlib.crc32(np.array(ids[k : k + capacity], "<u4").tobytes())) for k in range(0, len(ids), capacity))
    return found


def test_packing_as_registered(spark):
    got, sequences = placed(entry.queries()["op7_packing"](spark, SF).collect(), 2048)
    assert got == pieces([(d["doc_id"], d["text"]) for d in documents()], 2048)
    lengths = Counter(p[3] for p in got.elements())
    assert -(-sum(n * c for n, c in lengths.items()) // 2048) <= sequences <= bins(best_fit(lengths, 2048))


def test_pipeline_as_registered(spark, tmp_path):
    """``tests/llm/test_pipeline.py`` holds each stage against a plain version; the whole must be what the stages give one by one."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
    got, _ = placed(entry.queries()["pipeline"](spark, SF).collect(), 2048)
    assert got == pieces([(r.doc_id, r.text) for r in docs.collect()], 2048) and got


def test_toxicity_as_registered(spark):
    docs = {d["doc_id"]: d for d in documents()}
    got = entry.queries()["op13_toxicity"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
