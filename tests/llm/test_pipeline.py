import re
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from webcapture.llm.token_words import token_ids

WORDS = public_tokenizers.path("word_bpe_49k.json")


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage is held against a plain version on its own input."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = [(10**6, None, None, None, None), (10**6 + 1, "123 --", "en", "s", 6), (None, "Some text without an id stands here.", None, "s", 36)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        rows[name] = {r.doc_id: r for r in docs.collect()} if name != "packing" else docs.collect()
        if name != "packing":
            assert docs.columns == before.columns == corpus_pipeline.COLUMNS
    assert 10**6 not in rows["language"] and 10**6 + 1 not in rows["language"] and None in rows["language"]

    kept, sets = rows["near_duplicates"], {i: shingles(r.text) for i, r in rows["language"].items() if i is not None}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and len(sets[a] & sets[b]) * 10 >= 8 * len(sets[a] | sets[b])]
    low = {i: i for i in sets}
    for _ in range(len(sets)):
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    assert set(kept) - {None} == {i for i in sets if low[i] == i}

    raw = {i: r.text.encode() for i, r in kept.items()}
    size = corpus_pipeline.PASSAGE
    found = Counter(t[j : j + size] for t in raw.values() for j in range(len(t) - size + 1))
    for i, text in raw.items():
        gone = bytearray(len(text))
        for j in range(len(text) - size + 1):
            if found[text[j : j + size]] > 1:
                gone[j : j + size] = b"\1" * size
        left = bytes(b for b, g in zip(text, gone, strict=True) if not g).decode(errors="ignore")
        assert rows["repeated_passages"][i].text == left and rows["repeated_passages"][i].n_chars == len(left)

    def words(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    windows = {tuple(w[j : j + 13]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() for w in [words(r.text)] for j in range(max(len(w) - 12, 1)) if w}
    clean = set()
    for i, r in rows["repeated_passages"].items():
        w = words(r.text)
        hit = {p for n in {len(x) for x in windows} for j in range(len(w) - n + 1) if tuple(w[j : j + n]) in windows for p in range(j, j + n)}
        if not hit or 20 * len(hit) < len(w):
            clean.add(i)
    assert set(rows["decontaminate"]) == clean

    ids = list(token_ids(WORDS, [r.text for r in rows["decontaminate"].values()]))
    assert sum(r.length for r in rows["packing"]) == sum(len(np.frombuffer(x, "<u4")) + 1 for x in ids)
    assert {r.doc_id for r in rows["packing"]} == clean


def test_passages_of_short_words(spark, tmp_path):
    """A passage of 51 words goes wherever it stands, however short they are; one of 50 short words stays."""
    small = "a I to of in it we on go up no so at by he".split()
    rng = np.random.default_rng(5)
    many, few = (" ".join(rng.choice(small, n)) for n in (51, 50))
    assert len(many) < 200
    frames = [("First é, ", many, " tail one."), ("\"", many, "\" ends"), ("Third ", few, " is kept"), ("Fourth: ", few, ", also"), ("", many, ""), ("", "go " * 60, "")]
    rows = [(i, "".join(f), "en", "s", 0) for i, f in enumerate(frames)] + [(9, None, None, None, 0), (None, "", None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.repeated_passages(spark, docs, "").collect()}
    want = {i: a + ("" if t == many else t) + b for i, (a, t, b) in enumerate(frames)}
    assert got == want | {9: "", None: ""}


def test_empty_documents(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter(F.lit(False))
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.count() == 0


def test_near_duplicates_of_repeated_ids(spark):
    """One id with several texts: each text is judged by itself; equal rows leave one, null ids included."""
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
    near, other = base + " nineteen", "quite another text that has nothing to do with any of the rest of them here"
    texts = [(1, base), (2, base), (2, other), (3, near), (4, other + " x y"), (5, "alone in the whole table with words of its own to tell"), (5, near), (None, base), (None, base), (7, None), (7, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, base), (2, other), (5, texts[5][1]), (7, None), (8, ""), (None, base)], key=str)
    twins = docs.filter("doc_id = 5").union(spark.createDataFrame([(5, base, "en", "s", 0)], docs.schema))
    left = [r.text for r in corpus_pipeline.near_duplicates(spark, twins, "").collect()]
    assert len(left) == 2 and texts[5][1] in left and len({near, base} & set(left)) == 1
