import tracemalloc
import re
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from webcapture.llm import chat_format, langid, token_words, warc
from webcapture.llm.decontaminate import build_index, contamination, find_items
from webcapture.llm.exact_topk import top_k
from webcapture.llm.langid import identify
from webcapture.llm.packing import best_fit, bins, lower_bound, pack_documents, pack_lengths
from webcapture.llm.sentence_spans import remove_repeated_sentences
from webcapture.llm.token_counts import count_tokens

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["a", "B", "é", "ß", "Σ", " ", "  ", "\n", "\t", "\xa0", "　", "\x1c", "\x85", "'s", "don't", "23", "!", "…", "<|endoftext|>", "<|startoftext|>", "́", "漢", "\r\n", "\x0b", "İ", " ́", "\0"]


def odd_texts(n):
    rng = random.Random(n)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(n)] + ["", None, "word " * 50000]


# Chat formatting


def digest(texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def test_chats_read_back(spark):
    probe = "<|im_end|><|im_start|>assistant ok"
    rows = [(1, 0, "user", probe), (1, 1, "assistant", probe), (1, 2, "user", None), (1, 3, "assistant", "<\\|im_end|> x\n"), (2, 0, "assistant", ""), (None, None, None, "t"), (3, 1, "a\nb%0A<|im_end|>", "u"), (3, 1, "assistant", "v")]
    rows += [(4, i, ("user", "assistant")[i % 2], f"{i} \n" * 3) for i in range(3000)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, conv int")
    got = {r.conv_id: r for r in chat_format.conversation_digests(chat_format.format_chats(df)).collect()}
    for conv in (1, 2, 3, 4, None):
        turns = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda t: (t[0] or 0, t[1], t[2]))
        learned = [x for _, r, x in turns if r == "assistant"]
        assert got[conv].n_turns == len(turns) and got[conv].turns_sha256 == digest(f"{r}\n{x}\n" for _, r, x in turns)
        assert got[conv].loss_chars == sum(map(len, learned)) and got[conv].loss_sha256 == digest(learned)
    assert chat_format.format_chats(df.limit(0)).collect() == []


def test_rewriting_templates_are_found(spark):
    def last_only(messages):
        return "".join(f"[{m['role']}] {m['text'] if i == len(messages) - 1 else '...'}\n" for i, m in enumerate(messages))

    df = spark.createDataFrame([(1, 0, "user", "one"), (1, 1, "assistant", "two")], "conv_id long, turn long, role string, text string")
    got = chat_format.format_chats(df, chat_format.Template(last_only)).orderBy("seq").collect()
    assert [r.rewrites for r in got] == [False, True]
    whole = chat_format.format_chats(df, chat_format.Template(chat_format.render_turns)).orderBy("seq").collect()
    streamed = chat_format.format_chats(df).orderBy("seq").collect()
    assert whole == streamed and not any(r.rewrites for r in whole)


def test_declared_templates_are_tried_on_whole_prefixes(spark):
    """A template that rewrites two turns back and declares one is found out in the first turns."""

    def drop_older(messages):
        return "".join(f"[{m['text'] if i >= len(messages) - 2 else '-'}]" for i, m in enumerate(messages))

    turns = spark.createDataFrame([(1, i, "user", f"t{i}") for i in range(9)], "conv_id long, turn long, role string, text string")
    got = sorted(chat_format.format_chats(turns, chat_format.Template(drop_older, lookback=1)).collect(), key=lambda r: r.seq)
    assert [r.rewrites for r in got] == [False, False, True, True, True, True, False, False, False]
    assert chat_format.TURNS.lookback >= 1 and not any(r.rewrites for r in chat_format.format_chats(turns).collect())


# WARC


def test_archives_round_trip(spark):
    big = "x" * 200
    rows = [(1, "http://b.a.org/x?q=1#f", big), (2, "https://B.A.org:8080", big), (3, None, None), (4, "http://a.org/", "é" * 60), (None, "http://a.org/", big), (5, "bad url\r\n", "short"), (6, "http://a.org/", "short"), (6, "http://a.org/", "short")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, key int")
    index = warc.build_index(warc.write_archives(pages), files=2, lines=2)
    found = warc.look_up(index, pages.select(warc.url_key(F.col("url")).alias("key")))
    got = sorted(((r.page, r.record_type, r.size, r.refers_to, bytes(r.payload or b"")) for r in warc.read_records(found).collect()), key=str)
    want = []
    for page, _, html in rows:
        raw = (html or "").encode()
        revisit = html == big and page != 1
        want.append((page, "revisit" if revisit else "response", len(raw), 1 if revisit else None, b"" if revisit else raw))
    assert got == sorted(want, key=str)
    one = warc.look_up(index, spark.createDataFrame([("org,a)/",), ("org,none)/",), (None,)], "key string"))
    assert sorted((r.page for r in one.collect()), key=str) == [4, 6, 6, None]
    none = warc.build_index(warc.write_archives(pages.limit(0)))
    assert warc.look_up(none, pages.select(F.col("url").alias("key"))).collect() == []


def test_url_keys(spark):
    df = spark.createDataFrame([("http://www.Example.org",), ("https://u:p@a.b.c:443/p?x#y",), ("http://a.b:81/",), (None,), ("mailto:x",)], "url string")
    assert [r.k for r in df.select(warc.url_key(F.col("url")).alias("k")).collect()] == ["org,example,www)/", "c,b,a)/p?x", "b,a:81)/", "", "mailto:x"]


# Language identification


def test_languages_are_learned(spark):
    rng = random.Random(2)
    words = {"xx": ["alpha", "beta", "gamma"], "yy": ["schön", "über", "straße"]}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(3, 40))), lang, 5) for i in range(300) for lang in [rng.choice(["xx", "yy"])]]
    rows += [(900, None, "xx", 0), (901, "", "yy", 0), (902, "12 !", None, 0), (None, "alpha beta", None, 0), (903, "über " * 50000, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = {r.doc_id: r for r in identify(df).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang, _ in rows[:300])
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[None].lang_pred == "xx" and got[903].lang_pred == "yy"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert identify(df.limit(0)).collect() == []


# Tokens and packing


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_tokens_are_those_of_the_library(path):
    texts = odd_texts(4000)
    want = [e.ids for e in token_words.tokenizer(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert token_words.lengths(path, texts) == [len(x) for x in want]
    assert list(token_words.token_ids(path, texts)) == [np.array(x, "<u4").tobytes() for x in want]


def test_token_counts(spark):
    df = spark.createDataFrame([("a", "hello world", 1), (None, None, 2), ("a", "é " * 2000, 3)], "doc_id string, text string, n_tokens int")
    got = sorted(map(tuple, count_tokens(df, BYTES).collect()), key=str)
    assert got[0] == ("a", 11, 2, False) and got[2] == (None, 0, 0, False) and got[1][3] and got[1][1] == 6000
    assert count_tokens(df.limit(0), BYTES).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_every_piece(seed):
    rng = random.Random(seed)
    counts = Counter(rng.randint(1, 64) for _ in range(rng.choice([0, 1, 5, 40, 3000])))
    plan = pack_lengths(dict(counts), 64)
    assert sum((Counter({n: t * c for n, c in Counter(f).items()}) for f, t in plan), Counter()) == counts
    assert all(sum(f) <= 64 for f, _ in plan)
    assert lower_bound({n: c for n, c in counts.items() if n < 64}, 64) + counts[64] <= bins(plan) <= bins(best_fit(counts, 64))


def test_search_beats_best_fit():
    counts = {44: 1, 24: 1, 15: 1, 22: 1, 21: 1, 17: 1, 8: 1, 6: 1, 7: 1, 36: 1}
    assert bins(pack_lengths(counts, 100)) == lower_bound(counts, 100)


def test_sequences_of_many_short_pieces():
    assert bins(best_fit({5: 4, 4: 4, 3: 2}, 21)) == 3 and bins(pack_lengths({5: 4, 4: 4, 3: 2}, 21)) == 2
    rng = random.Random(1)
    counts = Counter(rng.randint(300, 511) for _ in range(2000))
    assert bins(pack_lengths(counts, 2048)) < 0.97 * bins(best_fit(counts, 2048))


@pytest.mark.parametrize("seed", range(40))
def test_small_plans_are_optimal(seed):
    rng = random.Random(seed)
    capacity = rng.randint(12, 40)
    pieces = sorted((rng.randint(2, capacity // rng.choice([2, 3, 4])) for _ in range(rng.randint(4, 11))), reverse=True)

    def fits(at, rooms):
        if at == len(pieces):
            return True
        return any(fits(at + 1, rooms[:i] + (room - pieces[at],) + rooms[i + 1 :]) for i, room in enumerate(rooms) if room >= pieces[at] and room not in rooms[:i])

    least = next(n for n in range(1, len(pieces) + 1) if fits(0, (capacity,) * n))
    assert bins(pack_lengths(Counter(pieces), capacity)) == least


def test_packing(spark):
    texts = odd_texts(50)
    rows = [(None if i % 17 == 0 else i % 30, t, 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, offset int")
    got = pack_documents(df, WORDS, capacity=64).collect()
    want = Counter()
    for (doc, text, _), tokens in zip(rows, token_words.tokenizer(WORDS).encode_batch([t or "" for t in texts], add_special_tokens=False), strict=True):
        ids = [*tokens.ids, 0]
        want.update((doc, k // 64, k, len(ids[k : k + 64])) for k in range(0, len(ids), 64))
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert pack_documents(df.limit(0), WORDS).collect() == []


# Exact top-k


def test_top_k_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice([0.0, 0.25, -1.5, 3.0]) for _ in range(4)]) for i in range(300)]
    rows += [(400, None), (401, [1.0, None, 0.0, 0.0]), (402, [float("nan")] * 4), (403, [float("inf")] * 4), (None, [1.0] * 4), (450, [2.0, 1.0]), (404, [1e6, -1e6, 1e6, 1e6])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, rank string")
    got = sorted(map(tuple, top_k(df, df.filter("vec_id % 50 = 0"), k=7).collect()))
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in whole:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:7])]
    assert got == sorted(want)
    assert top_k(df.limit(0), df.limit(0)).collect() == []


def test_top_k_among_near_equal_vectors(spark):
    """Bins of the first histogram hold hundreds of scores, so they are parted again."""
    rng = np.random.default_rng(3)
    near = np.array([0.9, 0.5, 0.3, 0.2]) + rng.normal(0, 0.004, (700, 4))
    vectors = np.concatenate([near, rng.normal(0, 0.3, (700, 4))])
    rows = [(i, v) for i, v in enumerate(vectors.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, top_k(df, df.filter("vec_id % 20 = 0"), k=5).collect()))
    whole = np.floor(256 * vectors).astype(np.int64)
    want = []
    for q in range(0, len(whole), 20):
        scores = sorted((-int(s), i) for i, s in enumerate(whole @ whole[q]) if i != q)
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:5])]
    assert got == sorted(want)


# Decontamination


def test_benchmark_windows(spark):
    item = " ".join(f"w{i}" for i in range(20))
    docs = [(1, "x " + item.upper() + " y"), (2, "w0 w1 w2"), (3, None), (4, ""), (None, item), (5, "w3, w2 w1 w0"), (6, "tiny, PASSAGE! " * 3), (6, "z " * 200000 + item)]
    items = [(10, item), (9, "tiny passage"), (8, None), (7, ""), (10, item), (None, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13")]
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, hits int")
    index = build_index(df)
    found = contamination(find_items(index, spark.createDataFrame(items, "item_id long, text string"))).collect()
    got = sorted(((r.id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in found), key=str)
    assert got == sorted(
        [(1, 22, 20, ["", "10"], True), (2, 3, 0, [], False), (3, 0, 0, [], False), (4, 0, 0, [], False), (None, 20, 20, ["", "10"], True), (5, 4, 0, [], False), (6, 6, 6, ["9"], True), (6, 200020, 20, ["", "10"], False)],
        key=str,
    )
    near = spark.createDataFrame([(1, "w1 w2 w0")], "item_id long, text string")
    assert [r.id for r in find_items(index, near, slop=3).filter("size(hits) > 0 and id in (2, 5)").orderBy("id").collect()] == [2, 5]
    assert find_items(index, near.limit(0)).filter("size(hits) > 0").count() == 0
    assert find_items(build_index(df.limit(0)), near).collect() == []


def test_repeated_words_are_one_window(spark):
    """Item and document are the same two words over and over: the work must not grow with the square."""
    words = 40_000
    df = spark.createDataFrame([(1, "buy now " * (words // 2)), (2, "buy " + "now buy " * 5)], "doc_id long, text string")
    items = spark.createDataFrame([(5, "buy now " * (words // 2)), (6, "now buy " * 30)], "item_id long, text string")
    got = sorted((r.id, r.n_words, r.n_hit, r["items"]) for r in contamination(find_items(build_index(df), items)).collect())
    assert got == [(1, words, words, ["5", "6"]), (2, 11, 0, [])]


# Sentence spans


def plain_sentences(docs, span, words):
    """The rule, sentence by sentence: which stay of each text."""
    cut = {k: re.findall(r"[^.!?\n]*[.!?\n]+\s*|[^.!?\n]+", text or "") for k, text in docs}
    seen, gone = {}, {k: set() for k in cut}
    for k in sorted(cut, key=lambda k: (k is None, k)):
        own = cut[k]
        for i in range(len(own)):
            ends = [j for j in range(i + span - 1, len(own)) if sum(len(s.split()) for s in own[i : j + 1]) >= words]
            if ends:
                run = "".join(own[i : ends[0] + 1]).rstrip(" \t\n\f\r")
                if seen.setdefault(run, (k, i)) != (k, i):
                    gone[k] |= set(range(i, ends[0] + 1))
    return {k: (len(own), len(gone[k]), "".join(s for i, s in enumerate(own) if i not in gone[k])) for k, own in cut.items()}


def test_repeated_sentences(spark):
    shared = "One two. Three four! Five six seven? Eight."
    docs = [(1, f"Start here. {shared} End a."), (2, f"Other.\n{shared} Tail b."), (3, f"{shared} {shared}"), (4, None), (5, ""), (6, " \n"), (None, shared), (7, "Same only. Twice."), (8, "Same only. Twice."), (9, "No stop " * 30000), (10, f"..!  {shared}"), (11, "a. " * 9)]
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, at int")
    for span, words in ((2, 6), (2, 3), (3, 1), (1, 1)):
        got = {r.doc_id: (r.n_sentences, r.n_removed, r.kept) for r in remove_repeated_sentences(df, span=span, words=words).collect()}
        assert got == plain_sentences(docs, span, words)
    assert remove_repeated_sentences(df.limit(0)).collect() == []


# Memory of workers


def peak(run):
    tracemalloc.start()
    run()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_many_short_texts_take_little_memory():
    texts = [f"{k} kurze Zeile mit wenig Text darin und ein Ende {k * 7919}".ljust(100, "x") for k in range(5000)]
    batch = pa.record_batch([pa.array(["de"] * 5000), pa.array(range(5000)), pa.array(texts)], names=["lang", "part", "text"])
    assert peak(lambda: list(langid._sampled([batch]))) < 100e6


def test_remembered_parts_are_bounded():
    memory = token_words.Memory(WORDS, limit=1 << 20)
    for start in range(0, 60000, 6000):
        words = [f" {'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676 % 26)}" for k in range(start, start + 6000)]
        memory.ids([" the", *words])
        assert len(memory.young) + len(memory.old) < 16000
    assert " the" in memory.young or " the" in memory.old


def test_long_texts_are_parted_at_safe_places(monkeypatch):
    texts = ["", None, "Some words, and more! " * 50, "x" * 300, "kein\u00a0Raum hier \u3000 da " * 20, "<|endoftext|> a <|x " * 30]
    whole = list(token_words.token_ids(WORDS, texts))
    monkeypatch.setattr(token_words, "AT_ONCE", 64)
    assert list(token_words.token_ids(WORDS, texts)) == whole
    assert token_words.lengths(WORDS, texts) == [len(x) // 4 for x in whole]


def test_fit_is_follow_the_regularised_leader():
    """Against the rule written out weight by weight."""
    rng, how = np.random.default_rng(5), langid.Settings(epochs=2)
    rows = [(int(rng.integers(3)), np.sort(rng.choice(40, 6, replace=False)), rng.random(6)) for _ in range(200)]
    z, n = np.zeros((3, 40)), np.zeros((3, 40))

    def weight(c, g):
        if abs(z[c, g]) <= how.l1:
            return 0.0
        return -(z[c, g] - np.sign(z[c, g]) * how.l1) / ((how.beta + n[c, g] ** 0.5) / how.alpha + how.l2)

    order = np.random.default_rng(7)
    for _ in range(how.epochs):
        for k in order.permutation(len(rows)):
            label, grams, x = rows[k]
            w = [[weight(c, g) if n[c, g] else 0.0 for g in grams] for c in range(3)]
            e = np.exp([sum(a * b for a, b in zip(own, x, strict=True)) for own in w])
            for c in range(3):
                for j, g in enumerate(grams):
                    step = (e[c] / e.sum() - (c == label)) * x[j]
                    z[c, g] += step - ((n[c, g] + step * step) ** 0.5 - n[c, g] ** 0.5) / how.alpha * w[c][j]
                    n[c, g] += step * step
    got = langid._fitted(rows, 3, how)[:, :40]
    assert np.allclose(got, [[weight(c, g) for g in range(40)] for c in range(3)])
    logits, labels = rng.normal(0, 4, (300, 3)), rng.integers(0, 3, 300)
    loss = lambda t: -np.log(langid._softmax(logits / t)[np.arange(300), labels]).mean()
    best = langid._temperature(logits, labels)
    assert all(loss(best) <= loss(t) + 1e-9 for t in np.geomspace(0.06, 19, 60))


def test_captures_of_one_key_come_in_batches(spark, tmp_path):
    pages = spark.range(23_000).select(F.col("id").alias("page_id"), F.lit("http://a.b/same").alias("url"), F.lit("<p>").alias("html"))
    index = warc.build_index(warc.write_archives(pages))
    found = warc.look_up(index, spark.createDataFrame([("http://a.b/same",)], "u string").select(warc.url_key(F.col("u")).alias("key")))
    sizes = found.mapInArrow(lambda batches: (pa.record_batch([pa.array([b.num_rows], pa.int64())], names=["n"]) for b in batches), "n long").collect()
    assert sum(r.n for r in sizes) == 23_000 and found.select("page").distinct().count() == 23_000
