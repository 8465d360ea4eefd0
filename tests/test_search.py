import random
import re

from webcapture.operators.search import grep_lines, keyword_hits, keyword_ranking, outline, read_lines, text_lines


def documents(spark):
    rng = random.Random(5)
    parts = ["the ", "The", "\n", "\n\n", "# h", "## two ", "#no", "é", " ", "risk", "\r\n", "####### x"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(200)] + ["", "\n", "a\n", None]
    return texts, spark.createDataFrame(list(enumerate(texts)), "id long, text string").cache()


def lines_of(text):
    if not text:
        return []
    return (text[:-1] if text.endswith("\n") else text).split("\n")


def test_lines_grep_and_ranges(spark):
    texts, df = documents(spark)
    every = [(i, n, line) for i, t in enumerate(texts) for n, line in enumerate(lines_of(t), 1)]
    assert sorted(map(tuple, text_lines(df, "id").collect())) == sorted(every)
    pattern = r"the |^#{1,2} |\bri"
    assert sorted(map(tuple, grep_lines(df, pattern, "id").collect())) == sorted(r for r in every if re.search(pattern, r[2]))
    for start, end in ((2, 4), (0, 1), (3, 2), (500, 600)):
        assert sorted(map(tuple, read_lines(df, start, end, "id").collect())) == sorted(r for r in every if start <= r[1] <= end)


def test_outline(spark):
    texts, df = documents(spark)
    got = {r.id: r for r in outline(df, "id").collect()}
    for i, t in enumerate(texts):
        heads = [(n, len(m[1]), line[m.end() :].strip(" ").strip("\r")) for n, line in enumerate(lines_of(t), 1) if (m := re.match(r"(#{1,6})\s+", line))]
        assert got[i].n_lines == len(lines_of(t))
        assert got[i].n_chars == (None if t is None else len(t))
        assert [(h.line_no, h.level) for h in got[i].headings] == [h[:2] for h in heads]


def test_keywords(spark):
    texts, df = documents(spark)
    words = ["the", "ri", "é+"]
    want = {(i, w): len(re.findall(w, t)) for i, t in enumerate(texts) if t for w in words}
    hits = {(r.id, r.keyword): r.hits for r in keyword_hits(df, words, "id").collect()}
    assert hits == {k: n for k, n in want.items() if n}
    ranked = keyword_ranking(df, words, "id").collect()
    totals = [r.hits for r in ranked]
    assert totals == sorted(totals, reverse=True)
    assert {r.id: r.hits for r in ranked} == {i: n for i in range(len(texts)) if (n := sum(want.get((i, w), 0) for w in words))}


def test_many_keywords_are_one_automaton(spark):
    texts = ["aaaa abab", "", None, "x.y aba Ünï", "a" * 100_000, "none"]
    words = ["aa", "ab", "aba", "Ünï", "aa", *(f"w{i}" for i in range(3000))]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = sorted(map(tuple, keyword_hits(df, [*words, r"a.a", "[.]"], "id").collect()))
    want = [(i, w, t.count(w)) for i, t in enumerate(texts) if t for w in words if w in t]
    want += [(i, p, len(re.findall(p, t))) for i, t in enumerate(texts) if t for p in ("a.a", "[.]") if re.search(p, t)]
    assert got == sorted(want)
    ranked = [tuple(r) for r in keyword_ranking(df, words, "id").collect()]
    totals = {i: (sum(h for j, _, h in want if j == i and _ in words), sum(1 for j, w, _ in want if j == i and w in words)) for i in (0, 3, 4)}
    assert ranked == sorted(((i, *x) for i, x in totals.items()), key=lambda r: (-r[1], r[0]))
    few, many = (keyword_hits(df, [f"k{i}" for i in range(n)], "id")._jdf.queryExecution().optimizedPlan().toString() for n in (100, 5000))
    assert len(many) < len(few) + 50
