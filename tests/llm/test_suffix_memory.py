"""What an index of contexts takes in a worker, and what the search for repeats writes."""

import random
import tracemalloc

import pyarrow as pa

from webcapture.llm import suffix_dedup


def test_memory_of_an_index():
    rng = random.Random(3)
    base = ["".join(rng.choices("abcdefgh ", k=400)) for _ in range(1200)]
    rows = []
    while len(rows) < 12_000:
        at = rng.randrange(60)
        rows.append((len(rows) // 4, len(rows), 1, (rng.choice(base)[at : at + 300] + str(len(rows))).encode()))
    batch = pa.record_batch([pa.array(x) for x in zip(*rows, strict=True)], names=["h", "c", "n", "bytes"])
    suffix_dedup.repeated_bytes([b"x" * 300], 250)  # tables of powers are kept
    tracemalloc.start()
    marks = list(suffix_dedup._indexed(250, suffix_dedup.INDEX_BYTES)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(marks) >= 3 and sum(m.num_rows for m in marks) > 10_000
    assert peak < 130e6


def test_lone_anchors_are_not_written(spark, monkeypatch):
    written = []

    def saved(df, name, own=suffix_dedup.saved):
        out = own(df, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(suffix_dedup, "saved", saved)
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcdefgh ", k=600)) for _ in range(30)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "x" + texts[0][100:400] + "y"])], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(df, length=100, gram=30).collect()}
    assert {i: n for i, n in got.items() if n} == {0: 300, 30: 300}
    # Those of the passage stand twice; the 30 texts have hundreds that stand alone.
    assert [name for name, _ in written] == ["held", "hot"] and written[0][1] < 40
