"""The manifest against a tree built node by node, on small tables with every odd case."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F
from webcapture.llm.merkle import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, idx int"


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def framed(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def tree(nodes, fanout):
    """The root, and the siblings left and right of each leaf on every level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            low = i - i % fanout
            paths[k].append(("".join(nodes[low:i]), "".join(nodes[i + 1 : low + fanout])))
        nodes = [h(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
        at = [i // fanout for i in at]
    return nodes[0], paths


def plain(rows, fanout):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, h(*map(framed, r[:5])), r))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])], fanout) for s in sources]
    root, above = tree([t[0] for t in trees], fanout)
    found = []
    for s, (subroot, paths), up in zip(sources, trees, above, strict=True):
        for (_, _, leaf, r), path in zip(sorted(by_source[s], key=lambda x: x[:3]), paths, strict=True):
            folded = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                folded = h(*map(framed, r[:4]), framed("".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for left, right in path + up:
                folded = h(left, folded, right)
            found.append((r[0], leaf, subroot, root, h(*(a + b for a, b in path + up)), folded, folded == root))
    return sorted(found, key=str)


def run(spark, rows, fanout):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return sorted(map(tuple, manifest(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, lower, fanout=fanout).collect()), key=str)


ROWS = [(i, ["b", "é", None, ""][i % 4] if i < 70 else "hot", None if i % 7 == 0 else "en", i, None if i % 11 == 0 else f"Text Ä {i}") for i in range(160)]
ROWS += [(5, "é", "en", 5, "Text Ä 5")] * 3 + [(None, None, None, None, None)] * 2 + [(None, "hot", "de", 1, ""), (9999, "lone", "en", 4, "Long " * 20000), (7, "é", "en", 7, "other")]


@pytest.mark.parametrize("fanout", [16, 2])
def test_manifest(spark, fanout):
    assert run(spark, ROWS, fanout) == plain(ROWS, fanout)


def test_small_manifests(spark):
    for rows in ([], ROWS[:1], [(1, "a", None, None, "A"), (2, "b", None, None, None)], [(i, None, None, None, "Z") for i in range(17)]):
        assert run(spark, rows, 16) == (plain(rows, 16) if rows else [])
