"""How far the sources of each language differ in their use of terms, pair by pair and term by term.

The counts of a language are a matrix of groups (its sources) by kept terms. It is stored as square blocks that
hold a cell at least; a block is a quadtree whose nodes tell whether their quadrant holds any. What no block
covers, and every quadrant that is empty for both groups of a pair, is uniform and priced at once: its width
times the difference of the two groups' probabilities of an absent term. Only quadrants in which either group
has a cell are followed, for both together, down to small leaves that are compared cell by cell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from webcapture.llm.common import LOWER, WORD_BYTES, by_bytes, saved, utf8
from webcapture.llm.ranks import numbered

#: Rows and columns of a block, and of a leaf of its quadtree; powers of two.
SIDE, LEAF = 256, 8
#: Leaves that are compared at once.
_AT_ONCE = 1024
_TERM = np.zeros(256, bool)
_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_TALLY = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """``doc, code`` and count of each term of each text, and the terms that the codes stand for."""
    inside = _TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[[0, -1]] = True
    edge[offsets] = True
    places = np.flatnonzero(edge)
    starts, sizes = places[:-1], np.diff(places)
    own = inside[starts] if len(starts) else np.zeros(0, bool)
    starts, sizes = starts[own], sizes[own]
    ends = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(LOWER[data[inside]])]).dictionary_encode()
    code, docs = words.indices.to_numpy().astype(np.int64), np.searchsorted(offsets, starts, "right") - 1
    kinds = max(1, len(words.dictionary))
    key, count = np.unique(docs * kinds + code, return_counts=True)
    return key // kinds, words.dictionary, key % kinds, count


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bounded parts of a batch; only a single longer text is parted, beside bytes that no term holds."""
    at = 0
    while len(offsets) == 2 and len(data) - at > 2 * WORD_BYTES:
        other = np.flatnonzero(~_TERM[data[at + WORD_BYTES : at + 2 * WORD_BYTES]])
        if not len(other):
            break
        end = at + WORD_BYTES + int(other[0])
        yield data[at:end], np.array([0, end - at])
        at = end
    yield data[at:], offsets - (offsets > 0) * at


def _tallied(batches):
    """Of each batch, how often a group has a term and in how many texts; a row without a term for each group."""
    for batch in by_bytes(batches, "text", WORD_BYTES):
        data, offsets = utf8(batch.column("text"))
        groups = pa.StructArray.from_arrays([pc.fill_null(batch.column(c), "") for c in ("lang", "source")], ["lang", "source"])
        names: dict[tuple[str, str], int] = {}
        group = np.array([names.setdefault((g["lang"], g["source"]), len(names)) for g in groups.to_pylist()], np.int64)
        parts = []
        for piece, own in _pieces(data, offsets):
            doc, terms, code, n = _terms(piece, own)
            parts.append(pa.table([pa.array(doc), terms.take(pa.array(code)), pa.array(n)], names=["doc", "term", "n"]))
        found = parts[0] if len(parts) == 1 else pa.concat_tables(parts).group_by(["doc", "term"]).aggregate([("n", "sum")]).rename_columns(["doc", "term", "n"])
        table = pa.table([pa.array(group[found.column("doc").to_numpy()]), found.column("term"), found.column("n")], names=["group", "term", "n"])
        table = table.group_by(["group", "term"]).aggregate([("n", "sum"), ("n", "count")])
        langs, sources = (pa.array([name[k] for name in names], pa.string()) for k in (0, 1))
        own = table.column("group").combine_chunks()
        yield pa.RecordBatch.from_arrays([langs, sources, pa.nulls(len(names), pa.string()), *(pa.array(np.zeros(len(names), np.int64)) for _ in "nd")], schema=_TALLY)
        term = table.column("term").combine_chunks().cast(pa.string())
        yield pa.RecordBatch.from_arrays([langs.take(own), sources.take(own), term, *(table.column(c).combine_chunks().cast(pa.int64()) for c in ("n_sum", "n_count"))], schema=_TALLY)


def share(count: Column, total: Column, kinds: Column, smooth: int, unit: int) -> Column:
    """``1 + floor(unit * (count + smooth) / (total + smooth * kinds))``, exact for counts of any size."""
    up = (count + F.lit(smooth)).cast("decimal(19,0)") * F.lit(unit).cast("decimal(10,0)")
    down = (total + F.lit(smooth) * kinds).cast("decimal(19,0)")
    # The remainder is exact and the quotient of its rest is whole.
    return F.lit(1).cast("long") + ((up - up % down) / down).cast("long")


def _pyramid(has: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Which quadrants hold a cell, level by level from the root to the leaves."""
    n = len(has) // leaf
    levels = [has.reshape(n, leaf, n, leaf).any(axis=(1, 3))]
    while len(levels[0]) > 1:
        m = levels[0]
        levels.insert(0, m[0::2, 0::2] | m[0::2, 1::2] | m[1::2, 0::2] | m[1::2, 1::2])
    return levels


def joint(a: np.ndarray, b: np.ndarray, has_a: np.ndarray, has_b: np.ndarray, zero_a: np.ndarray, zero_b: np.ndarray, width: int, leaf: int = LEAF) -> np.ndarray:
    """Sum over ``width`` columns of the difference of each row of ``a`` and each of ``b``.

    ``a`` and ``b`` are square, ``has_`` marks their cells and ``zero_`` is what every other column of a row
    holds. Both quadtrees are followed together from their roots.
    """
    tree_a, tree_b = _pyramid(has_a, leaf), _pyramid(has_b, leaf)
    side = len(a)
    sums = np.zeros((len(zero_a), len(zero_b)), np.int64)
    rows_a, rows_b = -(-len(zero_a) // leaf), -(-len(zero_b) // leaf)
    empty = np.zeros((side // leaf, side // leaf), np.int64)
    at = np.zeros((1, 3), np.int64)
    for level, (in_a, in_b) in enumerate(zip(tree_a, tree_b, strict=True)):
        size = side >> level
        at = at[(at[:, 2] * size < width) & (at[:, 0] * size < len(zero_a)) & (at[:, 1] * size < len(zero_b))]
        either = in_a[at[:, 0], at[:, 2]] | in_b[at[:, 1], at[:, 2]]
        span = size // leaf
        for p, q, c in at[~either]:
            empty[p * span : (p + 1) * span, q * span : (q + 1) * span] += min(size, width - c * size)
        at = at[either]
        if size > leaf:
            steps = np.array([(i, j, k) for i in (0, 1) for j in (0, 1) for k in (0, 1)])
            at = (2 * at[:, None, :] + steps).reshape(-1, 3)
    lone = np.abs(zero_a[:, None] - zero_b[None, :])
    sums += np.repeat(np.repeat(empty[:rows_a, :rows_b], leaf, 0), leaf, 1)[: len(zero_a), : len(zero_b)] * lone
    tiles_a, tiles_b = (m.reshape(side // leaf, leaf, side // leaf, leaf).transpose(0, 2, 1, 3) for m in (a, b))
    tiles = np.zeros((side // leaf, side // leaf, leaf, leaf), np.int64)
    for start in range(0, len(at), _AT_ONCE):
        p, q, c = at[start : start + _AT_ONCE].T
        live = np.arange(leaf)[None, :] + c[:, None] * leaf < width
        apart = np.abs(tiles_a[p, c][:, :, None, :] - tiles_b[q, c][:, None, :, :]) * live[:, None, None, :]
        np.add.at(tiles, (p, q), apart.sum(axis=3))
    return sums + tiles.transpose(0, 2, 1, 3).reshape(side, side)[: len(zero_a), : len(zero_b)]


def _dense(cells: dict | None, zero: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
    full, has = np.zeros((side, side), np.int64), np.zeros((side, side), bool)
    full[: len(zero)] = zero[:, None]
    if cells is not None:
        r, c, p = (np.array(cells[k], np.int64) for k in ("r", "c", "p"))
        full[r, c], has[r, c] = p, True
    return full, has


def _compared(side: int) -> Callable:
    def compare(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                x = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                zeros = [np.array(x[k], np.int64) for k in ("zero_a", "zero_b")]
                (a, has_a), (b, has_b) = (_dense(x[k], zero, side) for k, zero in zip(("cells_a", "cells_b"), zeros, strict=True))
                sums = joint(a, b, has_a, has_b, *zeros, x["width"])
                i, j = (v.reshape(-1) for v in np.indices(sums.shape))
                yield pa.record_batch(
                    [pa.array([x["lang"]] * len(i), pa.string()), pa.array(i + x["band_a"] * side), pa.array(j + x["band_b"] * side), pa.array(sums.reshape(-1)), pa.array(np.full(len(i), x["width"]))],
                    names=["lang", "row_a", "row_b", "value", "width"],
                )

    return compare


def _pairs(cells: DataFrame, groups: DataFrame, side: int) -> DataFrame:
    """``lang, row_a, row_b, value`` of all pairs of groups: ``row_a <= row_b``'s bands, either way round within one."""
    bands = groups.withColumn("band", F.expr(f"row div {side}")).groupBy("lang", "band").agg(F.array_sort(F.collect_list(F.struct("row", "zero"))).alias("all"), F.max("kinds").alias("kinds"), F.max("height").alias("height"))
    bands = bands.select("lang", "band", F.col("all.zero").alias("zero"), "kinds", F.expr(f"(height + {side - 1}) div {side}").alias("bands"))
    bands = saved(bands, "bands")
    first, second = (bands.select("lang", F.col("band").alias(f"band_{x}"), F.col("zero").alias(f"zero_{x}"), *more) for x, more in (("a", ["kinds", "bands"]), ("b", [])))
    met = first.withColumn("band_b", F.explode(F.sequence("band_a", F.col("bands") - 1))).join(second, ["lang", "band_b"])
    met = saved(met.select("lang", "band_a", "band_b", "zero_a", "zero_b", "kinds"), "bands")

    blocks = cells.groupBy("lang", F.expr(f"row div {side}").alias("band"), F.expr(f"col div {side}").alias("stripe"))
    packed = F.collect_list(F.struct((F.col("row") % side).cast("int").alias("r"), (F.col("col") % side).cast("int").alias("c"), "p"))
    blocks = blocks.agg(F.struct(packed["r"].alias("r"), packed["c"].alias("c"), packed["p"].alias("p")).alias("cells")).join(bands.select("lang", "band", "bands"), ["lang", "band"])
    other = blocks.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bands") - 1)))
    low = F.col("band") <= F.col("other")
    high = F.col("band") >= F.col("other")
    sides = other.groupBy("lang", F.least("band", "other").alias("band_a"), F.greatest("band", "other").alias("band_b"), "stripe")
    sides = sides.agg(F.first(F.when(low, F.col("cells")), ignorenulls=True).alias("cells_a"), F.first(F.when(high, F.col("cells")), ignorenulls=True).alias("cells_b"))
    width = F.least(F.lit(side).cast("long"), F.col("kinds") - F.col("stripe") * side)
    tasks = sides.join(met, ["lang", "band_a", "band_b"]).select("lang", "band_a", "band_b", "cells_a", "cells_b", "zero_a", "zero_b", width.alias("width"))
    parts = tasks.mapInArrow(_compared(side), "lang string, row_a long, row_b long, value long, width long")
    parts = parts.groupBy("lang", "row_a", "row_b").agg(F.sum("value").alias("value"), F.sum("width").alias("seen"))
    each = met.select("lang", "band_a", "band_b", "kinds", "zero_b", F.posexplode("zero_a").alias("i", "x")).select("lang", "band_a", "band_b", "kinds", "i", "x", F.posexplode("zero_b").alias("j", "y"))
    each = each.select("lang", (F.col("band_a") * side + F.col("i")).alias("row_a"), (F.col("band_b") * side + F.col("j")).alias("row_b"), "kinds", F.abs(F.col("x") - F.col("y")).alias("lone"), "band_a", "band_b")
    rest = (F.col("kinds") - F.coalesce("seen", F.lit(0))) * F.col("lone")
    priced = each.join(parts, ["lang", "row_a", "row_b"], "left").select("lang", "row_a", "row_b", (F.coalesce("value", F.lit(0)) + rest).alias("value"), "band_a", "band_b")
    both = priced.filter("band_a != band_b").select("lang", F.col("row_b").alias("row_a"), F.col("row_a").alias("row_b"), "value")
    return priced.select("lang", "row_a", "row_b", "value").union(both).filter("row_a != row_b")


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = 30, smooth: int = 5, unit: int = 1_000_000_000, top_terms: int = 50, side: int = SIDE) -> DataFrame:
    """``lang, source, part, item, value, rank``: what sets the sources of each language apart.

    Terms are runs of ASCII letters and bytes beyond ASCII, A-Z lower-cased; a language keeps those in at least
    ``least_docs`` of its documents. A group is a language and a source, null ones and null texts being empty; it
    counts without any term too. The probability of a term is a whole number of ``unit``-ths, smoothed by
    ``smooth``. Part ``pair`` has the other sources of the language, by the sum of the differences over all kept
    terms; part ``term`` the ``top_terms`` terms that the group has and uses more than the language does. Ranks
    go by value, then by the item's bytes.

    Tables may be empty; repeated rows count as often as they are there; other columns are ignored. Texts are
    tallied where they are read; a term's counts combine before they move, so a frequent term or group has one
    row per batch at most. Sums hold for counts up to 2**63.
    """
    rows = docs.select(*(F.col(c).cast("string").alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    tally = rows.mapInArrow(_tallied, "lang string, source string, term string, n long, docs long")
    tally = saved(tally.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "tally")
    terms = tally.filter("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least_docs)
    # Terms in many documents first: the cells of rare terms, and so the empty quadrants, lie together.
    terms = numbered(terms.withColumn("rare", -F.col("docs")), ["lang"], ["rare", "term"]).select("lang", "term", "lang_n", F.col("idx").alias("col"))
    terms = saved(terms, "terms")
    langs = terms.groupBy("lang").agg(F.count("*").alias("kinds"), F.sum("lang_n").alias("lang_total"))
    counts = saved(tally.filter("term is not null").join(terms, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n", "col"), "counts")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = numbered(tally.filter("term is null").select("lang", "source"), ["lang"], ["source"]).withColumnsRenamed({"idx": "row", "width": "height"})
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "kinds", "lang_total"])
    zero = F.when(F.col("kinds") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("kinds"), smooth, unit)).otherwise(F.lit(0).cast("long"))
    groups = saved(groups.withColumn("zero", zero), "groups")

    own = share(F.col("n"), F.col("total"), F.col("kinds"), smooth, unit)
    whole = share(F.col("lang_n"), F.col("lang_total"), F.col("kinds"), smooth, unit)
    cells = counts.join(groups, ["lang", "source"]).select("lang", "source", "term", "row", "col", own.alias("p"), whole.alias("q"))
    cells = saved(cells, "cells")
    names = groups.select("lang", "source", "row")
    pairs = _pairs(cells.select("lang", "row", "col", "p"), groups.select("lang", "row", "zero", "kinds", "height"), side)
    pairs = pairs.join(names.withColumnRenamed("row", "row_a"), ["lang", "row_a"]).join(names.select("lang", F.col("source").alias("item"), F.col("row").alias("row_b")), ["lang", "row_b"])
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(ranked)
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", rank)
    more = cells.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")).withColumn("rank", rank)
    return pairs.union(more.filter(F.col("rank") <= top_terms))
