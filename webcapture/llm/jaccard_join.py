"""Set similarity join of documents by word shingles, size-aware: heavy sets by lists, light ones by subsets.

Sets of at most ``boundary`` shingles are light: each enumerates its subsets of the size that an overlap with
a partner of a given size must reach, and two light sets are linked exactly if they meet in one. Larger sets
are heavy: each posts its rarest shingles (as many as an overlap cannot avoid) to inverted lists; sets that
meet in a list and fit in size are compared. Light sets that can reach a heavy one post too. The boundary is
where enumerating and scanning together cost least on the sizes counted in the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from webcapture.llm.common import LOWER, BitFilter, Hasher, by_bytes, mix, saved, utf8, word_places
from webcapture.llm.components import components, groups

WORD = np.ones(256, bool)
WORD[[0x20, *range(0x09, 0x0E)]] = False
#: Classes of hash values whose counts, up to 255, tell how far two sets differ at least.
SLOTS = 128
#: Members of an inverted list that are compared within one group: strays, and all members.
STRAYS, MEMBERS = 256, 2048
#: Pairs that a task remembers, so as not to send them again from the next list.
REMEMBERED = 300_000
#: Size, as a power of two, of the filter that picks the texts whose sets are compared.
FILTER_BITS = 24
_SKETCH_ROWS = 64
_LIGHT_SIZES = 32
#: Kinds of posting: an element of a heavy set; a subset shared with sets of the same size; or of another size.
_LIST, _SAME, _OTHER = 0, 1, 2


@dataclass(frozen=True)
class Threshold:
    """Links sets with ``den * overlap >= num * union``."""

    num: int
    den: int

    def overlap(self, n: int, m: int) -> int:
        return -(-self.num * (n + m) // (self.num + self.den))

    def close(self, n, m, apart):
        """Whether sets that differ in at least ``apart`` elements may still reach the overlap."""
        return (n + m - apart) * (self.num + self.den) >= 2 * self.num * (n + m)

    def partners(self, n: int) -> range:
        return range(-(-self.num * n // self.den), self.den * n // self.num + 1)

    def prefix(self, n: int) -> int:
        """Any partner shares one of that many first elements, in any common order."""
        return n + (self.num * n) // -self.den + 1

    def subsets(self, n: int) -> int:
        return sum(comb(n, self.overlap(n, m)) for m in self.partners(n) if self.overlap(n, m) <= min(n, m))


def shingle_sets(batch: pa.RecordBatch, text: str, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the ``k``-word shingles of each text; fewer words count as one shingle."""
    data, offsets = utf8(batch.column(text))
    starts, ends, first = word_places(data, offsets, WORD)
    words = Hasher(LOWER[data])(starts, ends)
    runs = np.zeros(max(len(words) - k + 1, 0), np.uint64)
    for j in range(k):
        runs += words[j : j + len(runs)] * np.uint64((0xA24BAED4963EE407 * (2 * j + 1) + 2 * j) % 2**64 | 1)
    runs = mix(runs)
    for begin, end in zip(first[:-1], first[1:], strict=True):
        if end - begin >= k:
            yield np.unique(runs[begin : end - k + 1])
        elif end > begin:
            short = sum(int(w) * (2 * j + 3) for j, w in enumerate(words[begin:end])) + int(end - begin)
            yield mix(np.array([short % 2**64], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def _signature(elements: np.ndarray) -> int:
    """One word for a whole set: equal sets have equal ones, whatever the text."""
    order = np.arange(len(elements), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return int(mix(np.array([(mix(elements + order) * order).sum(dtype=np.uint64) + np.uint64(len(elements))]))[0].view(np.int64))


def _slots(elements: np.ndarray) -> bytes:
    counts = np.bincount((elements & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _rows(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


_SIZES = pa.schema([("row", pa.int64()), ("th", pa.int64()), ("n", pa.int32()), ("cls", pa.int64()), ("slots", pa.binary()), ("block", pa.int32()), ("counts", pa.binary())])
_POSTS = pa.schema([("kind", pa.int32()), ("h", pa.int64()), ("cls", pa.int64()), ("n", pa.int32())])
_SETS = pa.schema([("cls", pa.int64()), ("n", pa.int32()), ("elements", pa.binary())])


def _measured(k: int, bits: int) -> Callable:
    def measure(batches):
        """A row per document, then the task's counts of shingles by the first bits of their hash."""
        counts = np.zeros(1 << bits, np.int32)
        for batch in by_bytes(batches, "text"):
            size, cls, slots = [], [], []
            for found in shingle_sets(batch, "text", k):
                counts[found >> np.uint64(64 - bits)] += 1
                size.append(len(found))
                cls.append(_signature(found) if len(found) else None)
                slots.append(_slots(found) if len(found) else None)
            nothing = [None] * len(size)
            yield _rows(_SIZES, batch.column("id"), batch.column("th"), size, cls, slots, nothing, nothing)
        for block, part in enumerate(np.split(counts, _SKETCH_ROWS)):
            if part.any():
                yield _rows(_SIZES, [None], [None], [None], [None], [None], [block], [part.tobytes()])

    return measure


def _summed(batches):
    """Adds up the counts of each block as they stream by."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            total[block] = total.get(block, 0) + np.frombuffer(counts, np.int32).astype(np.int64)
    schema = pa.schema([("block", pa.int32()), ("counts", pa.binary())])
    for block, counts in total.items():
        yield _rows(schema, [block], [counts.tobytes()])


def _posted(k: int, limit: Threshold, boundary: int, bits: int, sketch) -> Callable:
    reach = min(limit.partners(boundary + 1), default=boundary + 1)

    def light_keys(found: np.ndarray) -> Iterator[tuple[int, int]]:
        n, whole = len(found), mix(found)
        total = int(whole.sum(dtype=np.uint64))
        parts = [int(x) for x in whole]
        for m in limit.partners(n):
            overlap = limit.overlap(n, m)
            if m <= boundary and overlap <= min(n, m):
                for dropped in combinations(parts, n - overlap):
                    key = total - sum(dropped) + 0x8CB92BA72F3D8DD7 * min(n, m) + 0xABC98388FB8FAC03 * max(n, m)
                    yield key % 2**64, _SAME if n == m else _OTHER

    def post(batches):
        counts, seen = sketch.value, set()
        for batch in by_bytes(batches, "text"):
            hashes, kinds, cls, size = [], [], [], []
            for found in shingle_sets(batch, "text", k):
                own = _signature(found) if len(found) else None
                if own is None or own in seen:
                    continue
                seen.add(own)
                if len(found) <= boundary:
                    keys, kind = zip(*light_keys(found), strict=True)
                    hashes.append(mix(np.array(keys, np.uint64)))
                    kinds.append(np.array(kind, np.int32))
                    cls.append((own, len(keys)))
                    size.append((len(found), len(keys)))
                if len(found) >= reach:
                    rarity = counts[found >> np.uint64(64 - bits)]
                    first = found[np.lexsort((found, rarity))[: limit.prefix(len(found))]]
                    hashes.append(first)
                    kinds.append(np.full(len(first), _LIST, np.int32))
                    cls.append((own, len(first)))
                    size.append((len(found), len(first)))
            if hashes:
                spread = lambda pairs, kind: np.repeat(np.array([p[0] for p in pairs], kind), [p[1] for p in pairs])
                yield _rows(_POSTS, np.concatenate(kinds), np.concatenate(hashes).view(np.int64), spread(cls, np.int64), spread(size, np.int32))

    return post


def _sets(k: int, wanted) -> Callable:
    def whole(batches):
        wants, seen = BitFilter(FILTER_BITS, wanted.value), set()
        for batch in by_bytes(batches, "text"):
            hit = wants.lets(batch.column("th").to_numpy())
            keep = [i for i in np.flatnonzero(hit).tolist() if not ((th := batch.column("th")[i].as_py()) in seen or seen.add(th))]
            if keep:
                found = list(shingle_sets(batch.take(pa.array(keep)), "text", k))
                yield _rows(_SETS, [_signature(f) for f in found], [len(f) for f in found], [f.tobytes() for f in found])

    return whole


def _compared(limit: Threshold, column: str, exact: bool) -> Callable:
    """Keeps the pairs whose overlap reaches the threshold, or whose slot counts leave that open."""

    def compare(batches):
        for batch in batches:
            sizes = zip(batch.column("na").to_pylist(), batch.column("nb").to_pylist(), strict=True)
            both = zip(batch.column(f"{column}_a").to_pylist(), batch.column(f"{column}_b").to_pylist(), strict=True)
            keep = []
            for (n, m), (a, b) in zip(sizes, both, strict=True):
                if exact:
                    keep.append(n + m - len(np.union1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64))) >= limit.overlap(n, m))
                else:
                    apart = np.abs(np.frombuffer(a, np.uint8).astype(np.int16) - np.frombuffer(b, np.uint8)).sum()
                    keep.append(bool(limit.close(n, m, int(apart))))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return compare


@dataclass(frozen=True)
class _Corpus:
    docs: DataFrame
    rows: DataFrame
    k: int
    limit: Threshold

    def sets(self, classes: DataFrame) -> DataFrame:
        """The whole sets of some classes, from the texts that a filter of fixed size lets through."""
        spark = self.docs.sparkSession
        wanted = spark.sparkContext.broadcast(BitFilter.of(self.rows.join(classes, "cls", "left_semi").select("th"), FILTER_BITS).packed)
        sets = saved(self.docs.mapInArrow(_sets(self.k, wanted), "cls long, n int, elements binary").join(classes, "cls", "left_semi"), "sets")
        wanted.destroy()
        return sets

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs that are links: by slot counts first; what these leave open, by the sets themselves.

        The pairs are written before each of the two, so that what finds them is planned and run once.
        """
        pairs = saved(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
        for column in ("slots", "elements"):
            if pairs.isEmpty():
                break
            classes = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
            if column == "slots":
                known = self.rows.join(classes, "cls", "left_semi").groupBy("cls").agg(F.min("n").alias("n"), F.min("slots").alias("slots"))
            else:
                known = self.sets(saved(classes, "classes"))  # asked for twice
            one = known.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col(column).alias(f"{column}_a"))
            other = known.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col(column).alias(f"{column}_b"))
            compared = pairs.join(one, "a").join(other, "b").mapInArrow(_compared(self.limit, column, column == "elements"), "a long, b long")
            pairs = saved(compared.distinct(), "pairs")
        return pairs


def _across(lists: DataFrame, labels: DataFrame, rows: DataFrame) -> DataFrame:
    """Lists with several components, dealt so that members of different ones meet in groups of bounded size.

    The members outside a list's largest component (its strays) are dealt to blocks, and all members to larger
    blocks; a group is one block of strays and one of members. So the largest component of a list is only
    compared with the strays, never with itself. Lists with one smallest member are dealt alike and next to
    each other, as they mostly bring the same pairs.
    """
    lists = lists.join(labels, "cls", "left").select("h", "cls", "n", "low", F.coalesce("component", "cls").alias("comp"))
    counts = lists.groupBy("h", "comp").agg(F.count("*").alias("own")).groupBy("h")
    counts = counts.agg(F.sum("own").alias("all"), F.max(F.struct("own", "comp")).alias("top")).filter("all > top.own")
    blocks = [F.ceil((F.col("all") - F.col("top.own")) / STRAYS).cast("int").alias("stray_blocks"), F.ceil(F.col("all") / MEMBERS).cast("int").alias("member_blocks")]
    lists = lists.join(counts.select("h", F.col("top.comp").alias("top"), *blocks), "h").withColumn("stray", F.col("comp") != F.col("top"))
    lists = lists.withColumn("i", F.pmod(F.xxhash64("cls", F.lit(1)), "stray_blocks").cast("int")).withColumn("j", F.pmod(F.xxhash64("cls", F.lit(2)), "member_blocks").cast("int"))
    as_member = F.transform(F.sequence(F.lit(0), F.col("stray_blocks") - 1), lambda i: F.struct(i.alias("i"), F.col("j").alias("j")))
    as_stray = F.transform(F.sequence(F.lit(0), F.col("member_blocks") - 1), lambda j: F.struct(F.col("i").alias("i"), j.alias("j")))
    places = F.when(F.col("stray"), F.array_union(as_member, as_stray)).otherwise(as_member)
    slots = rows.join(lists.select("cls").distinct(), "cls", "left_semi").groupBy("cls").agg(F.min("slots").alias("slots"))
    dealt = lists.join(slots, "cls").withColumn("at", F.explode(places))
    left, right = F.col("stray") & (F.col("at.i") == F.col("i")), F.col("at.j") == F.col("j")
    dealt = dealt.select(F.xxhash64("low", "at.i", "at.j").alias("part"), F.xxhash64("h", "at.i", "at.j").alias("grp"), left.alias("left"), right.alias("right"), "stray", "cls", "n", "comp", "slots")
    return dealt.repartition("part").sortWithinPartitions("part", "grp")


def _met(limit: Threshold, closest: bool) -> Callable:
    """Pairs of a stray and another member in different components whose sizes and slot counts fit.

    With ``closest`` only the nearest such member of each component, by slot counts.
    """

    seen: set[tuple[int, int]] = set()

    def meet(batches):
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if rest is not None:
                batch = pa.concat_batches([rest, batch])
            group = batch.column("grp").to_numpy()
            cut = int(np.append(np.flatnonzero(group != group[-1]), -1).max()) + 1  # the last group may go on in the next batch
            rest = batch.slice(cut)
            if cut:
                yield pairs(batch.slice(0, cut))
        if rest is not None:
            yield pairs(rest)

    def pairs(batch):
        group, cls, size, comp = (batch.column(name).to_numpy() for name in ("grp", "cls", "n", "comp"))
        left, right, stray = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("left", "right", "stray"))
        slots = np.frombuffer(b"".join(batch.column("slots").to_pylist()), np.uint8).reshape(-1, SLOTS)
        edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
        begin, end = np.repeat(edge[:-1], np.diff(edge)), np.repeat(edge[1:], np.diff(edge))
        found: list[list] = [[], []]
        strays = np.flatnonzero(left)
        for some in np.split(strays, np.flatnonzero(np.diff(np.cumsum((end - begin)[strays]) // 200_000)) + 1):
            count = end[some] - begin[some]
            one = np.repeat(some, count)
            other = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - begin[some], count)
            fit = right[other] & (comp[one] != comp[other]) & (~stray[other] | (cls[one] < cls[other]))
            fit &= np.minimum(size[one], size[other]).astype(np.int64) * limit.den >= np.maximum(size[one], size[other]).astype(np.int64) * limit.num
            one, other = one[fit], other[fit]
            apart = np.abs(slots[one].astype(np.int16) - slots[other]).sum(axis=1, dtype=np.int64)
            fit = limit.close(size[one].astype(np.int64), size[other].astype(np.int64), apart)
            one, other, apart = one[fit], other[fit], apart[fit]
            if closest:
                order = np.lexsort((apart, comp[other], one))
                one, other = one[order], other[order]
                first = np.concatenate([[True], (one[1:] != one[:-1]) | (comp[other[1:]] != comp[other[:-1]])])[: len(one)]
                one, other = one[first], other[first]
            found[0].append(cls[one])
            found[1].append(cls[other])
        columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in found]
        new = set(zip(columns[0].tolist(), columns[1].tolist(), strict=True)) - seen
        if len(seen) > REMEMBERED:  # pairs come again soon or not at all
            seen.clear()
        seen.update(new)
        return pa.record_batch([pa.array([p[k] for p in new], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return meet


def _boundary(sizes: dict[int, int], limit: Threshold, scan_cost: float) -> int:
    """The size up to which enumerating subsets and scanning lists for the rest cost least together."""

    def cost(boundary: int) -> float:
        reach = min(limit.partners(boundary + 1), default=boundary + 1)
        light = sum(c * limit.subsets(n) for n, c in sizes.items() if n <= boundary)
        return light + scan_cost * sum(c * limit.prefix(n) for n, c in sizes.items() if n >= reach)

    return min(range(_LIGHT_SIZES + 1), key=cost)


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100, sketch_bits: int = 20, scan_cost: float = 4.0, hashes: bool = False
) -> DataFrame:
    """A row per document: its id, ``n_shingles``, and ``component_id``, the smallest id that links reach from it.

    Words are maximal runs of anything but ASCII white space, A-Z lower-cased; a set holds the distinct
    ``k``-word shingles of the whole text, or the whole sequence if that has fewer words. Two documents link
    when ``den * overlap >= num * union``. A null or blank text has an empty set, links with nothing and is
    its own component. Repeated rows are returned as often as given. Ids are 64-bit integers; a row with a
    null id links like any other and takes the smallest id of its component, null if that has none. Other
    columns are ignored. An empty table gives an empty result. With ``hashes`` each row also has ``text_hash``
    and that of the text that stands for its component, the smallest of those under ``component_id``: where ids
    repeat, the two tell which row that is.

    Documents of one set are one class throughout. ``sketch_bits`` sets the size of the table of shingle
    counts that orders shingles from rare to frequent (4 bytes each, whatever the input): any order gives the
    same links, a good one keeps the lists short. ``scan_cost`` is what one list entry costs, in subset keys.
    Per list, all members are first compared with the smallest one, then strays with the nearest member of each
    other component; only members that are then still in different components are all compared with each other,
    so a large group of near copies is not paired out.
    """
    spark, limit = docs.sparkSession, Threshold(num, den)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    measured = saved(docs.mapInArrow(_measured(k, sketch_bits), "row long, th long, n int, cls long, slots binary, block int, counts binary"), "sizes")
    rows = measured.filter("block is null")
    sums = measured.filter("block is not null").select("block", "counts").repartition(_SKETCH_ROWS, "block").mapInArrow(_summed, "block int, counts binary")
    counts = np.zeros((_SKETCH_ROWS, (1 << sketch_bits) // _SKETCH_ROWS), np.int32)
    for block, part in sums.collect():
        counts[block] = np.minimum(np.frombuffer(part, np.int64), 2**31 - 1)
    sizes = dict(rows.filter(f"n between 1 and {den * _LIGHT_SIZES // num + 2}").groupBy("n").count().collect())
    sketch = spark.sparkContext.broadcast(counts.reshape(-1))

    posts = docs.filter("text is not null").mapInArrow(_posted(k, limit, _boundary(sizes, limit, scan_cost), sketch_bits, sketch), "kind int, h long, cls long, n int")
    by_size = Window.partitionBy("kind", "h").orderBy("n", "cls")
    posts = posts.withColumn("last", F.lag("cls").over(by_size)).filter("last is null or last != cls")
    # least() and greatest() pass over nulls, so a missing neighbour must be asked for.
    near = lambda other: F.col(other).isNotNull() & (F.least("n", other) * den >= F.greatest("n", other) * num)
    posts = posts.withColumn("smaller", F.lag("n").over(by_size)).withColumn("larger", F.lead("n").over(by_size))
    met = F.when(F.col("kind") != _LIST, F.col("smaller").isNotNull() | F.col("larger").isNotNull()).otherwise(near("smaller") | near("larger"))
    ends = Window.partitionBy("kind", "h").orderBy("n", "cls").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    low, high = F.first(F.struct("n", "cls")).over(ends), F.last(F.struct("n", "cls")).over(ends)
    posts = saved(posts.filter(met).select("kind", "h", "cls", "n").withColumn("low", low).withColumn("high", high), "posts")
    sketch.destroy()

    corpus = _Corpus(docs, rows, k, limit)
    to_low = posts.select("kind", F.col("cls").alias("a"), F.col("low.cls").alias("b"), "n", F.col("low.n").alias("m")).filter("a != b")
    to_high = posts.filter((F.col("kind") == _OTHER) & (F.col("n") < F.col("high.n"))).select(F.col("cls").alias("a"), F.col("high.cls").alias("b"))
    stars = to_low.filter((F.col("kind") == _LIST) & (F.col("m") * den >= F.col("n") * num)).select("a", "b")
    subsets = to_low.filter((F.col("kind") == _SAME) | ((F.col("kind") == _OTHER) & (F.col("m") < F.col("n")))).select("a", "b").union(to_high)
    found = saved(corpus.linked(stars).union(subsets).distinct(), "edges")

    # Each list's smallest member has met all others by now.
    rest = posts.filter((F.col("kind") == _LIST) & (F.col("cls") != F.col("low.cls"))).select("h", "cls", "n", F.col("low.cls").alias("low"))
    for closest, label in ((True, groups), (False, components)):
        labels = label(found).withColumnRenamed("node", "cls")
        pairs = _across(rest, labels, rows).mapInArrow(_met(limit, closest), "a long, b long")
        new = corpus.linked(pairs)
        found = found.union(new)
    # Without a new link in the second round its labels are those of the end.
    labels = labels if new.isEmpty() else components(found).withColumnRenamed("node", "cls")

    own = F.struct("row", "th")
    classes = rows.filter("cls is not null").groupBy("cls").agg(F.min(F.when(F.col("row").isNotNull(), own)).alias("low"))
    classes = classes.join(labels, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    lowest = classes.groupBy("component").agg(F.min("low").alias("lowest"))
    of_class = classes.join(lowest, "component").select("cls", "lowest")
    result = rows.join(of_class, "cls", "left")
    whole = F.when(F.col("cls").isNull(), own).otherwise(F.col("lowest"))
    columns = [F.col("row").alias(id_col), F.col("n").cast("long").alias("n_shingles"), whole["row"].alias("component_id")]
    return result.select(*columns, *([F.col("th").alias("text_hash"), whole["th"].alias("component_hash")] if hashes else []))
