"""Benchmark passages in documents, by a positional inverted index that is dealt over the documents.

Each row of the index is a shard: the postings of all words of some whole documents, sorted by word and
place. Benchmark windows are looked up in every shard: the places of a window's rarest word (rarest over all
shards) are shifted by the word's place in the window, and cut with the shifted places of the next rarest
word until all words have agreed. Words never leave their shard, so no word, however frequent, makes a group.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from webcapture.functions.batches import pieces
from webcapture.llm.common import LOWER, Hasher, by_bytes, saved, utf8, word_places

#: Digits, letters and everything beyond ASCII; upper case has been lowered before.
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True
#: Text of documents in a shard, and of benchmark items that are looked up (and broadcast) together.
SHARD_BYTES, BLOCK_BYTES = 4 << 20, 4 << 20

_SHARD = pa.schema(
    [("shard", pa.string()), ("ids", pa.list_(pa.int64())), ("first", pa.binary()), ("terms", pa.binary()), ("counts", pa.binary()), ("places", pa.binary())]
)


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in a row, and how many precede each text. Texts are hashed piece by piece."""
    words, first = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for piece in pieces([texts]):
        data, offsets = utf8(piece)
        data = LOWER[data]
        starts, ends, own = word_places(data, offsets, WORD)
        words.append(Hasher(data)(starts, ends))
        first.append(own[1:] + first[-1][-1])
    return np.concatenate(words), np.concatenate(first)


def _posted(batches):
    for batch in by_bytes(batches, "text", SHARD_BYTES):
        words, first = _words(batch.column("text"))
        order = np.argsort(words, kind="stable")
        ordered = words[order]
        new = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(words) else np.zeros(0, np.int64)
        places = order.astype(np.int32)
        steps = np.diff(places, prepend=np.int32(0))
        steps[new] = places[new]
        packed = pa.compress(steps.tobytes(), codec="zstd", asbytes=True)
        counts = np.diff(np.append(new, len(words))).astype(np.int32)
        blobs = [[x] for x in (first.astype(np.int32).tobytes(), ordered[new].tobytes(), counts.tobytes(), packed)]
        ids = pa.array([batch.column("id").to_pylist()], pa.list_(pa.int64()))
        yield pa.record_batch([pa.array([uuid.uuid4().hex]), ids, *(pa.array(b, pa.binary()) for b in blobs)], schema=_SHARD)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Positional postings of every word of ``docs``, written to the shared folder: a row per shard.

    A document is never parted, so a shard holds ``SHARD_BYTES`` of text or one longer document. Null texts
    have no words; ids are 64-bit integers, null or repeated as they come.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return saved(docs.mapInArrow(_posted, "shard string, ids array<long>, first binary, terms binary, counts binary, places binary"), "postings")


@dataclass
class Windows:
    """Different windows of some items, as rows of places in ``vocabulary``; shorter windows end in -1."""

    items: list[str]
    item: np.ndarray
    vocabulary: np.ndarray
    terms: np.ndarray


def _windows(items: list[tuple[str, str]], width: int) -> Windows:
    words, first = _words(pa.array([text for _, text in items], pa.string()))
    vocabulary, known = np.unique(words, return_inverse=True)
    rows, owner = [], []
    for k, (begin, end) in enumerate(zip(first[:-1], first[1:], strict=True)):
        for start in range(begin, max(end - width, begin) + 1 if end > begin else begin):
            row = np.full(width, -1, np.int64)
            part = known[start : min(start + width, end)]
            row[: len(part)] = part
            rows.append(row)
            owner.append(k)
    # Equal windows of an item, as in a row of repeated words, find the same places.
    own = np.unique(np.column_stack([np.array(owner, np.int64), np.array(rows, np.int64).reshape(-1, width)]), axis=0)
    return Windows([i for i, _ in items], own[:, 0], vocabulary, own[:, 1:])


def _blocks(items: DataFrame, width: int) -> Iterator[Windows]:
    block, size = [], 0
    for item, text in items.toLocalIterator():
        block.append((item or "", text or ""))
        size += len(block[-1][1].encode()) + 64
        if size >= BLOCK_BYTES:
            yield _windows(block, width)
            block, size = [], 0
    if block:
        yield _windows(block, width)


def _places_in(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted value stands in the sorted known ones, and whether it does."""
    at = np.searchsorted(known, wanted)
    return at, np.append(known, np.uint64(0))[at] == np.where(at < len(known), wanted, np.uint64(1))


def _counted(shared) -> Callable:
    def count(batches):
        vocabulary = shared.value.vocabulary
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for terms, counts in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                terms, counts = np.frombuffer(terms, np.uint64), np.frombuffer(counts, np.int32)
                at, hit = _places_in(vocabulary, terms)
                total[at[hit]] += counts[hit]
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["term", "n"])

    return count


def _postings(places: bytes, counts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The places of some words, each list sorted, one after another."""
    steps = np.frombuffer(pa.decompress(places, int(counts.sum()) * 4, codec="zstd", asbytes=True), np.int32)
    begin = np.cumsum(counts) - counts
    own = counts[wanted].astype(np.int64)
    rank = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
    running = np.cumsum(steps[np.repeat(begin[wanted], own) + rank], dtype=np.int64)
    before = np.concatenate([[0], running])[np.cumsum(own) - own]
    return running - np.repeat(before, own)


def _agreed(windows: Windows, order: np.ndarray, first: np.ndarray, terms: np.ndarray, counts: np.ndarray, places: bytes, slop: int) -> tuple[np.ndarray, ...]:
    """Windows and the places where they begin: rarest word's places, cut with those of the next ones."""
    at, present = _places_in(terms, windows.vocabulary)
    window = np.flatnonzero((present[windows.terms] | (windows.terms < 0)).all(axis=1))
    nothing = np.zeros(0, np.int64)
    if not len(window):
        return nothing, nothing
    wanted = np.flatnonzero(present)
    own = counts[at[wanted]].astype(np.int64)
    lists = _postings(places, counts, at[wanted])
    ends = np.zeros(len(windows.vocabulary) + 1, np.int64)
    ends[wanted + 1] = own
    ends = np.cumsum(ends)
    keys = (np.repeat(wanted, own) << 32) | lists
    rare = windows.terms[window, order[window, 0]]
    size = ends[rare + 1] - ends[rare]
    rank = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    lead = lists[np.repeat(ends[rare], size) + rank]
    window = np.repeat(window, size)
    start = lead - order[window, 0]
    doc = np.searchsorted(first, lead, "right") - 1
    low, high = first[doc].astype(np.int64), first[doc + 1].astype(np.int64) - 1
    for step in range(windows.terms.shape[1]):
        offset = order[window, step]
        term = windows.terms[window, offset]
        least, most = np.maximum(start + offset - slop, low), np.minimum(start + offset + slop, high)
        found = np.searchsorted(keys, (term << 32) | least)
        agree = (least <= most) & (found < len(keys)) & (keys[np.minimum(found, len(keys) - 1)] <= ((term << 32) | most))
        agree |= term < 0
        window, start, low, high = window[agree], start[agree], low[agree], high[agree]
    return window, np.maximum(start, low)


_HITS = pa.schema(
    [("shard", pa.string()), ("row", pa.int32()), ("id", pa.int64()), ("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string()))]
)


def _matched(shared, slop: int) -> Callable:
    def match(batches):
        windows, order = shared.value
        length = (windows.terms >= 0).sum(axis=1)
        for batch in batches:
            for shard, ids, first, terms, counts, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                first = np.frombuffer(first, np.int32)
                window, start = _agreed(windows, order, first, np.frombuffer(terms, np.uint64), np.frombuffer(counts, np.int32), places, slop)
                doc = np.searchsorted(first, start, "right") - 1
                end = np.minimum(start + length[window], first[doc + 1])
                hits: list[list] = [[] for _ in ids]
                for d, begin, stop in sorted(zip(doc.tolist(), (start - first[doc]).tolist(), (end - first[doc]).tolist(), strict=True)):
                    if hits[d] and begin <= hits[d][-1]["end"]:
                        hits[d][-1]["end"] = max(hits[d][-1]["end"], stop)
                    else:
                        hits[d].append({"begin": begin, "end": stop})
                items: list[set] = [set() for _ in ids]
                for d, k in zip(doc.tolist(), windows.item[window].tolist(), strict=True):
                    items[d].add(windows.items[k])
                columns = [[shard] * len(ids), list(range(len(ids))), ids, np.diff(first), hits, [sorted(x) for x in items]]
                yield pa.record_batch([pa.array(x, t) for x, t in zip(columns, _HITS.types, strict=True)], schema=_HITS)

    return match


def find_items(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = 13, slop: int = 0) -> DataFrame:
    """``id, n_words, hits, items`` for every document of ``index``, in which windows of ``items`` are looked up.

    Words are runs of digits, letters and non-ASCII bytes, A-Z lower-cased. A window is ``width`` words of an
    item in a row; an item of fewer words is one window, of none has none. ``hits`` are the maximal runs of
    document words (``begin`` to before ``end``) inside a match, ``items`` the ids, as text and sorted, of
    items with a match. With ``slop`` 0 a match is the exact phrase; otherwise every word must stand, in the
    same document, within ``slop`` words of where the rarest one puts it. A null item id reads as an empty
    text, repeated items count once, null texts have no windows. Without items every document has no hits.

    Items are looked up in blocks of ``BLOCK_BYTES`` of text, each broadcast on its own.
    """
    spark = index.sparkSession
    items = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    schema = "shard string, row int, id long, n_words long, hits array<struct<begin:int,end:int>>, items array<string>"
    parts = []
    for windows in _blocks(items, width):
        shared = spark.sparkContext.broadcast(windows)
        counts = index.select("terms", "counts").mapInArrow(_counted(shared), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        frequency = np.zeros(len(windows.vocabulary) + 1, np.int64)
        for term, n in counts.collect():
            frequency[term] = n
        frequency[-1] = np.iinfo(np.int64).max  # of no word, at the end of a short window
        order = np.argsort(frequency[windows.terms], axis=1, kind="stable")
        parts.append(index.mapInArrow(_matched(spark.sparkContext.broadcast((windows, order)), slop), schema))
    if not parts:
        parts.append(index.mapInArrow(_matched(spark.sparkContext.broadcast((_windows([], width), np.zeros((0, width), np.int64))), slop), schema))
    if len(parts) == 1:
        return parts[0].select("id", "n_words", "hits", "items")
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    merged = every.groupBy("shard", "row").agg(
        F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("hits"))).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    joined = F.expr(
        """aggregate(runs, cast(array() as array<struct<begin:int,end:int>>), (a, x) -> CASE
        WHEN size(a) > 0 AND x.begin <= element_at(a, -1).end THEN
        concat(slice(a, 1, size(a) - 1), array(named_struct('begin', element_at(a, -1).begin, 'end', greatest(element_at(a, -1).end, x.end))))
        ELSE concat(a, array(x)) END)"""
    )
    return merged.select("id", "n_words", joined.alias("hits"), "items")


def contamination(found: DataFrame, share: float = 0.05) -> DataFrame:
    """Adds ``n_hit`` and ``contaminated``: some word is hit, and at least ``share`` of all words are."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, run: total + (run.end - run.begin))
    found = found.withColumn("n_hit", n_hit)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") >= F.ceil(F.lit(share) * F.col("n_words") - F.lit(1e-9))))
