"""Removal of sentences that stand in a repeated run of sentences, but for its first place.

From each sentence a run of consecutive ones is hashed, just long enough to have several sentences and enough
words to be a passage. Hashes meet in one grouped minimum that finds the first place of each run that occurs
more than once, and the runs at other places are found again by a join.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from webcapture.llm.common import OTHER_BASE, BitFilter, Hasher, by_bytes, saved, utf8

#: Size, as a power of two, of the filter that picks the runs worth joining.
FILTER_BITS = 26
_STOPS, _BLANKS = np.zeros(256, bool), np.zeros(256, bool)
_STOPS[[ord(c) for c in ".!?\n"]] = True
_BLANKS[[ord(c) for c in "\t\n\f\r "]] = True


def sentence_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of each sentence, its end without white space behind it, and how many precede each text.

    A sentence is anything up to a run of full stops, question or exclamation marks or line ends, and the white
    space after that; the rest of a text is its last sentence. Sentences of a text, joined, are the text.
    """
    place = np.arange(len(data))
    stop, blank = _STOPS[data], _BLANKS[data]
    last = lambda where: np.maximum.accumulate(np.where(where, place, -1))
    last_stop, last_other = last(stop), last(~stop & ~blank)
    new = np.zeros(len(data), bool)
    new[1:] = ~blank[1:] & (last_stop[:-1] > last_other[:-1]) & ~(stop[1:] & stop[:-1])
    begin = offsets[:-1][offsets[:-1] < offsets[1:]]
    # What precedes a text says nothing about its first bytes: blanks and stops there belong to its first sentence.
    text = np.repeat(offsets[:-1], np.diff(offsets))
    new[1:] &= last_stop[:-1] >= text[1:]
    new[begin] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    solid = last(~blank)
    return starts, np.maximum(solid[ends - 1] + 1, starts), np.searchsorted(starts, offsets)


def _runs(data: np.ndarray, starts: np.ndarray, first: np.ndarray, span: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last sentence of each run; sentences too near the end of their text begin none."""
    solid = ~_BLANKS[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    begins[starts] = solid[starts]
    before = np.append(0, np.cumsum(begins))[np.append(starts, len(data))]
    begin = np.arange(len(starts))
    last = np.maximum(np.searchsorted(before, before[:-1] + words) - 1, begin + span - 1)
    fit = last < np.repeat(first[1:], np.diff(first))
    return begin[fit], last[fit]


def _hashed(span: int, words: int, wanted=None) -> Callable:
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("id", pa.int64()), ("th", pa.int64()), ("at", pa.int32())])

    def hash_runs(batches):
        for batch in by_bytes(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            starts, ends, first = sentence_places(data, offsets)
            begin, last = _runs(data, starts, first, span, words)
            h1 = Hasher(data)(starts[begin], ends[last]).view(np.int64)
            if wanted is not None:
                keep = wanted.value.lets(h1)
                begin, last, h1 = begin[keep], last[keep], h1[keep]
            h2 = Hasher(data, OTHER_BASE)(starts[begin], ends[last]).view(np.int64)
            row = np.searchsorted(first, begin, "right") - 1
            ids, th = (batch.column(name).take(pa.array(row)) for name in ("id", "th"))
            yield pa.record_batch([pa.array(h1), pa.array(h2), ids, th, pa.array((begin - first[row]).astype(np.int32))], schema=schema)

    return hash_runs


def _dropped(span: int, words: int) -> Callable:
    schema = pa.schema([("id", pa.int64()), ("n_sentences", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def drop(batches):
        for batch in by_bytes(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            starts, _, first = sentence_places(data, offsets)
            begin, last = _runs(data, starts, first, span, words)
            run_end = np.zeros(len(starts), np.int64)
            run_end[begin] = last + 1
            ends = np.append(starts[1:], len(data))
            raw, rows = data.tobytes(), []
            for k, (doc, runs) in enumerate(zip(batch.column("id").to_pylist(), batch.column("runs").to_pylist(), strict=True)):
                a, b = int(first[k]), int(first[k + 1])
                if not runs:
                    rows.append((doc, b - a, 0, raw[offsets[k] : offsets[k + 1]].decode()))
                    continue
                gone = np.zeros(b - a, bool)
                for at in runs:
                    gone[at : run_end[a + at] - a] = True
                kept = b"".join(raw[starts[a + j] : ends[a + j]] for j in np.flatnonzero(~gone))
                rows.append((doc, b - a, int(gone.sum()), kept.decode()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return drop


def remove_repeated_sentences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 2, words: int = 20) -> DataFrame:
    """A row per document: its id, ``n_sentences``, ``n_removed`` sentences, and ``kept``, the text that stays.

    A run begins at any sentence and ends with the first one by which it has at least ``span`` sentences and
    ``words`` words, within its text. A sentence goes if any run that covers it has occurred before: at a smaller
    id, or earlier in the same text. Texts too short for a run stay whole. Runs are equal if their bytes are,
    white space at the end aside; words stand between white space. Null texts have no sentences and stay empty. Ids are 64-bit integers, null ones come
    last; rows that repeat both id and text are one document, returned as often as given. Other columns are
    ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    some, types = docs.filter("text != ''"), "h1 long, h2 long, id long, th long, at int"
    place = F.struct(F.col("id").isNull().alias("late"), "id", "th", "at")
    runs = some.mapInArrow(_hashed(span, words), types).groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    firsts = saved(runs.filter("first != last").select("h1", "h2", "first"), "first_runs")
    wanted = spark.sparkContext.broadcast(BitFilter.of(firsts.select("h1"), FILTER_BITS))
    again = some.mapInArrow(_hashed(span, words, wanted), types).join(firsts, ["h1", "h2"]).filter(place != F.col("first"))
    found = again.groupBy("id", "th").agg(F.collect_set("at").alias("runs")).select(F.col("id").alias("run_id"), F.col("th").alias("run_th"), "runs")
    whole = docs.join(found, F.col("id").eqNullSafe(F.col("run_id")) & (F.col("th") == F.col("run_th")), "left").select("id", "text", "runs")
    dropped = whole.mapInArrow(_dropped(span, words), "id long, n_sentences long, n_removed long, kept string")
    return dropped.withColumnRenamed("id", id_col)
