"""Removal of long byte strings that occur more than once, by run-length suffix indexes over shared regions.

Every ``length``-byte string holds an anchor: its ``gram`` bytes of smallest hash. Equal strings hold equal
anchors at equal places, so only strings around one anchor need to meet. The strings around an anchor of a
text form its context, and contexts of one anchor go to one index: a Burrows-Wheeler transform kept as runs,
with the suffix places and common prefixes sampled at the run ends. Between run ends the matching statistics
fall by one per byte, so streaming the samples over the contexts yields for every byte how far a match with
another place reaches. Bytes within reach of a match of ``length`` bytes or more are marked.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from webcapture.llm.common import OTHER_BASE, Hasher, by_bytes, mix, saved, utf8

#: Bits of the value compared for anchors that hold the place, so that the first of equal hashes wins.
_PLACE_BITS = 28
#: Bytes of contexts that one index takes, unless a single anchor has more. An index holds about 60 bytes for each.
INDEX_BYTES = 1 << 20
#: Distinct contexts of one anchor that go to one index; beyond it their strings get longer anchors.
MOST_CONTEXTS = 12_000

_ANCHORS = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("id", pa.int64()), ("th", pa.int64()), ("start", pa.int64()), ("size", pa.int64())])
_TYPES = "h long, c long, id long, th long, start long, size long"


def contexts(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, context hash, place and size of each context; strings never cross texts.

    A context is the union of neighbouring ``length``-byte strings with the same anchor. Every such string of
    the texts is in exactly one context.
    """
    if len(data) < length:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    hasher, width = Hasher(data), length - gram + 1
    place = np.arange(len(data) - gram + 1)
    grams = hasher(place, place + gram)
    bits = max(_PLACE_BITS, len(grams).bit_length())
    value = (grams >> np.uint64(bits) << np.uint64(bits)) | place.astype(np.uint64)
    value = np.concatenate([value, np.full(-len(value) % width, 2**64 - 1, np.uint64)]).reshape(-1, width)
    before = np.minimum.accumulate(value, axis=1).ravel()
    after = np.minimum.accumulate(value[:, ::-1], axis=1)[:, ::-1].ravel()
    strings = len(data) - length + 1
    anchor = np.minimum(after[:strings], before[width - 1 : width - 1 + strings]) & np.uint64((1 << bits) - 1)
    inside = np.arange(strings) + length <= np.repeat(offsets[1:], np.diff(offsets))[:strings]
    string, anchor = np.flatnonzero(inside), anchor[inside].astype(np.int64)
    if not len(string):
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (string[1:] != string[:-1] + 1)]))
    first, last = string[new], string[np.append(new[1:], len(string)) - 1]
    anchor = anchor[new]
    own = mix(hasher(first, last + length) + (anchor - first).astype(np.uint64))
    return grams[anchor], own, first, last - first + length


def _anchored(length: int, gram: int) -> Callable:
    def anchor(batches):
        for batch in by_bytes(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            h, c, start, size = contexts(data, offsets, length, gram)
            row = np.searchsorted(offsets, start, "right") - 1
            ids, th = (batch.column(name).take(pa.array(row)) for name in ("id", "th"))
            columns = [h.view(np.int64), c.view(np.int64), ids, th, start - offsets[row], size]
            yield pa.record_batch([pa.array(x) if isinstance(x, np.ndarray) else x for x in columns], schema=_ANCHORS)

    return anchor


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order, by doubling the compared prefix; settled places are left alone."""
    n = len(text)
    place = np.int32 if n < 2**30 else np.int64
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key <<= np.uint64(8)
        key |= padded[j : j + n]
    order = np.argsort(key).astype(place)
    key = key[order]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    del key, padded
    slots, known = np.arange(n, dtype=place), 8
    rank = np.empty(n, place)
    rank[order] = np.maximum.accumulate(np.where(first, slots, place(0)))
    while True:
        slots = slots[~(first & np.append(first[1:], True))]
        if not len(slots):
            return order
        places = order[slots]
        # The rank of what follows the known prefix, from 1; 0 where the text ends with it.
        key = rank[places].astype(np.uint64)
        key *= np.uint64(n + 1)
        tail = np.flatnonzero(places < n - known)
        key[tail] += (rank[places[tail] + place(known)] + place(1)).astype(np.uint64)
        del tail
        by_key = np.argsort(key)
        places, key = places[by_key], key[by_key]
        del by_key
        order[slots] = places
        first = np.concatenate([[True], key[1:] != key[:-1]])
        rank[places] = np.maximum.accumulate(np.where(first, slots, place(0)))
        known *= 2


def repeated_bytes(strings: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Marks every byte within a match of ``length`` bytes or more between two places of the strings.

    Returns the marks over the joined strings and the place of each string in them. The strings are different
    from each other. A match never crosses the end of a string.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    # The separator is byte 0xFF, which UTF-8 never uses; zero bytes stay what they are.
    text = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8)
    ends = np.repeat(starts + sizes, sizes + 1)
    order = suffix_array(text)
    before = text[order - 1]
    # Run ends of the transform; what precedes a string's first byte equals nothing.
    heads = 1 + np.flatnonzero((before[1:] != before[:-1]) | (before[1:] == 0xFF))
    one, other = order[heads - 1], order[heads]
    room = np.minimum(ends[one] - one, ends[other] - other)
    fit = room >= length
    one, other, room = one[fit], other[fit], room[fit]
    hasher = Hasher(text)
    same = hasher(one, one + length) == hasher(other, other + length)
    one, other, most = one[same], other[same], room[same]
    least = np.full(len(one), length, np.int64)
    while (least < most).any():
        middle = (least + most + 1) // 2
        same = hasher(one, one + middle) == hasher(other, other + middle)
        least, most = np.where(same, middle, least), np.where(same, most, middle - 1)
    reach = np.zeros(len(text), np.int64)
    np.maximum.at(reach, one, one + least)
    np.maximum.at(reach, other, other + least)
    return np.maximum.accumulate(reach) > np.arange(len(text)), starts


def _within(length: int, gram: int) -> Callable:
    """Contexts by a longer anchor, of the strings in given ranges of each text only."""

    def anchor(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids, ths, ranges = (batch.column(name).to_pylist() for name in ("id", "th", "ranges"))
            for text, i, th, parts in zip(texts, ids, ths, ranges, strict=True):
                raw = np.frombuffer(text.encode(), np.uint8)
                parts = [(p["start"], p["size"]) for p in parts]
                offsets = np.concatenate([[0], np.cumsum([size for _, size in parts])])
                h, c, start, size = contexts(np.concatenate([raw[a : a + b] for a, b in parts]), offsets, length, gram)
                part = np.searchsorted(offsets, start, "right") - 1
                start = start - offsets[part] + np.array([a for a, _ in parts])[part]
                columns = [h.view(np.int64), c.view(np.int64), [i] * len(h), [th] * len(h), start, size]
                yield pa.record_batch([pa.array(x, t) for x, t in zip(columns, _ANCHORS.types, strict=True)], schema=_ANCHORS)

    return anchor


def _cut(batches):
    """The bytes of each wanted context."""
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("n", pa.int64()), ("bytes", pa.binary())])
    for batch in batches:
        for text, parts in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
            raw = text.encode()
            rows = [(p["h"], p["c"], p["n"], raw[p["start"] : p["start"] + p["size"]]) for p in parts]
            yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


_MARKS = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("begin", pa.int64()), ("end", pa.int64())])


def _marks(group: list[tuple], length: int) -> pa.RecordBatch:
    """Runs of marked bytes in each context; of a context held by several places all bytes are marked."""
    marked, starts = repeated_bytes([row[3] for row in group], length)
    edges = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    of = np.searchsorted(starts, begin, "right") - 1
    many = np.array([row[2] > 1 for row in group])
    begin, end, of = begin[~many[of]], end[~many[of]], of[~many[of]]
    whole = np.flatnonzero(many)
    sizes = np.array([len(row[3]) for row in group])
    h, c = (np.array([row[k] for row in group], np.int64) for k in (0, 1))
    rows = np.concatenate([of, whole])
    columns = [h[rows], c[rows], np.concatenate([begin - starts[of], whole * 0]), np.concatenate([end - starts[of], sizes[whole]])]
    return pa.record_batch([pa.array(x) for x in columns], schema=_MARKS)


def _indexed(length: int, limit: int) -> Callable:
    """One index per group of whole anchors, as they come sorted."""

    def index(batches):
        group: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if last is not None and row[:2] == last[:2]:
                    continue  # the same context from a repeated row
                if size >= limit and row[0] != last[0]:
                    yield _marks(group, length)
                    group, size = [], 0
                group.append(row)
                size, last = size + len(row[3]), row
        if group:
            yield _marks(group, length)

    return index


def repeated_spans(docs: DataFrame, length: int, gram: int, most: int = MOST_CONTEXTS) -> DataFrame:
    """``id, th, begin, end`` for each part of ``docs`` (``id, th, text``) that a longer match covers."""
    found, held = None, None
    grams = [gram, (gram + length) // 2, length]
    rows = docs.filter(F.octet_length("text") >= length).mapInArrow(_anchored(length, gram), _TYPES)
    for level, own in enumerate(grams):
        # Counted where they meet: most anchors stand alone and are never written.
        places = F.count("*").over(Window.partitionBy("h"))
        rows = saved(rows.withColumn("places", places).filter("places > 1").drop("places"), "held")
        distinct = rows.groupBy("h", "c").agg(F.count("*").alias("n"), F.min(F.struct(F.col("id").isNull(), "id", "th", "start", "size")).alias("one"))
        hot = saved(distinct.groupBy("h").count().filter(F.col("count") > most).select("h"), "hot") if own < length else None
        crowded = hot is not None and not hot.isEmpty()
        if crowded:
            distinct = distinct.join(hot, "h", "left_anti")
        wanted = distinct.select("h", "c", "n", "one.*").groupBy("id", "th").agg(F.collect_list(F.struct("h", "c", "n", "start", "size")).alias("ranges"))
        texts = _with_text(docs, wanted)
        strings = texts.mapInArrow(_cut, "h long, c long, n long, bytes binary").repartition("h").sortWithinPartitions("h", "c")
        marks = strings.mapInArrow(_indexed(length, INDEX_BYTES), "h long, c long, begin long, end long")
        spans = rows.join(marks, ["h", "c"]).select("id", "th", (F.col("start") + F.col("begin")).alias("begin"), (F.col("start") + F.col("end")).alias("end"))
        found = spans if found is None else found.union(spans)
        if not crowded:
            return found
        ranges = rows.join(hot, "h", "left_semi").groupBy("id", "th").agg(F.collect_set(F.struct("start", "size")).alias("ranges"))
        rows = _with_text(docs, ranges).mapInArrow(_within(length, grams[level + 1]), _TYPES)
    return found


def _with_text(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    wanted = wanted.select(F.col("id").alias("wanted_id"), F.col("th").alias("wanted_th"), "ranges")
    return docs.join(wanted, F.col("id").eqNullSafe(F.col("wanted_id")) & (F.col("th") == F.col("wanted_th"))).select("id", "th", "text", "ranges")


_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_LETTER = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
_STRINGS = pa.schema([("h", pa.int64()), ("h2", pa.int64()), ("id", pa.int64()), ("th", pa.int64()), ("begin", pa.int64()), ("end", pa.int64())])


def word_ranges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and its text. Words stand between white space, without the marks at their ends."""
    place = np.flatnonzero(_LETTER[data])
    text = np.searchsorted(offsets, place, "right") - 1
    spaces = np.cumsum(_SPACE[data])[place]
    new = np.ones(len(place), bool)
    new[1:] = (spaces[1:] != spaces[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return place[first], place[np.append(first[1:], len(place))[: len(first)] - 1] + 1, text[first]


def _worded(words: int, below: int) -> Callable:
    """Strings of ``words`` words that are shorter than ``below`` bytes, by two hashes."""

    def strings(batches):
        for batch in by_bytes(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            start, end, text = word_ranges(data, offsets)
            if len(start) < words:
                continue
            last = slice(words - 1, None)
            begin, end, row = start[: len(start) - words + 1], end[last], text[last]
            fit = (text[: len(row)] == row) & (end - begin < below)
            begin, end, row = begin[fit], end[fit], row[fit]
            if not len(row):
                continue
            hashes = [Hasher(data)(begin, end), Hasher(data, OTHER_BASE)(begin, end)]
            ids, th = (batch.column(name).take(pa.array(row)) for name in ("id", "th"))
            columns = [*(pa.array(h.view(np.int64)) for h in hashes), ids, th, pa.array(begin - offsets[row]), pa.array(end - offsets[row])]
            yield pa.record_batch(columns, schema=_STRINGS)

    return strings


def repeated_words(docs: DataFrame, words: int, below: int) -> DataFrame:
    """``id, th, begin, end`` of each string of ``words`` words under ``below`` bytes that also stands elsewhere.

    Places of one text that overlap, as in a row of equal words, are no two passages.
    """
    found = saved(docs.mapInArrow(_worded(words, below), "h long, h2 long, id long, th long, begin long, end long"), "words")
    rows = found.groupBy("h", "h2", "id", "th", "begin", "end").agg(F.count("*").alias("n"))
    text = F.struct(F.col("id").isNull(), "id", "th")
    apart = ~F.min(text).eqNullSafe(F.max(text)) | (F.max("begin") >= F.min("end")) | (F.max("n") > 1)
    again = rows.groupBy("h", "h2").agg(apart.alias("apart")).filter("apart").select("h", "h2")
    return found.join(again, ["h", "h2"], "left_semi").select("id", "th", "begin", "end")


def _removed(carried: int, as_text: bool) -> Callable:
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.string() if as_text else pa.binary())])

    def remove(batches):
        for batch in by_bytes(batches, "text"):
            rows = []
            for i, text, spans in zip(*(batch.column(name).to_pylist() for name in ("id", "text", "spans")), strict=True):
                raw = (text or "").encode()
                kept, at, runs, removed = [], 0, 0, 0
                for begin, end in sorted((s["begin"], s["end"]) for s in spans or ()):
                    if end <= at:
                        continue
                    if begin > at or not runs:
                        kept.append(raw[at:begin])
                        runs, removed, at = runs + 1, removed + end - begin, end
                    else:
                        removed, at = removed + end - at, end
                kept.append(raw[at:])
                left = b"".join(kept)
                rows.append((i, len(raw), removed, runs, left.decode(errors="ignore") if as_text else left))
            columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)]
            own = [f"carried_{k}" for k in range(carried)]
            yield pa.RecordBatch.from_arrays([*columns, *(batch.column(n) for n in own)], names=[*schema.names, *own])

    return remove


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, gram: int = 128, most: int = MOST_CONTEXTS, carry: tuple[str, ...] = (), as_text: bool = False, words: int | None = None) -> DataFrame:
    """A row per document: its id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the bytes that stay.

    A byte goes if a ``length``-byte string that covers it starts anywhere else too, in this text or another;
    strings are judged on the input, and overlapping places count. Texts are UTF-8, never cut, null counts as
    empty; texts shorter than ``length`` stay whole. Rows that repeat an id or a text are separate places.
    Ids are 64-bit integers or null; an empty table gives an empty result. Columns named in ``carry`` come along,
    others are ignored. With ``as_text`` the kept bytes are text again, without the rest of any character that
    a cut has parted.

    ``gram`` is the size of an anchor: small ones are fewer, large ones shared by fewer texts. Contexts of an
    anchor beyond ``most`` distinct ones are parted by longer anchors, at last by the whole string. With ``words``
    strings of so many words go too where they are shorter than ``length``: from the first letter or digit of a
    word to the last one of another, words standing between ASCII white space. Of these, places of one text that
    overlap do not count.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"), *(F.col(c).alias(f"carried_{k}") for k, c in enumerate(carry)))
    spans = repeated_spans(docs, length, gram, most)
    if words is not None:
        spans = spans.union(repeated_words(docs, words, length))
    spans = spans.groupBy("id", "th").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    spans = spans.select(F.col("id").alias("span_id"), F.col("th").alias("span_th"), "spans")
    whole = docs.join(spans, F.col("id").eqNullSafe(F.col("span_id")) & (F.col("th") == F.col("span_th")), "left")
    own = [f"carried_{k}" for k in range(len(carry))]
    schema = f"id long, n_bytes long, n_removed long, n_spans long, kept {"string" if as_text else "binary"}" + "".join(f", {k} {docs.schema[k].dataType.simpleString()}" for k in own)
    kept = whole.select("id", "text", "spans", *own).mapInArrow(_removed(len(carry), as_text), schema)
    return kept.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept", *(F.col(k).alias(c) for k, c in zip(own, carry, strict=True)))
