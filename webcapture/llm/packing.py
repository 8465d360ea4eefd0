"""Packing of tokenized documents into as few sequences of a fixed length as possible, by bin completion.

Only the lengths of pieces decide, and there are no more of them than the sequence is long, so the search runs
on the table of lengths and counts, whatever the number of documents. It fills one sequence around the longest
piece left, tries the undominated fillings of any number of pieces from the least waste on, and applies each as
often as the counts allow, then, on the way back, less often. Branches end where their waste can no longer beat
the best solution known; best fit gives the first one and completes branches. Pieces then find their place by
their rank among those of the same length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from webcapture.llm.common import WORD_BYTES, by_bytes, saved
from webcapture.llm.token_words import Memory, token_ids

#: Groups that the pieces of one length are dealt to for ranking.
SALTS = 256
#: Nodes of the search after which the best solution found is taken.
NODES = 200
#: Steps of the enumeration without a filling that count as a node.
STEPS = 10_000
#: Nodes between two completions by best fit, while many lengths are left.
STRIDE = 8

Filling = tuple[int, ...]
Plan = list[tuple[Filling, int]]


def bins(plan: Plan) -> int:
    return sum(times for _, times in plan)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that no packing can go below: by tokens, and by pieces too long to share one."""
    best = -(-sum(n * c for n, c in counts.items()) // capacity)
    lengths = sorted(counts)
    for small in [0, *(n for n in lengths if n <= capacity // 2)]:
        large = sum(c for n, c in counts.items() if n > capacity - small)
        middle = {n: c for n, c in counts.items() if capacity // 2 < n <= capacity - small}
        room = sum((capacity - n) * c for n, c in middle.items())
        rest = sum(n * c for n, c in counts.items() if small <= n <= capacity // 2)
        best = max(best, large + sum(middle.values()) + max(0, -(-(rest - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best fit, longest first; equal sequences are handled together."""
    groups: list[list] = [[] for _ in range(capacity + 1)]  # by room left: [filling, times]
    some = bytearray(capacity + 1)

    def put(filling: Filling, times: int, room: int) -> None:
        groups[room].append([filling, times])
        some[room] = 1

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = some.find(1, length)
            if room < 0:
                own = min(capacity // length, left)
                times, last = divmod(left, own)
                put((length,) * own, times, capacity - own * length)
                if last:
                    put((length,) * last, 1, capacity - last * length)
                break
            group = groups[room][-1]
            times = min(group[1], left)
            group[1] -= times
            if not group[1]:
                groups[room].pop()
                some[room] = bool(groups[room])
            put((*group[0], length), times, room - length)
            left -= times
    return [(filling, times) for entries in groups for filling, times in entries]


def _reachable(there: dict[int, int], lengths: list[int], room: int) -> list[int]:
    """For each place in ``lengths``, the sums up to ``room`` that pieces from there on have, as bits."""
    mask, found = (2 << room) - 1, [1]
    for length in reversed(lengths):
        sums, left, own = found[-1], min(there[length], room // length), 1
        while left:
            own = min(own, left)
            sums |= sums << own * length & mask
            left -= own
            own *= 2
        found.append(sums)
    return found[::-1]


def _spread(sums: int, width: int) -> int:
    """The sums that lie 1 to ``width`` above one of ``sums``."""
    found, known = sums << 1, 1
    while known < width:
        step = min(known, width - known)
        found |= found << step
        known += step
    return found if width else 0


def fillings(counts: dict[int, int], room: int, waste: int) -> Iterator[Filling | None]:
    """Undominated fillings of the room left beside the longest piece, from the least waste up to ``waste``.

    A filling may have any number of pieces. It is dominated, and left out, if another piece fits beside it, or
    if some of its pieces can give way to one piece outside it that is longer, or as long as two or more of them
    together, and fits. Every ``STEPS`` steps without a filling None comes instead of one.
    """
    there = {length: count for length, count in counts.items() if length <= room}
    lengths = sorted(there, reverse=True)
    every, reach, steps = sum(1 << length for length in lengths), [], 0

    def grow(at: int, rest: int, lost: int, chosen: Filling, free: int, sums: int) -> Iterator[Filling | None]:
        """``sums`` are those of the subsets of ``chosen``, ``free`` the lengths of which pieces stay outside."""
        nonlocal steps
        if not rest:
            if not free & ((2 << lost) - 2):
                yield chosen
            return
        while at < len(lengths) and reach[at] >> rest & 1:
            length, at, states, own = lengths[at], at + 1, [], sums
            for _ in range(min(there[length], rest // length)):
                steps += 1
                if steps % STEPS == 0:
                    yield None
                several = (own & ~1) << length
                own |= own << length
                if (several | _spread(own & ~1, lost)) & free:
                    break
                states.append(own)
            for times in range(len(states), 0, -1):
                if reach[at] >> rest - times * length & 1:
                    left = free & ~(1 << length) if times == there[length] else free
                    yield from grow(at, rest - times * length, lost, chosen + (length,) * times, left, states[times - 1])

    for total in range(room, max(room - waste, 0) - 1, -1):
        if total == room and total in there:
            yield (total,)
            continue
        reach = reach or _reachable(there, lengths, room)
        yield from grow(0, total, room - total, (), every, 1)


@dataclass
class _Node:
    """A plan, the pieces left, and what is to be tried next: ``filling`` up to ``times`` times, then ``options``.

    The use of the fillings in ``tried`` was settled above.
    """

    counts: dict[int, int]
    plan: Plan
    used: int
    waste: int
    tried: frozenset[Filling] = frozenset()
    options: Iterator[Filling | None] | None = None
    filling: Filling = ()
    times: int = 0
    most: int = 0


@dataclass
class _Search:
    capacity: int
    best: Plan
    bound: int
    nodes: int

    def run(self, counts: dict[int, int], plan: Plan, used: int, waste: int, total: int) -> None:
        """Depth first; ``waste`` is the room left unused in the sequences of ``plan``."""
        stack = [_Node(counts, plan, used, waste)]
        while stack and bins(self.best) > self.bound and self.nodes > 0:
            node = stack[-1]
            counts = node.counts
            if not counts:
                if node.used < bins(self.best):
                    self.best = node.plan
                stack.pop()
                continue
            longest = max(counts)
            if node.options is None:
                self.nodes -= 1
                if len(counts) < STRIDE or self.nodes % STRIDE == 0:
                    completed = best_fit(counts, self.capacity)
                    if node.used + bins(completed) < bins(self.best):
                        self.best = node.plan + completed
            spare = (bins(self.best) - 1) * self.capacity - total - node.waste
            if spare < 0:
                stack.pop()
                continue
            if node.options is None:
                own = dict(counts)
                own[longest] -= 1
                node.options = fillings({n: c for n, c in own.items() if c}, self.capacity - longest, spare)
            if not node.times:
                found = next(node.options, False)
                if found is None:
                    self.nodes -= 1
                    continue
                if found is False:
                    stack.pop()
                    continue
                node.filling = (longest, *found)
                if node.filling in node.tried:
                    continue
                node.times = node.most = min(counts[n] // c for n, c in Counter(node.filling).items())
            lost = self.capacity - sum(node.filling)
            times = min(node.times, spare // lost) if lost else node.times
            if times < 1:  # the fillings to come waste as much or more
                stack.pop()
                continue
            node.times = times - 1
            whole = Counter(node.filling)
            rest = {n: c - times * whole.get(n, 0) for n, c in counts.items()}
            tried = node.tried if times == node.most else node.tried | {node.filling}
            stack.append(_Node({n: c for n, c in rest.items() if c}, [*node.plan, (node.filling, times)], node.used + times, node.waste + lost * times, tried if rest[longest] else frozenset()))


def pack_lengths(counts: dict[int, int], capacity: int, nodes: int = NODES) -> Plan:
    """Fillings and how often each is used, for pieces of 1 to ``capacity`` tokens.

    Optimal if it meets ``lower_bound`` or the search ends by itself; after ``nodes`` nodes the best plan found.
    """
    counts = {n: c for n, c in counts.items() if c}
    full = counts.pop(capacity, 0)
    search = _Search(capacity, best_fit(counts, capacity), lower_bound(counts, capacity), nodes)
    search.run(counts, [], 0, 0, sum(n * c for n, c in counts.items()))
    return search.best + ([((capacity,), full)] if full else [])


_PIECES = pa.schema([("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def _pieces(path: str, capacity: int, end_id: int) -> Callable:
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        memory = Memory(path)
        for batch in by_bytes(batches, "text", WORD_BYTES):
            rows = []
            texts = batch.column("text").to_pylist()
            for doc, ids in zip(batch.column("id").to_pylist(), token_ids(path, texts, memory), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _PIECES.types, strict=True)], schema=_PIECES)

    return cut


def _placed(shared) -> Callable:
    def place(batches):
        key, base, offset = shared.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(key, (length << 44) | rank, "right") - 1
            sequence = base[at] + (rank - (key[at] & ((1 << 44) - 1)))
            columns = [*(batch.column(n) for n in _PIECES.names), pa.array(sequence), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays(columns, names=[*_PIECES.names, "sequence_id", "offset"])

    return place


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", nodes: int = NODES) -> DataFrame:
    """A row per piece: document id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    A document is the ids of its whole text by the tokenizers library (no special tokens added), then
    ``end_id``. Longer ones than ``capacity`` are cut into pieces of that length and a rest; others are one
    piece. Pieces fill sequences without gaps. Null texts count as empty: one piece, the end id alone. Ids are
    64-bit integers, repeated or null as they come; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    pieces = saved(docs.mapInArrow(_pieces(tokenizer_path, capacity, end_id), "id long, piece int, start long, length long, ids_crc32 long"), "pieces")
    plan = pack_lengths(dict(pieces.groupBy("length").agg(F.count("*")).collect()), capacity, nodes)
    intervals, taken, sequence = [], Counter(), 0
    for filling, times in plan:
        at = 0
        for length in filling:
            intervals.append(((length << 44) | taken[length], sequence, at))
            taken[length] += times
            at += length
        sequence += times
    shared = spark.sparkContext.broadcast(tuple(np.array(sorted(intervals), np.int64).reshape(-1, 3).T.copy()))
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int"))
    before = pieces.groupBy("length", "salt").agg(F.count("*").alias("own"))
    before = before.withColumn("before", F.sum("own").over(Window.partitionBy("length").orderBy("salt")) - F.col("own")).drop("own")
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "piece", "ids_crc32"))
    ranked = pieces.withColumn("own", own).join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("own") - 1)
    placed = ranked.select(*_PIECES.names, "rank").mapInArrow(_placed(shared), "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return placed.withColumnRenamed("id", id_col)
