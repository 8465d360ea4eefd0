"""Tokens of whole texts by a public tokenizer, a word at a time: equal words are encoded once.

Texts are cut before ASCII white space that follows another character, and between letters, digits and ASCII
marks other than the apostrophe. No token of the tokenizers used here crosses such a place, and none looks
beyond it, so the tokens of the parts are those of the text. The cuts of a batch are found as arrays, equal
parts become one entry of a dictionary array, and only entries not met lately reach the library. A stretch
without such a place is one part, encoded whole.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: White space beyond ASCII: beside it a cut is only made after a visible ASCII character.
_ODD = re.compile("[\x85\xa0  -     　]")
#: Letters that stay one letter when lowered (the dotted capital I does not), and marks without the apostrophe.
_LETTER = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_MARK = r"!-&(-/:-@\[-`{-~"
_BLANKS, _LETTERS, _MARKS, _DIGITS, _OTHERS = range(5)
_SAFE = re.compile(r"(?<=[!-~])(?=[\t-\r ])")
_SIMPLE = re.compile(rf" [{_LETTER}]+")
#: Bytes that the parts remembered by a task may take, and the length of the longest one.
REMEMBERED, LONGEST = 96 << 20, 48
#: What an entry takes beside its part and its ids.
_ENTRY = 200
#: Characters that are cut at once; longer texts are parted before, at safe places.
AT_ONCE = 1 << 22
_BLOCK = 1000


@functools.cache
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def _edges(path: str) -> tuple[bool, np.ndarray]:
    """Whether tokens end words (else they begin them, with the blank before), and which tokens do."""
    words = sorted(tokenizer(path).get_vocab().items(), key=lambda item: item[1])
    ends = any(word.endswith("</w>") for word, _ in words)
    marks = np.zeros(words[-1][1] + 1, bool)
    for word, number in words:
        marks[number] = word.endswith("</w>") if ends else word.startswith("Ġ")
    return ends, marks


@functools.cache
def _kinds() -> np.ndarray:
    kinds = np.full(0x110000, _OTHERS, np.uint8)
    for kind, members in ((_BLANKS, r"\t-\r "), (_LETTERS, _LETTER), (_MARKS, _MARK), (_DIGITS, "0-9")):
        kinds[[ord(c) for c in re.findall(f"[{members}]", "".join(map(chr, range(0x250))))]] = kind
    return kinds


def _cuts(points: np.ndarray, begin: np.ndarray, coarse: np.ndarray, visible_only: np.ndarray) -> np.ndarray:
    """Where parts begin, texts with ``coarse`` being cut at white space alone, others at changes of kind too."""
    place = np.arange(len(points), dtype=np.int32)
    kind = _kinds()[points]
    blank = kind == _BLANKS
    bar = np.where(blank, place, np.int32(-1))
    bar[begin] = np.maximum(bar[begin], begin - 1)
    # A digit or any other character keeps the rest of its word whole.
    clean = np.maximum.accumulate(np.where(kind >= _DIGITS, place, np.int32(-1))) <= np.maximum.accumulate(bar)
    before, here = kind[:-1], kind[1:]
    new = np.zeros(len(points), bool)
    if len(points):
        new[1:] = (before != here) & clean[:-1] & (before != _BLANKS) & (here != _BLANKS) & (here != _OTHERS) & ~coarse[1:]
        new[1:] |= (here == _BLANKS) & (before != _BLANKS) & (~visible_only[1:] | ((points[:-1] > 32) & (points[:-1] < 127)))
        new[begin] = True
    return np.flatnonzero(new)


def _parts(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The parts of all texts in a row, and how many precede each text."""
    joined = "".join(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    offsets = np.append(0, np.cumsum(sizes))
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    odd = np.array([bool(_ODD.search(t)) for t in texts], bool) if _ODD.search(joined) else np.zeros(len(texts), bool)
    # Special strings are made of letters and marks and must stay whole.
    coarse = odd | np.array(["<|" in t for t in texts], bool) if "<|" in joined else odd
    starts = _cuts(points, offsets[:-1][sizes > 0], np.repeat(coarse, sizes), np.repeat(odd, sizes))
    places = np.append(starts, len(points))
    if len(data := joined.encode()) != len(points):
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        places = np.append(0, np.cumsum(width))[places]
    parts = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(data)])
    return parts.dictionary_encode(), np.searchsorted(starts, offsets)


def parts(text: str) -> list[str]:
    """The text cut at safe places."""
    return _parts([text])[0].to_pylist()


def _encoded(path: str, wanted: list[str]) -> list[bytes]:
    """Ids of each part. Plain words are encoded many to a call, which their first or last tokens part again."""
    found: list = [None] * len(wanted)
    plain = [i for i, part in enumerate(wanted) if _SIMPLE.fullmatch(part)]
    ends, marks = _edges(path)
    for start in range(0, len(plain), _BLOCK):
        block = plain[start : start + _BLOCK]
        ids = np.array(tokenizer(path).encode_batch_fast(["".join(wanted[i] for i in block)], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(marks[ids]) + ends
        cuts = cuts[:-1] if ends else cuts[1:]
        if len(cuts) + 1 == len(block):
            raw, places = ids.tobytes(), [0, *(4 * cuts).tolist(), 4 * len(ids)]
            for i, a, b in zip(block, places[:-1], places[1:], strict=True):
                found[i] = raw[a:b]
    rest = [i for i, own in enumerate(found) if own is None]
    for start in range(0, len(rest), 4 * _BLOCK):
        block = rest[start : start + 4 * _BLOCK]
        for i, tokens in zip(block, tokenizer(path).encode_batch_fast([wanted[i] for i in block], add_special_tokens=False), strict=True):
            found[i] = np.array(tokens.ids, "<u4").tobytes()
    return found


class Memory:
    """Ids of the parts that a task has met lately, within ``limit`` bytes.

    Two generations: the young one becomes the old one when it is half the limit; what is met again moves to
    the young one, the rest goes with the next change. Long parts are not kept.
    """

    def __init__(self, path: str, limit: int = REMEMBERED) -> None:
        self.path, self.limit = path, limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def ids(self, wanted: list[str]) -> list[bytes]:
        found = list(map(self.young.get, wanted))
        gone = [i for i, ids in enumerate(found) if ids is None]
        again = [(i, ids) for i in gone if (ids := self.old.get(wanted[i])) is not None]
        for i, ids in again:
            found[i] = ids
        missing = [i for i in gone if found[i] is None]
        for i, ids in zip(missing, _encoded(self.path, [wanted[i] for i in missing]), strict=True):
            found[i] = ids
        for i in gone:
            part, ids = wanted[i], found[i]
            if len(part) <= LONGEST:
                self.young[part] = ids
                self.held += len(part) + len(ids) + _ENTRY
        if self.held > self.limit // 2:
            self.old, self.young, self.held = self.young, {}, 0
        return found


def _groups(texts: list[str | None]) -> Iterator[tuple[list[str], list[int]]]:
    """Texts, or pieces of long ones, that are cut together, with the places of their texts."""
    own: list[str] = []
    places: list[int] = []
    size = 0
    for k, text in enumerate(texts):
        text, at = text or "", 0
        while at < len(text) or not at:
            end = _SAFE.search(text, at + AT_ONCE) if len(text) - at > AT_ONCE else None
            piece = text[at : end.start() if end else len(text)]
            own.append(piece)
            places.append(k)
            size += len(piece)
            at += max(1, len(piece))
            if size >= AT_ONCE:
                yield own, places
                own, places, size = [], [], 0
    if own:
        yield own, places


def lengths(path: str, texts: list[str | None], memory: Memory | None = None) -> list[int]:
    """Number of tokens of each text; null counts as empty."""
    memory = memory or Memory(path)
    counts = np.zeros(len(texts), np.int64)
    for pieces, places in _groups(texts):
        cut, first = _parts(pieces)
        known = memory.ids(cut.dictionary.to_pylist())
        own = np.fromiter(map(len, known), np.int64, len(known)) // 4
        sums = np.append(0, np.cumsum(own[cut.indices.to_numpy()]))[first] if len(cut) else np.zeros(len(first), np.int64)
        np.add.at(counts, places, np.diff(sums))
    return counts.tolist()


def token_ids(path: str, texts: list[str | None], memory: Memory | None = None) -> Iterator[bytes]:
    """Ids of the tokens of each text, as little-endian 32-bit words."""
    memory = memory or Memory(path)
    open_at, begun = 0, []
    for pieces, places in _groups(texts):
        cut, first = _parts(pieces)
        known = memory.ids(cut.dictionary.to_pylist())
        codes = cut.indices.to_numpy().astype(np.int64)
        own = np.fromiter(map(len, known), np.int64, len(known)) // 4
        pool, begin = np.frombuffer(b"".join(known), "<u4"), np.cumsum(own) - own
        count = own[codes]
        ends = np.append(0, np.cumsum(count))
        raw = pool[np.repeat((begin[codes] - ends[:-1]).astype(np.int32), count) + np.arange(ends[-1], dtype=np.int32)].tobytes()
        cuts = (4 * ends[first]).tolist()
        for k, a, b in zip(places, cuts[:-1], cuts[1:], strict=True):
            if k != open_at:
                yield b"".join(begun)
                open_at, begun = k, []
            begun.append(raw[a:b])
    if texts:
        yield b"".join(begun)
