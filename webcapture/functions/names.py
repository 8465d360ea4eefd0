"""Country-name normalisation and alias variants."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from webcapture.functions.batches import pieces
from webcapture.functions.text import WS, _col, strip


@F.arrow_udf(StringType())
def _nfkd(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    # Spark has no Unicode normalisation; ASCII text is already in normal form.
    for texts in pieces(batches):
        found = (x if x is None or x.isascii() else unicodedata.normalize("NFKD", x) for x in texts.to_pylist())
        yield pa.array(found, texts.type)


def nfkd(c) -> Column:
    """Unicode compatibility decomposition."""
    c = _col(c)
    # Only text beyond ASCII goes to Python.
    return F.coalesce(_nfkd(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


def normalize_name(c) -> Column:
    """Fold case and accents; each run of other characters than letters, numbers, apostrophes and
    hyphens becomes one blank."""
    folded = F.regexp_replace(nfkd(c), r"\p{Mn}", "")
    return F.trim(F.regexp_replace(F.lower(folded), r"[^\p{L}\p{N}'-]+", " "))


@lru_cache
def _case_changing_letters() -> str:
    def key(s):
        folded = unicodedata.normalize("NFKD", s)
        return "".join(ch for ch in folded if unicodedata.category(ch) != "Mn").lower()

    letters = (chr(i) for i in range(0x80, 0x110000) if not 0xD800 <= i < 0xE000)
    # The lower case of a sigma depends on its place in the word.
    return "".join(c for c in letters if key(c.upper()) != key(c)) + "Σσς"


def upper_case_key(c) -> Column:
    """Normalised upper-case name, null where it equals the normalised name for want of a letter, such
    as sharp s, that upper case changes for good."""
    c = _col(c)
    return normalize_name(F.when(c.rlike(f"[{_case_changing_letters()}]"), F.upper(c)))


def alias_variants(c) -> Column:
    """Spellings under which an alias should be found, without blanks and repeats."""
    base = strip(c)
    norm = normalize_name(base)
    plain = F.trim(F.regexp_replace(norm, rf"[^\p{{L}}\p{{N}}{WS}]", ""))
    parts = F.filter(F.transform(F.split(base, ","), strip), lambda p: p != "")
    reordered = F.when(F.size(parts) >= 2, F.array_join(F.reverse(parts), " "))
    words = F.split(norm, " ")
    swapped = F.when(F.size(words) == 2, F.array_join(F.reverse(words), " "))
    found = F.array(base, norm, plain, reordered, normalize_name(reordered), swapped)
    return F.array_distinct(F.filter(found, lambda x: x != ""))
