"""Free-text recency phrases to the codes qdr:h, qdr:d, qdr:w, qdr:m and qdr:y."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webcapture.functions.text import WS, strip

# Word edges as letters, numbers and "_" in any script; Java's \b is not used because what it
# counts as a word depends on the JDK.
_L = r"(?<![\p{L}\p{N}_])"
_R = r"(?![\p{L}\p{N}_])"


def _phrase(words: str, unit: str, short: str, *more: str) -> str:
    return "|".join(
        [f"{_L}(?:{words}){_R}", rf"(?:last|past)[{WS}]+{unit}", rf"\p{{Nd}}[{WS}]*{short}{_R}", *more]
    )


# Unit words per code, in the order in which they are tried.
_PATTERNS = (
    ("qdr:y", _phrase("y|yr|yrs|year|years", "year", "y", "年")),
    ("qdr:m", _phrase("mo|mos|month|months", "month", "mo", "月")),
    ("qdr:w", _phrase("w|wk|wks|week|weeks", "week", "w", "周", "星期")),
    ("qdr:d", _phrase("d|day|days", "day", "d", "天", "日", "daily")),
    ("qdr:h", _phrase("h|hr|hrs|hour|hours", "hour", "h", "小时")),
)
_WORDS = {"hour": "qdr:h", "day": "qdr:d", "week": "qdr:w", "month": "qdr:m", "year": "qdr:y"}
CODES = tuple(_WORDS.values())


def recency_code(c, strict: bool = False) -> Column:
    """Code of a phrase, or null when there is none.

    Strict mode knows five words only; use ``recency_error`` to tell a rejected text from a blank.
    """
    text = F.lower(strip(c))
    if strict:
        out = F.lit(None).cast("string")
        for word, code in _WORDS.items():
            out = F.when(text == word, F.lit(code)).otherwise(out)
        return out
    out = F.when(text.startswith("qdr:"), F.when(text.isin(*CODES), text))
    for code, pattern in _PATTERNS:
        out = out.when(text.rlike(f"(?iu){pattern}"), F.lit(code))
    return out


def recency_error(c) -> Column:
    """Reason why strict mode rejects a text, else null."""
    text = F.lower(strip(c))
    return F.when(
        (text != "") & ~text.isin(*_WORDS), F.lit("time filter must be hour, day, week, month or year")
    )
