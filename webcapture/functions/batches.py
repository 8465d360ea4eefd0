"""Arrow batches in pieces that bound what a Python worker holds beside them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text of a piece; a longer text is a piece of its own, whole.
PIECE_BYTES = 1 << 20


def pieces(batches: Iterator[pa.Array], limit: int = PIECE_BYTES) -> Iterator[pa.Array]:
    """The texts of all batches in order, in slices of about ``limit`` bytes; null counts as empty."""
    for texts in batches:
        if not len(texts):
            continue
        length = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(length) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(texts)], strict=True):
            yield texts.slice(start, end - start)
