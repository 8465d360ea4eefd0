"""Token counts of whole texts: only lengths leave the Arrow function."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from webcapture.llm.common import WORD_BYTES, by_bytes
from webcapture.llm.token_words import Memory, lengths


def _counted(path: str) -> Callable:
    def count(batches):
        memory = Memory(path)
        for batch in by_bytes(batches, "text", WORD_BYTES):
            counts = pa.array(lengths(path, batch.column("text").to_pylist(), memory), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_bytes"), counts], names=["id", "n_bytes", "n_tokens"])

    return count


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """A row per document: its id, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Counts are those of the tokenizers library on the whole text, without added special tokens; special strings
    inside a text count as the library treats them. Texts are encoded in batches of like size in bytes; a long
    text is encoded in parts, cut at places that no token crosses. Null counts as empty; ids of any type pass
    through, repeated or null; other columns are ignored. ``tokenizer_path`` must be readable on the executors.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
    counted = docs.mapInArrow(_counted(tokenizer_path), f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
