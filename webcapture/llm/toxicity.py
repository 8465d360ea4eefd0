"""Toxicity of whole texts by compression distance: zstandard with two dictionaries, window by window.

One dictionary is trained on ordinary text, the other on toxic text. Most of a toxic text is ordinary prose, so
the toxic dictionary is trained on the windows that need it: those of a text that dictionaries of other toxic
texts shorten by more than a calibrated threshold, which few ordinary windows pass. Both compressors end with
the same ordinary content, so a window's two lengths differ only by what the toxic content explains. How much
and how often they differ makes a few figures of the whole text, and a logistic curve fitted on labelled texts
that no dictionary has seen turns these into a score.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from webcapture.llm.common import LOWER, by_bytes, mix, saved, utf8

#: Expected labelled texts of each class that are learned from, and windows of each that reach the dictionaries.
PER_CLASS, PER_TEXT = 3000, 128
_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), 32]] = True
_SAMPLE = pa.schema([("toxic", pa.bool_()), ("part", pa.int64()), ("window", pa.binary())])
FIGURES = 7


@dataclass(frozen=True)
class Settings:
    window: int = 96
    ordinary_bytes: int = 110_000
    toxic_bytes: int = 8192
    #: Shortest and longest stretch that the trainer takes over whole, for ordinary and for toxic text.
    ordinary_run: int = 64
    toxic_run: int = 16
    rounds: int = 3
    #: Share of ordinary windows that the threshold lets through.
    let_through: float = 0.02


def windows(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each window, and how many precede each text.

    A window begins with the first word after every ``size`` bytes, or there if no word begins in the next
    ``size``. Windows of a text, joined, are the text.
    """
    count = np.maximum(-(-np.diff(offsets) // size), 0)
    text = np.repeat(np.arange(len(count)), count)
    places = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * size + offsets[:-1][text]
    blank = _BLANK[data]
    words = np.flatnonzero(np.append(~blank[1:] & blank[:-1], False)) + 1 if len(data) else np.zeros(0, np.int64)
    next_word = np.append(words, len(data) + 2 * size)[np.searchsorted(words, places)]
    first = places == offsets[:-1][text]
    starts = np.where(first | (next_word >= np.minimum(places + size, offsets[1:][text])), places, next_word)
    ends = np.append(starts[1:], len(data))
    return starts, ends, np.searchsorted(text, np.arange(len(offsets)))


def lengths(compressor, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Compressed length of each window."""
    if not len(starts):
        return np.zeros(0, np.int64)
    places = np.stack([starts, ends - starts], axis=1).astype("<u8").tobytes()
    found = compressor.multi_compress_to_buffer(zstandard.BufferWithSegments(data.tobytes(), places))
    return np.fromiter(map(len, (found[i] for i in range(len(found)))), np.int64, len(starts))


@functools.lru_cache(maxsize=4)
def _compressor(content: bytes):
    how = zstandard.ZstdCompressionParameters(strategy=zstandard.STRATEGY_LAZY, min_match=4, window_log=18, hash_log=18, chain_log=18, search_log=4, target_length=16, write_content_size=0, write_dict_id=0, write_checksum=0)
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=how)


def _trained(samples: list[bytes], size: int, run: int) -> bytes:
    """Content of a dictionary trained on the samples; of too few, the samples themselves."""
    if sum(map(len, samples)) <= size:
        return b"".join(samples)
    try:
        # A file of this kind begins with its entropy tables; the content is its end.
        return zstandard.train_dictionary(size + 600, samples, k=run, d=6, f=20, split_point=1.0, level=3).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _saved_by(samples: list[bytes], ordinary: bytes, toxic: bytes) -> np.ndarray:
    """How many bytes the toxic content saves for each sample."""
    data = np.frombuffer(b"".join(samples), np.uint8)
    ends = np.cumsum([len(s) for s in samples])
    starts = ends - [len(s) for s in samples]
    return lengths(_compressor(ordinary), data, starts, ends) - lengths(_compressor(toxic + ordinary), data, starts, ends)


def dictionaries(ordinary: list[bytes], held: list[bytes], toxic: tuple[list[bytes], list[bytes]], how: Settings) -> tuple[bytes, bytes]:
    """Content for ordinary and for toxic text.

    ``held`` are ordinary windows beyond those trained on; the two halves of the toxic windows come from
    different texts, and each is judged by the dictionary of the other.
    """
    common = _trained(ordinary, how.ordinary_bytes, how.ordinary_run)
    chosen = toxic
    for _ in range(how.rounds if all(toxic) and held else 0):
        own = [_trained(samples, how.toxic_bytes, how.toxic_run) for samples in chosen]
        found = []
        for samples, content in zip(toxic, reversed(own), strict=True):
            threshold = max(1, np.quantile(_saved_by(held, common, content), 1 - how.let_through) + 1)
            found.append([s for s, gain in zip(samples, _saved_by(samples, common, content), strict=True) if gain >= threshold])
        if not all(found):
            break
        chosen = found
    return common, _trained(chosen[0] + chosen[1], how.toxic_bytes, how.toxic_run)


def _figures(texts: pa.Array, common: bytes, toxic: bytes, size: int) -> np.ndarray:
    """For each text: mean gain, its positive part, shares of windows over three thresholds, a count, a size."""
    data, offsets = utf8(texts)
    data = LOWER[data]
    starts, ends, first = windows(data, offsets, size)
    gain = lengths(_compressor(common), data, starts, ends) - lengths(_compressor(toxic + common), data, starts, ends)
    sums = lambda x: np.diff(np.append(0, np.cumsum(x))[first])
    n = np.diff(first)
    over = [sums(gain >= t) for t in (1, 3, 5)]
    return np.stack([sums(gain) / (n + 2), np.sqrt(sums(np.maximum(gain, 0)) / (n + 2)), *(x / (n + 2) for x in over), np.log1p(over[1]), np.log1p(n)], axis=1)


def _sampled(size: int) -> Callable:
    def sample(batches):
        for batch in by_bytes(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            data = LOWER[data]
            starts, ends, first = windows(data, offsets, size)
            raw, toxic, part, found = data.tobytes(), [], [], []
            for k, (is_toxic, place) in enumerate(zip(batch.column("toxic").to_pylist(), batch.column("part").to_pylist(), strict=True)):
                own = np.arange(first[k], first[k + 1])
                if len(own) > PER_TEXT:
                    own = np.sort(own[np.argsort(mix(own.astype(np.uint64) - np.uint64(first[k])), kind="stable")[:PER_TEXT]])
                found += [raw[starts[i] : ends[i]] for i in own]
                toxic += [is_toxic] * len(own)
                part += [place] * len(own)
            yield pa.record_batch([pa.array(toxic, pa.bool_()), pa.array(part, pa.int64()), pa.array(found, pa.binary())], schema=_SAMPLE)

    return sample


def _taught(how: Settings) -> Callable:
    def teach(batches):
        table = pa.Table.from_batches(list(batches), schema=_SAMPLE).sort_by([("part", "ascending"), ("window", "ascending")])
        fold = pc.bit_wise_and(table.column("part"), 3).to_numpy()
        toxic = pc.fill_null(table.column("toxic"), False).to_numpy(zero_copy_only=False)
        texts = table.column("window").to_pylist()
        pick = lambda which: [texts[i] for i in np.flatnonzero(which)]
        common, own = dictionaries(pick(~toxic & (fold < 2)), pick(~toxic & (fold == 2)), (pick(toxic & (fold == 0)), pick(toxic & (fold > 0))), how)
        yield pa.record_batch([pa.array([common], pa.binary()), pa.array([own], pa.binary())], names=["common", "toxic"])

    return teach


@dataclass(frozen=True)
class Curve:
    """A logistic curve over standardised figures."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def __call__(self, figures: np.ndarray) -> np.ndarray:
        # Row by row, so that a text's score does not depend on its neighbours.
        z = (np.c_[(figures - self.mean) / self.spread, np.ones(len(figures))] * self.weights).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fitted(figures: np.ndarray, toxic: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> Curve:
    """The likeliest curve, by Newton's method; ``weight`` restores the shares that the classes have in the labels."""
    mean, spread = figures.mean(axis=0), figures.std(axis=0) + 1e-9
    x = np.c_[(figures - mean) / spread, np.ones(len(figures))]
    pull = np.r_[np.full(figures.shape[1], ridge), 1e-6]
    curve = Curve(mean, spread, np.zeros(x.shape[1]))
    for _ in range(40):
        p = curve(figures)
        slope = x.T @ (weight * (p - toxic)) + pull * curve.weights
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(bend, slope)
        curve = Curve(mean, spread, curve.weights - step)
        if np.abs(step).max() < 1e-9:
            break
    return curve


@dataclass(frozen=True)
class Model:
    common: bytes
    toxic: bytes
    curve: Curve | None
    #: Share of toxic labels, the score where there was nothing to tell the classes apart by.
    share: float
    window: int


def _measured(common: bytes, toxic: bytes, size: int) -> Callable:
    def measure(batches):
        for batch in by_bytes(batches, "text"):
            figures = _figures(batch.column("text"), common, toxic, size)
            own = pa.FixedSizeListArray.from_arrays(pa.array(figures.reshape(-1)), FIGURES).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("part"), own], names=["toxic", "part", "figures"])

    return measure


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic", per_class: int = PER_CLASS, how: Settings | None = None) -> Model:
    """Learns from labelled rows, which the caller chooses; null labels, ids and texts are left out.

    Of each class a sample chosen by the hash of the id is learned from, expected to have ``per_class`` texts:
    half of the ordinary and three quarters of the toxic ones for the dictionaries, a quarter of either for the
    curve. The dictionaries are made in one task over at most ``PER_TEXT`` windows of each text of the sample.
    """
    how = how or Settings()
    part = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(13)), F.lit(1 << 40))
    known = labels.select(F.col(id_col).cast("string").alias("label_id"), (F.col(toxic_col) > 0).alias("toxic"), part.alias("part")).filter("label_id is not null and toxic is not null")
    sizes = dict(known.groupBy("toxic").count().collect())
    share = sizes.get(True, 0) / max(1, sum(sizes.values()))
    if len(sizes) < 2:
        return Model(b"", b"", None, share, how.window)
    least = F.when(F.col("toxic"), min(1.0, per_class / sizes[True])).otherwise(min(1.0, per_class / sizes[False]))
    chosen = known.filter(F.col("part") < least * float(1 << 40)).dropDuplicates(["label_id"])
    texts = docs.select(F.col(id_col).cast("string").alias("label_id"), F.col(text_col).alias("text")).filter("text is not null")
    # The chosen labels are some 2 * per_class short rows, whatever the tables.
    sample = saved(texts.join(F.broadcast(chosen), "label_id").select("toxic", "part", "text"), "labelled")
    found = sample.filter("part % 4 != 3").mapInArrow(_sampled(how.window), "toxic boolean, part long, window binary")
    common, toxic = found.repartition(1).mapInArrow(_taught(how), "common binary, toxic binary").first()
    rows = sample.filter("part % 4 = 3").mapInArrow(_measured(bytes(common), bytes(toxic), how.window), "toxic boolean, part long, figures array<double>").collect()
    rows.sort(key=lambda r: (r.part, r.toxic, r.figures))
    is_toxic = np.array([r.toxic for r in rows], float)
    if len(set(is_toxic)) < 2:
        return Model(bytes(common), bytes(toxic), None, share, how.window)
    weight = np.where(is_toxic > 0, share / is_toxic.mean(), (1 - share) / (1 - is_toxic.mean()))
    return Model(bytes(common), bytes(toxic), fitted(np.array([r.figures for r in rows]), is_toxic, weight), share, how.window)


def _scored(shared) -> Callable:
    def score(batches):
        model = shared.value
        for batch in by_bytes(batches, "text"):
            found = np.full(batch.num_rows, model.share)
            if model.curve is not None:
                found = model.curve(_figures(batch.column("text"), model.common, model.toxic, model.window))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, "score"])

    return score


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: its id, ``score`` from 0 to 1, and ``predicted``, 1 from a score of one half."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_scored(shared), f"id {kind}, text string, score double")
    return rows.select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text divides by five; a null id counts as empty."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic", **how) -> DataFrame:
    """A row per document: its id, ``held_out``, ``score`` and ``predicted``, learned from the rows not held out.

    Null and empty texts are scored like a text without windows; texts of any length are scored whole. Repeated
    ids and texts are scored alike; columns but those named are ignored. Without labels of both classes every
    score is the share of toxic labels, 0 without any. An empty table gives an empty result.
    """
    model = fit(docs.filter(~held_out(id_col)), labels.filter(~held_out(id_col)), id_col, text_col, toxic_col, **how)
    return predict(docs, model, id_col, text_col).select(id_col, held_out(id_col).alias("held_out"), "score", "predicted")
