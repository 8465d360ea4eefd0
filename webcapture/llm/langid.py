"""Language of whole texts: multinomial logistic regression on hashed TF-IDF character n-grams.

Trained by follow-the-regularised-leader with an elastic net, which leaves most weights at zero, then
calibrated by one temperature. Document frequencies are counted over every learning row; the regression is
fitted on a sample of at most about ``PER_LANG`` rows of each language.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from webcapture.llm.common import by_bytes, mix

#: Expected rows of each language that the regression is fitted on; rarer languages give all they have.
PER_LANG = 600
#: Lengths of n-grams, and the number of hash bits that number them.
GRAMS, BITS = (1, 2, 3), 16
UNKNOWN = "und"
_SIZE = 1 << BITS


@dataclass(frozen=True)
class Settings:
    alpha: float = 4.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02
    epochs: int = 3


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def gram_counts(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed n-grams of each text and their counts; lower-cased, other characters than letters as one blank each.

    None for a text that is null or has no letter.
    """
    texts = [(t or "").lower() for t in texts]
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    points = np.where(letter, points, 32).astype(np.uint64)
    hashed = []
    running = np.zeros(len(points), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        running = running[: len(points) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :] + np.uint64(1) if len(points) >= n else running[:0]
        hashed.append((running * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - BITS)).astype(np.uint16))
    start = 0
    for text in texts:
        end = start + len(text)
        own = [hashed[n - 1][start : max(start, end - n + 1)] for n in GRAMS] if letter[start:end].any() else [hashed[0][:0]]
        if len(text) < _SIZE // 16:
            grams, counts = np.unique(np.concatenate(own), return_counts=True)
        else:
            counts = sum(np.bincount(x, minlength=_SIZE) for x in own)
            grams = np.flatnonzero(counts)
            counts = counts[grams]
        yield grams.astype(np.int64), counts
        start = end


def _sampled(batches):
    """Sparse counts of each sampled text."""
    schema = pa.schema([("lang", pa.string()), ("part", pa.int64()), ("grams", pa.binary()), ("counts", pa.binary())])
    for batch in by_bytes(batches, "text"):
        blobs = list(zip(*((x.astype(np.int32).tobytes() for x in pair) for pair in gram_counts(batch.column("text").to_pylist())), strict=True))
        yield pa.record_batch([batch.column("lang"), batch.column("part"), *(pa.array(b, pa.binary()) for b in blobs)], schema=schema)


def _frequencies(batches):
    """One row per task: in how many of its texts each n-gram occurs."""
    found, texts = np.zeros(_SIZE + 1, np.int64), 0
    for batch in by_bytes(batches, "text"):
        for grams, _ in gram_counts(batch.column("text").to_pylist()):
            found[grams] += 1
            texts += 1
    found[_SIZE] = texts
    if texts:
        some = np.flatnonzero(found)
        yield pa.record_batch([pa.array(some), pa.array(found[some])], names=["gram", "n"])


def _weighted(grams: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    value = counts * idf[grams]
    norm = np.sqrt((value * value).sum())
    return value / norm if norm else value


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _fitted(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int, how: Settings) -> np.ndarray:
    """Weights of follow-the-regularised-leader, example by example."""
    z, n, w = (np.zeros((classes, _SIZE)) for _ in range(3))
    rng = np.random.default_rng(7)
    for _ in range(how.epochs):
        for k in rng.permutation(len(rows)):
            label, grams, x = rows[k]
            own = w[:, grams]
            error = _softmax(own @ x)
            error[label] -= 1
            g = error[:, None] * x
            squares, old = g * g, n[:, grams]
            z[:, grams] += g - (np.sqrt(old + squares) - np.sqrt(old)) / how.alpha * own
            n[:, grams] = old + squares
            lean = z[:, grams]
            step = (how.beta + np.sqrt(old + squares)) / how.alpha + how.l2
            w[:, grams] = np.where(np.abs(lean) <= how.l1, 0.0, -(lean - np.sign(lean) * how.l1) / step)
    return w


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits that makes the held labels likeliest, by golden-section search."""

    def loss(power: float) -> float:
        return -np.log(np.maximum(_softmax(logits / np.exp(power))[np.arange(len(labels)), labels], 1e-300)).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _trained(langs: list[str], idf: np.ndarray, how: Settings) -> Callable:
    def train(batches):
        rows, held = [], []
        for batch in batches:
            for lang, part, grams, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                grams = np.frombuffer(grams, np.int32)
                if len(grams):
                    row = (langs.index(lang), grams, _weighted(grams, np.frombuffer(counts, np.int32), idf), part)
                    (held if part % 4 == 0 else rows).append(row)
        rows.sort(key=lambda r: r[3])
        weights = _fitted([r[:3] for r in rows or held], len(langs), how)
        held = held or rows
        heat = 1.0
        if held:
            heat = _temperature(np.array([weights[:, g] @ x for _, g, x, _ in held]), np.array([r[0] for r in held]))
        blob = weights.astype(np.float32).tobytes()
        yield pa.record_batch([pa.array([blob], pa.binary()), pa.array([heat], pa.float64())], names=["weights", "heat"])

    return train


@dataclass(frozen=True)
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    heat: float


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", per_lang: int = PER_LANG, how: Settings | None = None) -> Model:
    """Learns from every row with a text and a label; the rows to learn from are chosen by the caller.

    Rows are sampled by a hash of the text, so equal tables give equal models. The fit is one task over the
    sample, whose expected size is ``per_lang`` rows for each language.
    """
    docs = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and text is not null")
    sizes = dict(docs.groupBy("lang").count().collect())
    langs = sorted(sizes)
    nothing = Model([], np.zeros(_SIZE), np.zeros((0, _SIZE), np.float32), 1.0)
    if not langs:
        return nothing
    frequency = np.zeros(_SIZE + 1)
    for gram, n in docs.select("text").mapInArrow(_frequencies, "gram long, n long").groupBy("gram").agg(F.sum("n")).collect():
        frequency[gram] = n
    idf = np.log((1 + frequency[_SIZE]) / (1 + frequency[:_SIZE])) + 1
    part = F.pmod(F.xxhash64("text", F.lit(11)), F.lit(1 << 40))
    share = F.create_map([F.lit(x) for lang in langs for x in (lang, min(1.0, per_lang / sizes[lang]))])
    sample = docs.withColumn("part", part).filter(F.col("part") < share[F.col("lang")] * float(1 << 40)).dropDuplicates(["lang", "part"])
    features = sample.select("lang", "part", "text").mapInArrow(_sampled, "lang string, part long, grams binary, counts binary")
    fitted = features.repartition(1).mapInArrow(_trained(langs, idf, how or Settings()), "weights binary, heat double").first()
    return Model(langs, idf, np.frombuffer(fitted.weights, np.float32).reshape(len(langs), _SIZE), fitted.heat)


def _scored(shared) -> Callable:
    def score(batches):
        model = shared.value
        by_gram = np.ascontiguousarray(model.weights.T.astype(np.float64) * model.idf[:, None])
        for batch in by_bytes(batches, "text"):
            langs, scores = [], []
            for grams, own in gram_counts(batch.column("text").to_pylist()):
                if not len(grams) or not model.langs:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                value = own * model.idf[grams]
                likely = _softmax(own @ by_gram[grams] / np.sqrt((value * value).sum()) / model.heat)
                best = int(likely.argmax())
                langs.append(model.langs[best])
                scores.append(float(likely[best]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    return score


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``, from the whole text alone.

    ``und`` and 0 for texts that are null or without a letter, and where nothing could be learned. Other
    columns pass through; columns already called ``lang_pred`` or ``score`` are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")
    if text_col != "text":
        raise ValueError("name the column of the text 'text'")
    schema = ", ".join([f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema] + ["lang_pred string", "score double"])
    return docs.mapInArrow(_scored(shared), schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text divides by five; a null id counts as empty."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def identify(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", **how) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``, learned from the rows that are not held out."""
    docs = docs.drop("held_out").withColumn("held_out", held_out(id_col))
    return predict(docs, fit(docs.filter(~F.col("held_out")), lang_col, **how))
