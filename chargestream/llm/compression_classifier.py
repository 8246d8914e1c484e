"""Text quality by compression: which of two Zstandard dictionaries serves a text better.

One dictionary is built from text labelled good, one from text labelled bad. A
text is compressed piece by piece with either. Of the sizes a (good), b (bad) and
n (not compressed), the normalised differences of each pair, (x - y) / (x + y),
are its raw scores: which dictionary serves better, and how well either does (text
that repeats itself is short with both). A logistic function fitted on labelled
text that neither dictionary has seen turns them into a probability.

Only a bounded sample of labelled rows is learned from: `rows` documents, and of
each label's share at most `dictionary_text` bytes of pieces spread evenly over
them. Every document is scored, whole, without a shuffle.

Defined cases: null and empty texts have raw scores 0, so their probability is
the function's value there. Without a label of either kind the score is the share
of label 1 in the sample (0.5 for no sample). Labels: see `labelled.sample`.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import text as T
from .labelled import sample, share

ROWS = 8000
PIECE = 2048
DICTIONARY = 512 << 10
DICTIONARY_TEXT = 16 << 20
LEVEL = 3
# Share of the sample that the dictionaries are built from; the curve is fitted on the rest.
BUILD = 0.6


class Model(NamedTuple):
    good: bytes
    bad: bytes
    slopes: tuple[float, ...]
    shift: float


def pieces(raw: bytes, size: int = PIECE) -> list[bytes]:
    return [raw[at : at + size] for at in range(0, len(raw), size)]


def build(texts: Iterator[bytes], size: int = DICTIONARY, most: int = DICTIONARY_TEXT) -> bytes:
    """A dictionary from pieces spread evenly over the texts; as they are if too few to train on."""
    parts = [p for raw in texts for p in pieces(raw)]
    step = max(1, -(-sum(map(len, parts)) // most))
    parts = parts[::step]
    try:
        return zstandard.train_dictionary(size, parts, k=1024, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-size:]


def dictionaries(labelled: DataFrame) -> dict[int, bytes]:
    """One dictionary per label; a task has at most half of the sample."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        texts = (t.encode() for t in rows.sort_by("part").column("text").to_pylist())
        return pa.table({"label": pa.array([key[0].as_py()], pa.int32()), "dictionary": pa.array([build(texts)], pa.binary())})

    made = labelled.groupBy("label").applyInArrow(run, "label int, dictionary binary")
    return {row.label: bytes(row.dictionary) for row in made.collect()}


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    if len(dictionary) < 8:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    known = zstandard.ZstdCompressionDict(dictionary)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=known, write_content_size=False, write_dict_id=False)


RAW = ("bad_good", "plain_good", "plain_bad")


def raw_scores(texts: list[str | None], good: bytes, bad: bytes) -> np.ndarray:
    """A row per text, as RAW: above 0 if the one named second is the smaller size."""
    x, y = _compressor(good), _compressor(bad)
    out = np.zeros((len(texts), len(RAW)))
    for at, text in enumerate(texts):
        raw = (text or "").encode()
        if raw:
            parts = pieces(raw)
            a, b, n = sum(len(x.compress(p)) for p in parts), sum(len(y.compress(p)) for p in parts), len(raw)
            out[at] = (b - a) / (b + a), (n - a) / (n + a), (n - b) / (n + b)
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[tuple[float, ...], float]:
    """Slopes and shift by Newton's method, with a little ridge so that separable labels converge."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    design = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    beta = np.zeros(design.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - 1e-2 * beta
        curvature = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(len(beta))
        step = np.linalg.solve(curvature, gradient)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    slopes = beta[:-1] / spread
    return tuple(slopes.tolist()), float(beta[-1] - (slopes * mean).sum())


def _map_scores(docs: DataFrame, good: bytes, bad: bytes, keep: tuple[str, ...]) -> DataFrame:
    """`keep` and the raw scores of every row."""
    wanted = list(dict.fromkeys([*keep, "text"]))
    schema = StructType([*[docs.schema[c] for c in keep], *StructType.fromDDL(", ".join(f"{r} double" for r in RAW))])
    both = docs.sparkSession.sparkContext.broadcast((good, bad))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches, "text"):
            raw = raw_scores(T.column(batch, "text").to_pylist(), *both.value)
            columns = {c: T.column(batch, c) for c in keep}
            yield pa.RecordBatch.from_pydict(columns | {r: pa.array(raw[:, i]) for i, r in enumerate(RAW)})

    return docs.select(*wanted).mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = ROWS) -> Model:
    """Learn from the labels outside the held-out ids."""
    labelled = sample(docs, labels, label, rows, "compression")
    made = dictionaries(labelled.where(F.col("part") < BUILD))
    good, bad = made.get(1, b""), made.get(0, b"")
    rest = _map_scores(labelled.where(F.col("part") >= BUILD), good, bad, ("label",)).collect()  # four numbers for each sampled row
    x, y = np.array([[r[c] for c in RAW] for r in rest]), np.array([r.label for r in rest], float)
    ones = min(max(share(labels, label), 1e-3), 1 - 1e-3)
    if len(set(y.tolist())) < 2 or len(made) < 2:
        return Model(good, bad, (0.0,) * len(RAW), float(np.log(ones / (1 - ones))))
    # The sample has as many of either label as it can; weights restore their shares.
    weight = np.where(y == 1, ones / y.mean(), (1 - ones) / (1 - y.mean()))
    return Model(good, bad, *fit_logistic(x, y, weight))


def classify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: `keep`, the raw scores and score (the probability of label 1)."""
    z = sum((F.lit(slope) * F.col(r) for slope, r in zip(model.slopes, RAW, strict=True)), F.lit(model.shift))
    scored = _map_scores(docs, model.good, model.bad, keep)
    return scored.withColumn("score", 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(500.0)), F.lit(-500.0)))))
