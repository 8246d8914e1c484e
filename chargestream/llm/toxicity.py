"""Toxicity from dense features, gradient-boosted trees and isotonic calibration.

A lexicon is learned from the labelled sample: whole words, and beginnings of
words (inflected and compounded insults share a stem), that toxic documents have
far more often. Features of a text: densities and counts of both lexicons, also
after undoing look-alike characters, how close they stand to words of the second
person, capitals, punctuation, obfuscation, and length. Trees learn from these,
and an isotonic fit on documents that the trees have not seen makes the result a
probability.

Learned from a bounded sample of `rows` labelled documents, split in three:
lexicon, trees, calibration. The trees and the calibration are Spark ML models.
All documents are scored, whole, in one pass without a shuffle.

Defined cases: null and empty texts have all features 0 and get the score of
that. Without labels of both kinds the score is the share of label 1 (0.5 for no
labels). Labels: see `labelled.sample`.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import text as T
from .labelled import sample, share

ROWS = 16_000
LEXICON = 0.4
TREES = 0.75
TERMS = 180
STEM = (4, 5, 6, 7)

# Words that address the reader, in the languages of the corpus.
_YOU = frozenset(
    "you your yours yourself u ya du dich dir dein deine deinen ihr euch euer sie tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros os su".split()
)
_NEAR = 6
_LOOKALIKE = str.maketrans("013457@$!|", "oieastasil")
_EDGE = re.compile(r"^\W+|\W+$")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MASKED = re.compile(r"[^\W\d_][0-9@$*#!|]+[^\W\d_]")
_STRETCHED = re.compile(r"(\w)\1\1")

FEATURES = (
    "words", "word_hits", "word_density", "word_weight", "stem_density", "stem_weight", "plain_hits", "near_you",
    "you_density", "capital_letters", "capital_words", "exclamations", "questions", "punctuation", "symbols", "masked",
    "stretched",
)


# What a token adds to its text: see `Measure._added`.
_ADDS = (
    "you", "hit", "weight", "plain", "stem", "stem_weight", "capital", "masked", "stretched", "letters", "uppers",
    "exclamations", "questions", "marks", "symbols",
)
# Distinct tokens that a task remembers.
_KNOWN = 400_000


class Lexicon(NamedTuple):
    words: dict[str, float]
    stems: dict[str, float]


class Model(NamedTuple):
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None
    share: float


def _bare(word: str) -> str:
    return _EDGE.sub("", word)


def _terms(text: str) -> tuple[set[str], set[str]]:
    """The distinct words of a text, and the beginnings of the longer ones."""
    words = {_bare(w) for w in _WORD.findall(text.lower())}
    words = {w for w in words if 2 < len(w) <= 40}
    return words, {w[:n] for w in words for n in STEM if len(w) > n}


def learn_lexicon(labelled: DataFrame) -> Lexicon:
    """The terms that tell toxic documents best, at most TERMS words and as many stems."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches, "text"):
            counts: Counter = Counter()
            for text, label in zip(T.column(batch, "text").to_pylist(), T.column(batch, "label").to_pylist(), strict=True):
                words, stems = _terms(text)
                counts.update((0, w, label) for w in words)
                counts.update((1, w, label) for w in stems)
            keys = list(counts)
            yield pa.RecordBatch.from_pydict(
                {
                    "kind": pa.array([k[0] for k in keys], pa.int32()),
                    "term": pa.array([k[1] for k in keys], pa.string()),
                    "ones": pa.array([counts[k] * k[2] for k in keys], pa.int64()),
                    "n": pa.array([counts[k] for k in keys], pa.int64()),
                }
            )

    sizes = {r.label: r.n for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    counted = labelled.select("text", "label").mapInArrow(run, "kind int, term string, ones long, n long")
    total = counted.groupBy("kind", "term").agg(F.sum("ones").alias("ones"), F.sum("n").alias("n"))
    often = total.where(F.col("ones") >= max(4, ones // 400))
    weight = F.log((F.col("ones") + 0.5) / (ones + 1)) - F.log((F.col("n") - F.col("ones") + 0.5) / (zeros + 1))
    telling = often.withColumn("weight", weight).where("weight > 1.5").withColumn("gain", F.col("weight") * F.col("ones"))
    found: tuple[dict[str, float], dict[str, float]] = ({}, {})
    for kind in (0, 1):
        best = telling.where(F.col("kind") == kind).orderBy(F.col("gain").desc(), "term").limit(TERMS)
        found[kind].update({r.term: r.weight for r in best.collect()})
    return Lexicon(*found)


class Measure:
    """Features of texts under a lexicon. What a token adds is worked out once per distinct token and task."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.adds = np.zeros((1 << 12, len(_ADDS)))

    def _added(self, token: str) -> tuple[float, ...]:
        core = token.rstrip(".,;:!?")
        lowered = core.lower()
        simple = lowered.isalpha()  # letters, and then marks at most: nothing is masked, and no edge is left to strip
        word = lowered if simple else _bare(token.lower())
        found = self.lexicon.words.get(word)
        plain = False
        if found is None and not simple and not word.isalpha():
            found = self.lexicon.words.get(_bare(token.lower().translate(_LOOKALIKE)))
            plain = found is not None
        stems = self.lexicon.stems
        best = max([stems.get(word[:k], 0.0) for k in STEM])
        stretched = _STRETCHED.search(word) is not None
        if simple and core.isalpha():
            letters, uppers = len(core), 0 if core.islower() else sum(map(str.isupper, core))
        else:
            letters, uppers = sum(map(str.isalpha, token)), sum(map(str.isupper, token))
        of = (word in _YOU, found is not None, found or 0.0, plain, best > 0, best)
        if simple and len(core) == len(token):
            return (*of, len(word) > 1 and token.isupper(), False, stretched, letters, uppers, 0, 0, 0, 0)
        return (
            *of, len(word) > 1 and token.isupper(), not simple and _MASKED.search(token) is not None, stretched, letters, uppers,
            token.count("!"), token.count("?"), sum(map(token.count, ".,;:'\"()-")), sum(map(token.count, "#*$%&|<>@")),
        )

    def _learn(self, tokens: list[str]) -> None:
        if len(self.place) > _KNOWN:
            self._forget()
        begin = len(self.place)
        new = [token for token in dict.fromkeys(tokens) if token not in self.place]
        self.place.update(zip(new, range(begin, begin + len(new)), strict=True))
        while len(self.adds) < len(self.place):
            self.adds = np.concatenate([self.adds, np.zeros_like(self.adds)])
        self.adds[begin : begin + len(new)] = [self._added(token) for token in new]

    def __call__(self, text: str) -> list[float]:
        tokens = _WORD.findall(text)
        n = len(tokens)
        if not n:
            return [0.0] * len(FEATURES)
        at = list(map(self.place.get, tokens))
        if None in at:
            self._learn(tokens)
            at = list(map(self.place.__getitem__, tokens))
        adds = self.adds[at]
        you, hits = np.flatnonzero(adds[:, 0]), np.flatnonzero(adds[:, 1])
        near = 0
        if len(you) and len(hits):
            beside = np.searchsorted(you, hits)
            gap = np.minimum(np.abs(you[np.minimum(beside, len(you) - 1)] - hits), np.abs(you[np.maximum(beside - 1, 0)] - hits))
            near = int((gap <= _NEAR).sum())
        _, _, _, plain, stems, _, capitals, masked, stretched, letters, uppers, exclamations, questions, marks, symbols = adds.sum(0).tolist()
        # In the order of the text, whatever the sums above are taken in.
        weight, stem_weight = (float(np.cumsum(adds[:, c])[-1]) for c in (2, 5))
        letters = letters or 1
        return [
            float(np.log1p(n)), float(len(hits)), len(hits) / n, weight / n, stems / n, stem_weight / n, plain, near / n,
            len(you) / n, uppers / letters, capitals / n, exclamations / n, questions / n, marks / n, symbols / n, masked / n, stretched / n,
        ]


def measure(text: str, lexicon: Lexicon) -> list[float]:
    return Measure(lexicon)(text)


def features(docs: DataFrame, lexicon: Lexicon, keep: tuple[str, ...]) -> DataFrame:
    wanted = list(dict.fromkeys([*keep, "text"]))
    schema = StructType([*[docs.schema[c] for c in keep], *StructType.fromDDL(", ".join(f"{f} double" for f in FEATURES))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measured = Measure(lexicon)
        for batch in T.slices(batches, "text"):
            rows = [measured(text or "") for text in T.column(batch, "text").to_pylist()]
            values = zip(*rows, strict=True) if rows else [[] for _ in FEATURES]
            columns = {c: T.column(batch, c) for c in keep}
            yield pa.RecordBatch.from_pydict(columns | {f: pa.array(v, pa.float64()) for f, v in zip(FEATURES, values, strict=True)})

    return docs.select(*wanted).mapInArrow(run, schema)


def _vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="__features").transform(rows).drop(*FEATURES)


def _raw(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    scored = trees.transform(_vectors(rows))
    return scored.withColumn("__raw", vector_to_array("probability")[1]).drop("__features", "rawPrediction", "probability", "prediction")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = ROWS) -> Model:
    labelled = sample(docs, labels, label, rows, "toxicity")
    ones = share(labels, label)
    kinds = {(r.label, r.third) for r in labelled.select("label", _third().alias("third")).distinct().collect()}
    if len(kinds) < 6:
        return Model(Lexicon({}, {}), None, None, ones)
    lexicon = learn_lexicon(labelled.where(_third() == 0))
    part = labelled.withColumn("third", _third()).where("third > 0")
    # The sample has as many of either label as it can; weights restore their shares.
    counts = {(r.label, r.third): r.n for r in part.groupBy("label", "third").agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = F.lit(0.0)
    for (value, third), n in counts.items():
        mine = (F.col("label") == value) & (F.col("third") == third)
        weight = F.when(mine, F.lit((ones if value else 1 - ones) / n)).otherwise(weight)
    measured = features(part.withColumn("weight", weight), lexicon, ("label", "third", "weight"))
    learn = _vectors(measured.where("third = 1")).coalesce(4).cache()  # at most ROWS rows of numbers
    grown = GBTClassifier(
        featuresCol="__features", labelCol="label", maxIter=20, maxDepth=3, stepSize=0.2, maxBins=32, seed=10
    ).fit(learn)
    learn.unpersist()
    rest = _raw(grown, measured.where("third = 2"))
    curve = IsotonicRegression(featuresCol="__raw", labelCol="label", weightCol="weight").fit(rest)
    return Model(lexicon, grown, curve, ones)


def _third() -> Column:
    return F.when(F.col("part") < LEXICON, 0).when(F.col("part") < TREES, 1).otherwise(2)


def classify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: `keep` and score (the probability of label 1)."""
    if model.trees is None:
        return docs.select(*keep, F.lit(float(model.share)).alias("score"))
    calibrated = model.curve.transform(_raw(model.trees, features(docs, model.lexicon, keep)))
    return calibrated.select(*keep, F.least(F.greatest("prediction", F.lit(0.0)), F.lit(1.0)).alias("score"))
