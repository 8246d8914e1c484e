"""A bounded sample of labelled documents for the classifiers to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage


def held_out(doc_id: Column, parts: int = 5, part: int = 0) -> Column:
    """Whether crc32 of the id as text leaves this remainder; never for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def _known(labels: DataFrame, label: str) -> DataFrame:
    """One row per id that may be learned from and is labelled one way."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    ends = rows.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("other"))
    return ends.where("label = other").drop("other")


def share(labels: DataFrame, label: str) -> float:
    """Share of label 1 among the rows that may be learned from; 0.5 if there are none."""
    found = _known(labels, label).agg(F.avg("label")).first()[0]
    return 0.5 if found is None else float(found)


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, name: str) -> DataFrame:
    """(doc_id, text, label, part) of at most `rows` labelled documents outside the held-out ids.

    Half of the places go to either label where there are enough of both, in the
    order of a hash of the id; `part`, in [0, 1), is another hash, to split the
    sample by. Ids that are null, unlabelled or labelled both ways are left out; of
    repeated ids each text counts. The ids are at most `rows` and are broadcast;
    the texts stay in Spark.
    """
    part = (F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(1 << 20)) / (1 << 20)).alias("part")
    drawn = _known(labels, label).select("doc_id", "label", part, F.xxhash64("doc_id").alias("draw"))
    halves = [drawn.where(F.col("label") == value).orderBy("draw", "doc_id").limit(rows // 2).drop("draw") for value in (0, 1)]
    chosen = stage(halves[0].unionAll(halves[1]), f"{name}-ids")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return stage(texts.join(F.broadcast(chosen), "doc_id"), f"{name}-sample")
