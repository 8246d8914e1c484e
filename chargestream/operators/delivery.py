"""What became of batches, and what was lost on the way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C


def delivery_outcomes(attempts: DataFrame) -> DataFrame:
    """Per batch: accepted, permanent, exhausted or in_flight, and the reason of a drop.

    The first decisive attempt settles a batch: 200 accepts it, 400, 401 and 413
    reject it for good. Every other answer, and no answer at all, is tried again,
    up to the limit. Later attempts are ignored. All aggregates are partial, so
    a batch with very many attempt rows is reduced before the shuffle.
    """
    status = F.coalesce(F.col("status"), F.lit(0))
    decisive = status.isin(C.ACCEPTED_STATUS, *C.PERMANENT_STATUSES)
    folded = (
        attempts.where(F.col("attempt") < C.MAX_ATTEMPTS)
        .groupBy("batch_id")
        .agg(
            F.max("protocol").alias("protocol"),
            F.max("n_messages").alias("n_messages"),
            F.min(F.when(decisive, F.struct("attempt", status.alias("status")))).alias("decision"),
            F.max(F.struct("attempt", status.alias("status"))).alias("last"),
        )
    )
    last = F.coalesce("decision", "last")
    settled = folded.select(
        "batch_id",
        "protocol",
        "n_messages",
        (last["attempt"] + 1).alias("attempts"),
        last["status"].alias("final_status"),
        F.col("decision").isNotNull().alias("decided"),
    )
    return judged(settled)


def judged(settled: DataFrame) -> DataFrame:
    """Outcome and reason by `attempts`, `final_status` and whether that was `decided` by it."""
    code = F.col("final_status")
    exhausted = F.col("attempts") >= C.MAX_ATTEMPTS
    return settled.select(
        "batch_id",
        "protocol",
        "n_messages",
        "attempts",
        "final_status",
        F.when(F.col("decided") & (code == C.ACCEPTED_STATUS), F.lit("accepted"))
        .when(F.col("decided"), F.lit("permanent"))
        .when(exhausted, F.lit("exhausted"))
        .otherwise(F.lit("in_flight"))
        .alias("outcome"),
        F.when(F.col("decided") & (code == C.ACCEPTED_STATUS), F.lit(None))
        .when(F.col("decided"), F.concat(F.lit("permanent rejection: HTTP "), code))
        .when(exhausted & (code != 0), F.concat(F.lit("retries exhausted (last HTTP "), code, F.lit(")")))
        .when(exhausted, F.lit("retries exhausted (network error / timeout)"))
        .alias("reason"),
    )


def dropped_batches(outcomes: DataFrame) -> DataFrame:
    """Per protocol and reason: batches and messages that were not delivered."""
    return (
        outcomes.where(F.col("reason").isNotNull())
        .groupBy("protocol", "reason")
        .agg(F.count(F.lit(1)).alias("n_batches"), F.sum("n_messages").alias("n_messages"))
    )


def dropped_messages(rejected: DataFrame) -> DataFrame:
    """Per protocol and reason: messages that were not admitted."""
    return rejected.groupBy("protocol", "drop_reason").agg(F.count(F.lit(1)).alias("n_messages"))
