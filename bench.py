"""Time the headline queries and print one JSON line.

`BENCH_SF_DIR` names the test tables, `BENCH_CPUS` the local cores. Each query
runs once to warm up and then `BENCH_RUNS` times; the best run counts. Results
are consumed in full by Spark's no-op sink, so nothing is skipped and nothing
is collected.

`rows_per_second` gives the throughput of whole jobs over capture tables that
were written beforehand as several files, as real captures are.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargestream import constants as C
from chargestream.operators.admission import ocpp_events
from chargestream.operators.sessions import assign_connections
from chargestream.plans.flush import batches, flush, prepare_ocpi, prepare_ocpp
from chargestream.plans.queries import QUERIES
from chargestream.session import configure, release, scratch_path, stage
from chargestream.sources import testdata
from chargestream.streaming.flush import start_flushing

HEADLINE = [
    "ocpi_records",
    "ocpp_records",
    "rejected_messages",
    "masked_tokens",
    "header_allowlist",
    "ring_overflow",
    "chunk_sizes",
    "flush_cycles",
    "envelope_summary",
    "envelope_roundtrip",
    "connection_ordinals",
    "session_events",
    "delivery_outcomes",
    "per_client_limits",
    "record_sink",
    "stream_ocpp_records",
]


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best_of(runs: int, job: Callable[[], None]) -> float:
    def timed() -> float:
        start = time.perf_counter()
        job()
        return time.perf_counter() - start

    timed()
    return min(timed() for _ in range(runs))


def jobs(spark: SparkSession, sf_dir: str, files: int) -> dict[str, tuple[int, Callable[[], None]]]:
    """Whole jobs: rows they take in, and what to run."""

    def written(captures: DataFrame) -> DataFrame:
        return stage(captures.repartition(files), "bench")

    ocpi = written(testdata.ocpi_capture(spark, sf_dir))
    ocpp = written(testdata.ocpp_capture(spark, sf_dir).transform(ocpp_events))
    connected = written(assign_connections(ocpp))
    records = written(flush(prepare_ocpi(ocpi), C.OCPI).records)
    ocpi_path = os.path.dirname(ocpi.inputFiles()[0])
    n_ocpi, n_ocpp, n_records = ocpi.count(), ocpp.count(), records.count()

    # Every admitted record reaches a body; the timed job does the same work.
    sent = batches(records, C.OCPI).agg(F.sum("n_messages")).first()[0]
    if sent != n_records:
        raise RuntimeError(f"{n_records} records were admitted, {sent} are in batch bodies")

    def whole() -> None:
        prepared = stage(prepare_ocpi(ocpi), "bench-prepared")
        consume(batches(flush(prepared, C.OCPI).records, C.OCPI))

    def drain() -> None:
        stream = spark.readStream.schema(ocpi.schema).parquet(ocpi_path)
        out = scratch_path(spark, "bench-stream")
        start_flushing(stream, out, prepare_ocpi, C.OCPI, interval=None).awaitTermination()

    return {
        "ocpi_admit_redact_record": (n_ocpi, lambda: consume(flush(prepare_ocpi(ocpi), C.OCPI).records)),
        "ocpp_admit_record": (n_ocpp, lambda: consume(flush(prepare_ocpp(connected), C.OCPP).records)),
        "ocpi_admit_to_envelope": (n_ocpi, whole),
        "ocpi_chunk_envelope": (n_records, lambda: consume(batches(records, C.OCPI))),
        "ocpp_connection_ids": (n_ocpp, lambda: consume(assign_connections(ocpp))),
        "ocpi_stream_drain": (n_ocpi, drain),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("chargestream-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {
        name: round(best_of(runs, lambda name=name: consume(QUERIES[name](spark, sf_dir))), 3)
        for name in HEADLINE
    }
    rates = {
        name: round(rows / best_of(runs, job))
        for name, (rows, job) in jobs(spark, sf_dir, 2 * int(cpus)).items()
    }
    release(spark)
    spark.stop()
    line = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_second": rates,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
