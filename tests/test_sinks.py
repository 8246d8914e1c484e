"""What the sinks write."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from chargestream import constants as C
from chargestream.operators import admission as A
from chargestream.operators import batching as B
from chargestream.operators import records as R
from chargestream.plans.flush import batches
from chargestream.sources import sinks


def test_records_go_to_one_folder_per_protocol(spark, ocpi, ocpp, tmp_path):
    path = str(tmp_path / "records")
    both = R.all_records(ocpi(*[{}] * 20).transform(R.ocpi_records), ocpp({}).transform(R.ocpp_records))
    for _ in range(2):
        sinks.write_records(both, path)
    assert {p.rsplit("/", 1)[1] for p in glob.glob(f"{path}/protocol=*")} == {"protocol=ocpi", "protocol=ocpp"}
    assert all(".zstd." in p for p in glob.glob(f"{path}/*/*.parquet"))
    back = spark.read.parquet(path)
    assert back.count() == 21
    assert sorted(map(str, back.select(*both.columns).collect())) == sorted(map(str, both.collect()))


def test_envelopes_go_to_one_folder_per_protocol(spark, ocpi, tmp_path):
    path = str(tmp_path / "envelopes")
    records = ocpi(*[{"url": f"/{at}"} for at in range(12)]).transform(R.ocpi_records)
    sinks.write_envelopes(batches(records, C.OCPI, size=5), path)
    assert all(".zstd." in p for p in glob.glob(f"{path}/protocol=ocpi/part-*"))
    back = sinks.read_envelopes(spark, path)
    placed = back.orderBy("chunk").select("client_id", "chunk", "n_messages", "first_seq", "last_seq", "route", "content_encoding")
    assert [tuple(row)[:5] for row in placed.collect()] == [("gw", 0, 5, 0, 4), ("gw", 1, 5, 5, 9), ("gw", 2, 2, 10, 11)]
    assert {(row.route, row.content_encoding) for row in placed.collect()} <= {("/v1/ocpi", "identity"), ("/v1/ocpi", "zstd")}
    assert back.count() == 3 and back.select("protocol").distinct().collect()[0].protocol == "ocpi"
    assert {row.url for row in B.decode_ocpi(back).collect()} == {f"/{at}" for at in range(12)}


def test_quarantine(spark, ocpi, tmp_path):
    path = str(tmp_path / "rejected")
    lost = A.rejected(ocpi({}, {"platform_id": ""}).transform(A.admit_ocpi), C.OCPI)
    sinks.write_rejected(lost, path)
    assert [tuple(r) for r in spark.read.parquet(path).select(*lost.columns).collect()] == [
        ("gw", 1, "ocpi", C.INVALID_IDENTITY)
    ]


def test_a_hot_client_is_split_over_files(spark, tmp_path):
    """AQE splits the rebalanced partition that one client fills."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(20_000).select(
            F.lit("hot").alias("client_id"),
            F.col("id").alias("seq"),
            F.lit("ocpi").alias("protocol"),
            F.sha2(F.col("id").cast("string"), 512).alias("request_body"),
        )
        sinks.write_records(df, str(tmp_path / "records"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(str(tmp_path / "records/protocol=ocpi/part-*"))) > 1
