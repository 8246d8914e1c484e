"""Shared session and row builders."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chargestream import schemas
from chargestream.session import configure


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("chargestream-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def rows_of(spark: SparkSession, schema: T.StructType, rows: list[dict]) -> DataFrame:
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(row.get(name) for name in names) for row in rows], schema)


OCPI_DEFAULTS = {
    "client_id": "gw",
    "direction": "IN",
    "platform_id": "acme",
    "platform_name": "Acme Mobility",
    "method": "POST",
    "url": "/ocpi/2.2/cdrs",
    "request_headers": {},
    "response_headers": {},
}
OCPP_DEFAULTS = {"client_id": "csms", "charger_id": "CP-001", "connection_id": "c1", "event_type": 2}


@pytest.fixture
def ocpi(spark):
    """Build OCPI captures; `seq` counts up."""

    def build(*messages: dict) -> DataFrame:
        rows = [{**OCPI_DEFAULTS, "seq": at, **message} for at, message in enumerate(messages)]
        return rows_of(spark, schemas.OCPI_CAPTURE, rows)

    return build


@pytest.fixture
def ocpp(spark):
    """Build OCPP captures; `seq` counts up."""

    def build(*events: dict) -> DataFrame:
        rows = [{**OCPP_DEFAULTS, "seq": at, **event} for at, event in enumerate(events)]
        return rows_of(spark, schemas.OCPP_CAPTURE, rows)

    return build


@pytest.fixture
def config(spark):
    """Build a client configuration, one row per dictionary."""

    def build(*clients: dict) -> DataFrame:
        base = {"client_id": "gw", "endpoint": "https://x.example.com", "has_api_key": True}
        return rows_of(spark, schemas.CLIENT_CONFIG, [{**base, **client} for client in clients])

    return build


@pytest.fixture
def skewed(spark) -> DataFrame:
    """Rows of which two thirds share one `key`."""
    ids = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("seq"))
    key = F.when(F.col("seq") % 3 == 0, F.concat(F.lit("k"), F.col("seq") % 500)).otherwise("hot")
    return ids.select("seq", key.alias("key"), F.sha2(F.col("seq").cast("string"), 256).alias("text"))


@pytest.fixture
def assert_skew_is_split(spark):
    """With broadcasts off, the join must still not put a hot key into one task."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    }

    def check(joined: DataFrame, rows: int) -> None:
        assert len(joined.collect()) == rows
        assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()

    for name, value in conf.items():
        spark.conf.set(name, value)
    yield check
    for name in conf:
        spark.conf.unset(name)


def by_seq(df: DataFrame) -> list[Row]:
    return df.orderBy("seq").collect()


def column(df: DataFrame, name: str, order: str = "seq") -> list:
    return [row[name] for row in df.orderBy(order).select(name).collect()]
