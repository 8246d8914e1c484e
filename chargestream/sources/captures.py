"""Capture tables, read in batch or as a stream. Schemas are given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import constants as C
from .. import schemas


def read_ocpi(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """OCPI exchanges. In JSON files, bodies are base64 text."""
    return spark.read.schema(schemas.OCPI_CAPTURE).format(fmt).load(path)


def read_ocpp(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """OCPP events. In JSON files, payloads are base64 text."""
    return spark.read.schema(schemas.OCPP_CAPTURE).format(fmt).load(path)


def stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    max_bytes: int = 1 << 30,
) -> DataFrame:
    """Files as they arrive. `max_bytes` bounds what one flush takes in."""
    reader = spark.readStream.schema(schema).format(fmt)
    return reader.option("maxBytesPerTrigger", str(max_bytes)).load(path)


def stream_ocpi(spark: SparkSession, path: str, **options) -> DataFrame:
    return stream(spark, path, schemas.OCPI_CAPTURE, **options)


def stream_ocpp(spark: SparkSession, path: str, **options) -> DataFrame:
    return stream(spark, path, schemas.OCPP_CAPTURE, **options)


# Where a message came from; what a source does not say is null.
_PLACE = {"topic": "string", "partition": "int", "offset": "bigint"}
_CORRUPT = "__corrupt"


def _parsed(df: DataFrame, schema: StructType) -> DataFrame:
    """Messages with their `capture` and whether it is `__sound`: one JSON object whose fields have the types of the schema."""
    asked = StructType([*schema.fields]).add(_CORRUPT, "string")
    text = F.col("value").cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    capture = F.from_json(text, asked, options)
    # The parser overlooks text after the end of an object, and takes the first of a list.
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    sound = alone & F.ltrim(text).startswith("{") & capture[_CORRUPT].isNull()
    return df.withColumn("capture", capture).withColumn("__sound", F.coalesce(sound, F.lit(False)))


def parse_messages(df: DataFrame, schema: StructType) -> DataFrame:
    """Captures from JSON messages in a `value` column; bodies are base64 text. Others are left to `unparseable`."""
    return _parsed(df, schema).where("__sound").select(*[F.col("capture")[name].alias(name) for name in schema.fieldNames()])


def unparseable(df: DataFrame, schema: StructType) -> DataFrame:
    """The messages that `parse_messages` leaves out, byte for byte, with their place and the reason."""
    lost = _parsed(df, schema).where("not __sound")
    place = [
        (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name) for name, kind in _PLACE.items()
    ]
    return lost.select(*place, F.col("value").cast("binary").alias("value"), F.lit(C.UNPARSEABLE).alias("drop_reason"))


def split_messages(df: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Captures, and what is none; of a table, of one micro-batch, or of a stream (then two queries read it)."""
    return parse_messages(df, schema), unparseable(df, schema)


def read_json_messages(spark: SparkSession, path: str) -> DataFrame:
    """Lines of JSON files as messages, so that a line that does not parse is kept as it is."""
    return spark.read.text(path).select(F.col("value").cast("binary").alias("value"))


def stream_kafka(
    spark: SparkSession,
    options: dict[str, str],
    max_messages: int = 1_000_000,
    max_delay: str = "5s",
) -> DataFrame:
    """A Kafka topic of JSON captures as messages, flushed on count or delay; see `split_messages`.

    Needs Spark's Kafka package on the class path. `options` names servers and
    topic; `max_messages` bounds what one flush takes in.
    """
    reader = spark.readStream.format("kafka").options(**options)
    topic = (
        reader.option("minOffsetsPerTrigger", str(C.BATCH_CAP))
        .option("maxTriggerDelay", max_delay)
        .option("maxOffsetsPerTrigger", str(max_messages))
        .load()
    )
    return topic.select("topic", "partition", "offset", "value")
