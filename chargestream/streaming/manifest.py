"""What a flushing stream has committed, and small flushes put together.

A flush is read once its entry is in `_manifest/`, which is written when all of
its files are. An entry is a small file that is renamed into place, so it is
there as a whole or not at all; a flush that runs again replaces its folder and
its entry. `compact` rewrites a run of committed flushes as few large files, by
protocol, date and hour, and then writes one entry that stands for all of them:
readers see either the small files or the large ones, never both and never
neither. `vacuum` deletes what no entry stands for any more; it is a step of its
own because a reader that began earlier may still be at the small files.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDS, REJECTED, ENVELOPES = "records", "rejected", "envelopes"
_COMPACTED = (RECORDS, REJECTED)


class Entry(NamedTuple):
    """Flushes `first` to `last`; a compaction of them, or a single one as it was written."""

    first: int
    last: int
    compacted: bool
    kinds: tuple[str, ...]

    def folder(self, kind: str) -> str:
        if self.compacted:
            return f"compacted/{kind}/first={self.first}/last={self.last}"
        return f"{kind}/flush={self.first}"

    @property
    def name(self) -> str:
        return f"{'compacted' if self.compacted else 'flush'}-{self.first:012d}-{self.last:012d}.json"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system of a path."""
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def commit(spark: SparkSession, path: str, entry: Entry) -> None:
    jvm = spark._jvm
    aside, place = (_path(spark, f"{path}/_manifest/{name}") for name in (f".{entry.name}.new", entry.name))
    files = filesystem(spark, path)
    out = files.create(aside, True)
    out.write(bytearray(json.dumps({"kinds": entry.kinds}).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(aside, place, options)


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """Every committed entry, by flush."""
    files, folder = filesystem(spark, path), _path(spark, f"{path}/_manifest")
    found = []
    for status in files.listStatus(folder) if files.exists(folder) else []:
        name = status.getPath().getName()
        if name.startswith("."):
            continue
        source = files.open(status.getPath())
        raw = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source))
        source.close()
        kind, first, last = name.removesuffix(".json").split("-")
        found.append(Entry(int(first), int(last), kind == "compacted", tuple(json.loads(raw)["kinds"])))
    return sorted(found)


def standing(found: Iterable[Entry], kind: str) -> list[Entry]:
    """The entries to read for `kind`: compactions that hold it, and flushes that none of these stands for."""
    holding = [one for one in found if kind in one.kinds]
    large = [one for one in holding if one.compacted]
    return sorted(one for one in holding if one.compacted or not any(x.first <= one.first <= x.last for x in large))


def folders(spark: SparkSession, path: str, kind: str) -> tuple[list[str], list[str]]:
    """Folders of flushes as they were written, and of compactions, that hold `kind`."""
    read = standing(entries(spark, path), kind)
    return tuple([f"{path}/{one.folder(kind)}" for one in read if one.compacted is large] for large in (False, True))


def _with_time(records: DataFrame) -> DataFrame:
    """Add the date and hour of a record, by which large files are laid out."""
    at = F.col("captured_at")
    return records.withColumns({"date": F.substring(at, 1, 10), "hour": F.substring(at, 12, 2)})


def read(spark: SparkSession, path: str, kind: str, schema=None) -> DataFrame:
    """All committed rows of `kind`, with `flush` and `protocol`; records also with `date` and `hour`.

    A filter on protocol, date or hour skips the folders of compactions it rules out.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    small, large = folders(spark, path, kind)
    parts = []
    if small or not large:
        if not small and schema is None:
            raise ValueError(f"{path}: nothing is committed yet, so the columns are not known")
        found = reader.option("basePath", f"{path}/{kind}").parquet(*small) if small else spark.createDataFrame([], schema)
        parts.append(_with_time(found) if kind == RECORDS else found)
    if large:
        # Their partition columns are text, as `date` and `hour` are anyway.
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        try:
            found = [spark.read.option("basePath", folder).parquet(folder) for folder in large]
        finally:
            spark.conf.unset("spark.sql.sources.partitionColumnTypeInference.enabled")
        parts += found
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def compact(spark: SparkSession, path: str, upto: int | None = None) -> Entry | None:
    """Put the committed flushes up to `upto` that are still small together; None if there are not two of them.

    Runs beside the stream: flushes behind `upto` are not touched. A run that
    failed left no entry, and the next one replaces its files.
    """
    found = [one for one in standing(entries(spark, path), RECORDS) if not one.compacted and (upto is None or one.first <= upto)]
    if len(found) < 2:
        return None
    kinds = tuple(kind for kind in _COMPACTED if any(kind in one.kinds for one in found))
    entry = Entry(found[0].first, found[-1].last, True, kinds)
    for kind in kinds:
        rows = spark.read.option("basePath", f"{path}/{kind}").parquet(*[f"{path}/{one.folder(kind)}" for one in found if kind in one.kinds])
        by = ["protocol"]
        if kind == RECORDS:
            rows, by = _with_time(rows), ["protocol", "date", "hour"]
        spread = rows.hint("rebalance", *[F.col(name) for name in by]).sortWithinPartitions(*by, "client_id", "seq")
        spread.write.mode("overwrite").option("compression", "zstd").partitionBy(*by).parquet(f"{path}/{entry.folder(kind)}")
    commit(spark, path, entry)
    return entry


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the small files that a compaction stands for, and their entries; how many flushes these were."""
    found = entries(spark, path)
    read_from = {one for kind in _COMPACTED for one in standing(found, kind)}
    gone = [one for one in found if one not in read_from]
    files = filesystem(spark, path)
    for one in gone:
        for kind in set(one.kinds) & set(_COMPACTED):
            files.delete(_path(spark, f"{path}/{one.folder(kind)}"), True)
        if ENVELOPES not in one.kinds:
            files.delete(_path(spark, f"{path}/_manifest/{one.name}"), False)
    return len(gone)
