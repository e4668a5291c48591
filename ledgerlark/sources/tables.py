"""Lake tables on Parquet folders, partitioned by day."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.predicates import utc_day
from ledgerlark.operators.upsert import absent_rows, newest_of_repeated, repeated_digests
from ledgerlark.schemas import TABLES, TableSpec, conform

DAY = "day"


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    target, files = _folder(spark, path)
    return files.exists(target)


def drop_folder(spark: SparkSession, path: str) -> None:
    target, files = _folder(spark, path)
    files.delete(target, True)


@dataclass(frozen=True)
class LakeTable:
    """A table of declared schema at ``path``.

    Time tables carry a derived ``day`` partition column; with ``grain`` "month" or "year", for tables whose days hold
    too few rows for a folder each, it is ``partition_month`` or ``partition_year``, the first day of either. Writes
    are rebalanced by it, so that big days become several files and small ones share tasks, and sorted by key
    inside files. Years are so few that each task writes files of its own instead, which saves a shuffle of all rows.
    What is said of days below holds for months or years then.
    """

    spec: TableSpec
    path: str
    grain: str = "day"

    @property
    def part(self) -> str:
        return DAY if self.grain == "day" else f"partition_{self.grain}"

    def part_of(self, at: Column) -> Column:
        return utc_day(at) if self.grain == "day" else F.trunc(utc_day(at), self.grain)

    def _on_disk(self) -> T.StructType:
        fields = [T.StructField(f.name, f.dataType, True) for f in self.spec.schema.fields]
        return T.StructType(fields + ([T.StructField(self.part, T.DateType(), True)] if self.spec.day_of else []))

    def _write(self, df: DataFrame, mode: str, only_days_written: bool = False) -> int:
        """Write and return the number of rows written, without those marked as not new."""
        schema = T.StructType(self.spec.schema.fields + [T.StructField("_new", T.BooleanType(), True)])
        out = conform(df, schema)
        if self.spec.day_of is not None:
            out = out.withColumn(self.part, self.part_of(F.col(self.spec.day_of)))
            if self.grain != "year":
                out = out.hint("rebalance", self.part)
            out = out.sortWithinPartitions(self.part, *self.spec.key)
        counted = Observation()
        fresh = F.count_if(F.coalesce("_new", F.lit(True))).alias("rows")
        writer = out.observe(counted, fresh).drop("_new").write.mode(mode).option("compression", "zstd")
        if self.spec.day_of is not None:
            writer = writer.partitionBy(self.part)
            writer = writer.option("partitionOverwriteMode", "dynamic" if only_days_written else "static")
        writer.parquet(self.path)
        return counted.get["rows"]

    def read(self, spark: SparkSession) -> DataFrame:
        if not folder_exists(spark, self.path):
            return spark.createDataFrame([], self._on_disk())
        return spark.read.schema(self._on_disk()).parquet(self.path)

    def create(self, spark: SparkSession) -> None:
        if not folder_exists(spark, self.path):
            self._write(spark.createDataFrame([], self._on_disk()), "overwrite")

    def drop(self, spark: SparkSession) -> None:
        drop_folder(spark, self.path)

    def replace(self, df: DataFrame) -> int:
        """Full refresh. ``df`` must not read this table."""
        return self._write(df, "overwrite")

    def append(self, df: DataFrame) -> int:
        return self._write(df, "append")

    @contextmanager
    def _staged(self, spark: SparkSession, rows: DataFrame) -> Iterator[DataFrame]:
        """``rows`` written beside the table and read back: the source is computed once, however often
        a merge looks at the batch, and the merge survives lost executors without computing it again."""
        folder = f"{self.path}.staged-{uuid.uuid4().hex}"
        try:
            rows.write.option("compression", "zstd").parquet(folder)
            yield spark.read.schema(rows.schema).parquet(folder)
        finally:
            drop_folder(spark, folder)

    @contextmanager
    def _newest_staged(self, spark: SparkSession, batch: DataFrame, order: str | None) -> Iterator[DataFrame]:
        """The batch staged with one row per key. Only a batch that repeats keys is staged again without them."""
        key = list(self.spec.key)
        with self._staged(spark, conform(batch, self.spec.schema)) as rows:
            repeats = repeated_digests(rows, key).count()
            if not repeats:
                yield rows
                return
            with self._staged(spark, newest_of_repeated(rows, key, order, repeats)) as newest:
                yield newest

    def _load(self, spark: SparkSession, batch: DataFrame, order: str | None) -> int:
        """The upsert into a table that doesn't exist: written beside it and renamed, or merged first if keys repeat."""
        first = LakeTable(self.spec, f"{self.path}.first-{uuid.uuid4().hex}", self.grain)
        try:
            written = first.replace(batch)
            rows = first.read(spark).select(*self.spec.schema.names)
            repeats = repeated_digests(rows, self.spec.key).count()
            if repeats:
                return self.replace(newest_of_repeated(rows, self.spec.key, order, repeats))
            target, files = _folder(spark, self.path)
            if not files.rename(_folder(spark, first.path)[0], target):
                raise OSError(f"{first.path} could not become {self.path}")
            return written
        finally:
            first.drop(spark)

    def _replace_days(self, spark: SparkSession, merged: DataFrame, emptied: DataFrame) -> int:
        """Replace the days of ``merged``. Days ``emptied``, which are left without rows, are dropped after the
        write; their names are all that reaches the driver."""
        gone = [row[self.part].isoformat() for row in emptied.collect()]
        written = self._write(merged, "overwrite", only_days_written=True)
        for day in gone:
            drop_folder(spark, f"{self.path}/{self.part}={day}")
        return written

    @contextmanager
    def _fates(self, spark: SparkSession, existing: DataFrame, keys: DataFrame) -> Iterator[DataFrame]:
        """A row per stored day: how many of its rows have one of ``keys`` (``_hits``) and how many don't (``_kept``).
        Only keys and days are shuffled for it."""
        key = list(self.spec.key)
        met = existing.select(*key, self.part).join(keys.withColumn("_hit", F.lit(True)), key, "left")
        counts = [F.count("_hit").alias("_hits"), F.count_if(F.col("_hit").isNull()).alias("_kept")]
        with self._staged(spark, met.where(F.col(self.part).isNotNull()).groupBy(self.part).agg(*counts)) as fates:
            yield fates

    def _left(self, existing: DataFrame, fates: DataFrame, keys: DataFrame, days: DataFrame | None) -> DataFrame:
        """Stored rows without one of ``keys`` on days that hold such a key or are among ``days``. Days that lose all
        rows are not read, and those that lose none meet no keys."""
        key, hit = list(self.spec.key), F.col("_hits") > 0
        mixed = fates.where(hit & (F.col("_kept") > 0)).select(self.part)
        left = existing.where(F.lit(False)) if mixed.isEmpty() else self._near(existing, mixed).join(keys, key, "left_anti")
        if days is None:
            return left
        whole = fates.where(~hit).select(self.part).join(F.broadcast(days.distinct()), self.part, "left_semi")
        return left.unionByName(self._near(existing, whole))

    def _near(self, existing: DataFrame, days: DataFrame) -> DataFrame:
        """Existing rows of some days. The list of days is as short as the calendar, so broadcasting
        it is safe and lets the scan skip the other partitions."""
        return existing.join(F.broadcast(days.distinct()), self.part, "left_semi")

    def upsert(self, spark: SparkSession, batch: DataFrame, order: str | None = None) -> int:
        """Last write wins per key. Only the days concerned are rewritten; replaying a batch changes
        nothing. Returns the number of keys in the batch."""
        key = list(self.spec.key)
        if not folder_exists(spark, self.path):
            return self._load(spark, batch, order)
        with self._newest_staged(spark, batch, order) as newest:
            existing, keys = self.read(spark), newest.select(*key)
            new = newest.withColumn("_new", F.lit(True))

            def merged(kept: DataFrame) -> DataFrame:
                return kept.withColumn("_new", F.lit(False)).unionByName(new)

            if self.spec.day_of is None:
                return self._swap(spark, merged(existing.join(keys, key, "left_anti")))
            days = newest.select(self.part_of(F.col(self.spec.day_of)).alias(self.part))
            if self.spec.day_of in key:
                kept = self._near(existing, days).drop(self.part).join(keys, key, "left_anti")
                return self._write(merged(kept), "overwrite", only_days_written=True)
            # The key says nothing about the day, so a row may have moved: its old day counts too.
            with self._fates(spark, existing, keys) as fates:
                emptied = fates.where("_hits > 0 and _kept = 0").join(F.broadcast(days.distinct()), self.part, "left_anti")
                left = self._left(existing, fates, keys, days).drop(self.part)
                return self._replace_days(spark, merged(left), emptied)

    def insert_absent(self, spark: SparkSession, batch: DataFrame, order: str | None = None) -> int:
        """Append the rows whose key is new; returns how many."""
        with self._staged(spark, conform(batch, self.spec.schema)) as rows:
            stored = self.read(spark)
            if self.spec.day_of in self.spec.key:
                stored = self._near(stored, rows.select(self.part_of(F.col(self.spec.day_of)).alias(self.part)))
            return self._write(absent_rows(stored, rows, self.spec.key, order), "append")

    def delete(self, spark: SparkSession, keys: DataFrame) -> None:
        """Remove the rows of ``keys``, which holds the key columns."""
        key = list(self.spec.key)
        with self._staged(spark, keys.select(*key).distinct()) as gone:
            existing = self.read(spark)
            if self.spec.day_of is None:
                self._swap(spark, existing.join(gone, key, "left_anti"))
                return
            with self._fates(spark, existing, gone) as fates:
                left = self._left(existing, fates, gone, None).drop(self.part)
                self._replace_days(spark, left, fates.where("_hits > 0 and _kept = 0"))

    def _swap(self, spark: SparkSession, df: DataFrame) -> int:
        """Rewrite an unpartitioned table that ``df`` reads: write beside it, then exchange the folders."""
        fresh = LakeTable(self.spec, f"{self.path}.next", self.grain)
        written = fresh.replace(df)
        target, files = _folder(spark, self.path)
        files.delete(target, True)
        files.rename(_folder(spark, fresh.path)[0], target)
        return written

    def verify_count(self, spark: SparkSession, written: int) -> bool:
        """Whether the table holds exactly the rows a full refresh wrote."""
        return self.read(spark).count() == written


class Lake:
    """The declared tables below one root folder."""

    def __init__(self, root: str, grain: str = "day"):
        self.tables = {name: LakeTable(spec, f"{root.rstrip('/')}/{name}", grain) for name, spec in TABLES.items()}

    def __getitem__(self, name: str) -> LakeTable:
        return self.tables[name]

    def create_all(self, spark: SparkSession) -> None:
        for table in self.tables.values():
            table.create(spark)

    def drop_all(self, spark: SparkSession) -> None:
        for table in self.tables.values():
            table.drop(spark)

    def names(self, spark: SparkSession) -> list[str]:
        return [name for name, table in self.tables.items() if folder_exists(spark, table.path)]
