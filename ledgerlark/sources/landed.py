"""Landed price files as a data source: a partition per file, equality and range filters pushed, offsets by arrival.

``spark.dataSource.register(LandedPrices)``, then ``spark.read.format("landed_prices").load(folder)`` or the same with
``readStream``. Files are Parquet with the columns of the feed, in a store that pyarrow's file systems reach; names starting
with ``_`` or ``.`` are none. Readers hand on Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructType

from ledgerlark.sources.feeds import FEED

ARROW = pa.schema(
    [("stock_symbol", pa.string()), ("timestamp", pa.timestamp("us", tz="UTC"))]
    + [(c, pa.float64()) for c in FEED.fieldNames()[2:]]
)
_COMPARED = {
    EqualTo: lambda field, value: field == value,
    GreaterThan: lambda field, value: field > value,
    GreaterThanOrEqual: lambda field, value: field >= value,
    LessThan: lambda field, value: field < value,
    LessThanOrEqual: lambda field, value: field <= value,
    In: lambda field, value: field.isin(list(value)),
}


@dataclass
class LandedFile(InputPartition):
    uri: str


def landed_files(folder: str) -> list[tuple[int, str]]:
    """(time of arrival in ns, path) of the files in ``folder``, the oldest first."""
    store, root = pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)
    found = store.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    files = [f for f in found if f.is_file and not f.base_name.startswith(("_", "."))]
    return sorted((f.mtime_ns or 0, f.path) for f in files)


def comparable(value, kind: pa.DataType):
    """``value`` as a file's column of type ``kind`` has it: files keep times with or without the zone UTC."""
    if isinstance(value, datetime):
        value = value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)
        value = value if getattr(kind, "tz", None) else value.replace(tzinfo=None)
    return pa.scalar(value, kind)


def batches(folder: str, path: str, filters: Sequence[Filter] = ()) -> Iterator[pa.RecordBatch]:
    store = pafs.FileSystem.from_uri(folder)[0] if "://" in folder or folder.startswith("file:") else pafs.LocalFileSystem()
    file, condition = ds.dataset(path, filesystem=store, format="parquet"), None
    for f in filters:
        kind = file.schema.field(f.attribute[0]).type
        value = [comparable(v, kind) for v in f.value] if isinstance(f, In) else comparable(f.value, kind)
        one = _COMPARED[type(f)](pc.field(f.attribute[0]), value)
        condition = one if condition is None else condition & one
    for batch in file.to_batches(columns=ARROW.names, filter=condition):
        times = batch.column("timestamp").cast(pa.timestamp("us", tz=batch.column("timestamp").type.tz), safe=False)
        columns = [times if f.name == "timestamp" else batch.column(f.name) for f in ARROW]
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, ARROW)], schema=ARROW)


class LandedPrices(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_prices"

    def schema(self) -> StructType:
        return FEED

    def reader(self, schema: StructType) -> DataSourceReader:
        return LandedReader(self.options["path"])

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return LandedStreamReader(self.options["path"])


class LandedReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder, self.taken = folder, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Comparisons of a column with a value go to the files, whose statistics then skip row groups; the others stay."""
        for f in filters:
            if type(f) in _COMPARED and len(f.attribute) == 1:
                self.taken.append(f)
            else:
                yield f

    def partitions(self) -> list[LandedFile]:
        return [LandedFile(path) for _, path in landed_files(self.folder)]

    def read(self, partition: LandedFile | None) -> Iterator[pa.RecordBatch]:
        # Without files Spark asks once, for nothing.
        return batches(self.folder, partition.uri, self.taken) if partition else iter(())


class LandedStreamReader(DataSourceStreamReader):
    """Offsets are the arrival and name of the last file taken; a batch takes what has arrived after it, by arrival and name."""

    def __init__(self, folder: str):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"at": -1, "path": ""}

    def latestOffset(self) -> dict:
        files = landed_files(self.folder)
        return {"at": files[-1][0], "path": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[LandedFile]:
        after, upto = (start["at"], start["path"]), (end["at"], end["path"])
        return [LandedFile(path) for at, path in landed_files(self.folder) if after < (at, path) <= upto]

    def read(self, partition: LandedFile) -> Iterator[pa.RecordBatch]:
        return batches(self.folder, partition.uri)

    def commit(self, end: dict) -> None:
        pass


def register(spark: SparkSession) -> None:
    """Make ``landed_prices`` known to the session and let filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LandedPrices)
