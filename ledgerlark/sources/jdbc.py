"""Relational tables over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcSource:
    url: str
    driver: str
    properties: dict[str, str] = field(default_factory=dict)
    fetch_size: int = 10_000

    def options(self, table: str | None = None, query: str | None = None, **parallel: object) -> dict[str, str]:
        """Reader options for a whole table or a pushed-down query.

        ``parallel`` takes partitionColumn, lowerBound, upperBound and numPartitions; the bounds only
        place the cuts, no row is left out. Queries cannot be cut by Spark, so with ``parallel`` a
        query is read as a derived table.
        """
        if (table is None) == (query is None):
            raise ValueError("give a table or a query")
        wanted = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"}
        if parallel and set(parallel) != wanted:
            raise ValueError(f"parallel reads need {sorted(wanted)}")
        out = {"url": self.url, "driver": self.driver, "fetchsize": str(self.fetch_size), **self.properties}
        if table is not None:
            out["dbtable"] = table
        elif parallel:
            out["dbtable"] = f"({query}) AS pushed"
        else:
            out["query"] = query
        return out | {name: str(value) for name, value in parallel.items()}

    def read(
        self, spark: SparkSession, table: str | None = None, query: str | None = None, **parallel: object
    ) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options(table, query, **parallel)).load()
