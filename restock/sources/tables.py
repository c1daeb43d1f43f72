"""Parquet tables under one folder, written partition by partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from restock.operators.merge import require_unique, upsert


def touched_partitions(table: DataFrame, incoming: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The rows of the partitions that incoming rows fall into; others are not opened."""
    touched = [tuple(row) for row in incoming.select(*columns).distinct().collect()]
    if not touched:
        return table.limit(0)
    for place, name in enumerate(columns):
        table = table.filter(F.col(name).isin(sorted({values[place] for values in touched})))
    if len(columns) == 1:
        return table
    # Combinations that do not come in stay as they are.
    return table.filter(F.struct(*columns).isin([F.struct(*map(F.lit, values)) for values in touched]))


class TableFolder:
    """Named parquet tables; writes replace only the partitions they touch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def location(self, name: str) -> str:
        return f"{self.path}/{name}"

    def read(self, name: str, schema: StructType | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        table = reader.parquet(self.location(name))
        return table if schema is None else table.select(*schema.names)

    def write(
        self,
        df: DataFrame,
        name: str,
        schema: StructType,
        partition_by: tuple[str, ...] = (),
        order_by: tuple[str, ...] = (),
        mode: str = "overwrite",
    ) -> DataFrame:
        """Write and return the table as read back.

        The rebalance hint gives files of even size: adaptive execution joins small partitions
        and splits a date that holds far more rows than the others.
        """
        rows = df.select(*[df[field.name].cast(field.dataType) for field in schema])
        if partition_by:
            spread = rows.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *order_by)
            writer = spread.write.partitionBy(*partition_by)
        else:
            writer = rows.write
        writer.mode(mode).option("compression", "zstd").parquet(self.location(name))
        return self.read(name, schema)

    def exists(self, name: str) -> bool:
        """Whether a table has been written; a first write that broke off leaves only hidden folders."""
        path = self._path(self.location(name))
        files = path.getFileSystem(self._hadoop_conf())
        if not files.exists(path):
            return False
        names = [status.getPath().getName() for status in files.listStatus(path)]
        return any(not name.startswith((".", "_temporary", ".spark-staging")) for name in names)

    def upsert(
        self,
        incoming: DataFrame,
        name: str,
        schema: StructType,
        keys: list[str],
        partition_by: tuple[str, ...] = (),
        order_by: tuple[str, ...] = (),
        **rules,
    ) -> DataFrame:
        """Upsert into the table, reading and rewriting only the partitions found in the incoming rows.

        Their values are few (dates and models), so they reach the scan as literals. The merged rows go through a checkpoint first, so a lost executor cannot make the job
        read files that the commit is replacing.
        """
        if not self.exists(name):
            require_unique(incoming, keys)
            return self.write(incoming, name, schema, partition_by, order_by)
        existing = self.read(name, schema)
        if partition_by:
            existing = touched_partitions(existing, incoming, partition_by)
        return self.write(upsert(existing, incoming, keys, **rules).checkpoint(), name, schema, partition_by, order_by)

    def drop_partition(self, name: str, column: str, value) -> None:
        """Remove one value of the first partition column, with its files."""
        path = self._path(f"{self.location(name)}/{column}={value}")
        path.getFileSystem(self._hadoop_conf()).delete(path, True)

    def drop(self, name: str) -> None:
        """Remove a table that can be built again."""
        path = self._path(self.location(name))
        path.getFileSystem(self._hadoop_conf()).delete(path, True)

    def truncate(self, schemas: dict[str, StructType]) -> None:
        """Empty the named tables, keeping their columns."""
        for name, schema in schemas.items():
            empty = self.spark.createDataFrame([], schema)
            empty.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.location(name))

    def _path(self, location: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(location)

    def _hadoop_conf(self):
        return self.spark._jsc.hadoopConfiguration()
