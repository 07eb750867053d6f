"""JDBC scans of the warehouse tables, and the same tables as parquet."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from quartermill.schemas import conform


def cuts_sql(source: str, column: str, parts: int) -> str:
    """Query for the first key of each of ``parts`` runs of about equally many rows; the database sorts one column."""
    return (
        f"SELECT MIN(k) AS cut FROM (SELECT {column} AS k, NTILE({parts}) OVER (ORDER BY {column}) AS part "
        f"FROM {source} WHERE {column} IS NOT NULL) r GROUP BY part ORDER BY 1"
    )


def bounds_sql(source: str, column: str) -> str:
    return f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {source}"


def even_cuts(low: int | None, high: int | None, parts: int) -> list[int]:
    """First keys of ``parts`` spans of equal width from low to high."""
    if low is None or high is None:
        return []
    return sorted({low + (high - low + 1) * i // parts for i in range(parts)})


def predicates(column: str, cuts: list[int]) -> list[str]:
    """A condition for each span between ascending first keys; every row, also one without a key, meets exactly one.

    Cuts only steer the load: the first and last span are open, so rows that
    arrive outside the planned range are read all the same.
    """
    cuts = sorted(set(cuts))[1:]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"({column} < {cuts[0]} OR {column} IS NULL)", *inner, f"{column} >= {cuts[-1]}"]


@dataclass(frozen=True)
class Warehouse:
    """Connection settings; credentials come from the caller's secret store."""

    url: str
    user: str
    password: str
    driver: str
    schema: str

    def reader(self, spark: SparkSession, timeout_seconds: int = 300, fetch_size: int = 10_000) -> DataFrameReader:
        return (
            spark.read.format("jdbc")
            .option("url", self.url)
            .option("user", self.user)
            .option("password", self.password)
            .option("driver", self.driver)
            .option("queryTimeout", timeout_seconds)
            .option("fetchsize", fetch_size)
        )

    def table(
        self,
        spark: SparkSession,
        name: str,
        declared: T.StructType,
        partition_column: str | None = None,
        bounds: tuple[int, int] | None = None,
        partitions: int = 200,
        timeout_seconds: int = 300,
        by_rows: bool = True,
    ) -> DataFrame:
        """A table scan split on key ranges; filters on it are pushed to the database.

        Without ``bounds`` the ranges are planned by a query: runs of equally
        many rows, or (``by_rows=False``) equal widths from least to greatest key.
        """
        source = f"{self.schema}.{name}"
        if partition_column and not bounds:
            return conform(self._split(spark, source, partition_column, partitions, timeout_seconds, by_rows), declared, name)
        reader = self.reader(spark, timeout_seconds).option("dbtable", source)
        if partition_column:
            reader = (
                reader.option("partitionColumn", partition_column)
                .option("lowerBound", bounds[0])
                .option("upperBound", bounds[1])
                .option("numPartitions", partitions)
            )
        return conform(reader.load(), declared, name)

    def query(
        self,
        spark: SparkSession,
        sql: str,
        timeout_seconds: int = 300,
        partition_column: str | None = None,
        partitions: int = 200,
        by_rows: bool = True,
    ) -> DataFrame:
        """A query's rows: by one connection, or split on ranges of an integer column of the result."""
        if partition_column:
            return self._split(spark, f"({sql}) q", partition_column, partitions, timeout_seconds, by_rows)
        return self.reader(spark, timeout_seconds).option("query", sql).load()

    def _split(self, spark: SparkSession, source: str, column: str, parts: int, timeout_seconds: int, by_rows: bool) -> DataFrame:
        # At most ``parts`` rows, or one, reach the driver.
        if by_rows:
            cuts = [int(row[0]) for row in self.query(spark, cuts_sql(source, column, parts), timeout_seconds).collect()]
        else:
            low, high = self.query(spark, bounds_sql(source, column), timeout_seconds).first()
            cuts = even_cuts(None if low is None else int(low), None if high is None else int(high), parts)
        return self.reader(spark, timeout_seconds).jdbc(self.url, source, predicates=predicates(column, cuts))


def read_table(spark: SparkSession, path: str, declared: T.StructType, name: str) -> DataFrame:
    """A parquet copy of a warehouse table, checked against its declared columns."""
    return conform(spark.read.parquet(path), declared, name)


def table_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
