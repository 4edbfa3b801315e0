"""JDBC table source."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegralType

SPLIT = 16  # parts that a range with too many rows is cut into
SUMS_PER_QUERY = 200

Range = tuple[int, int]


def even_ranges(low: int, high: int, total: int, parts: int,
                count: Callable[[Sequence[Range]], Sequence[int]]) -> list[Range]:
    """At most about ``parts`` ranges that cover [low, high] and hold about as many rows each,
    whatever the distribution: ranges with more than their share are cut again and counted
    (``count`` takes ranges and returns their rows), then neighbours are joined. Only one key
    value by itself can hold more than a share."""
    share = -(-total // parts)
    pieces = [(low, high, total)]
    while any(n > share and b > a for a, b, n in pieces):
        finer: list[tuple[int, int, int | None]] = []
        for a, b, n in pieces:
            if n <= share or a == b:
                finer.append((a, b, n))
                continue
            width = -(-(b - a + 1) // SPLIT)
            finer += [(x, min(x + width - 1, b), None) for x in range(a, b + 1, width)]
        counts = iter(count([(a, b) for a, b, n in finer if n is None]))
        pieces = [(a, b, next(counts) if n is None else n) for a, b, n in finer]
    joined: list[tuple[int, int, int]] = []
    for a, b, n in pieces:
        if joined and joined[-1][2] + n <= share:
            joined[-1] = (joined[-1][0], b, joined[-1][2] + n)
        else:
            joined.append((a, b, n))
    return [(a, b) for a, b, _ in joined]


def read_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
               partition_column: str | None = None, lower_bound: int | None = None,
               upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """``SELECT *`` of a table as a DataFrame.

    Without ``partition_column`` one connection reads everything. With it (an integer column)
    ``num_partitions`` must be given. With bounds too, Spark's equal strides between them are read.
    Without bounds they are measured: the database returns least, greatest and number of the
    values, then counts by ranges until each holds a fair share, so skewed keys are read evenly;
    rows without a value are a partition of their own.
    """
    properties = dict(properties or {})
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if not partition_column:
        return reader.load()
    if not num_partitions:
        raise ValueError("a parallel read needs num_partitions")
    if lower_bound is not None and upper_bound is not None:
        return (reader.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
                .option("upperBound", upper_bound).option("numPartitions", num_partitions).load())
    kinds = {f.name.lower(): f for f in reader.load().schema.fields}
    column = kinds.get(partition_column.lower())
    if column is None or not isinstance(column.dataType, IntegralType):
        raise ValueError(f"{partition_column} is not an integer column of {table}")
    name = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(column.name)

    def ask(expressions: Sequence[str], where: str = "") -> list[int]:
        listed = ", ".join(f"{e} AS c{i}" for i, e in enumerate(expressions))
        row = read_table(spark, url, f"(SELECT {listed} FROM {table} asked{where}) measured", properties).first()
        return [None if v is None else int(v) for v in row]

    def count(ranges: Sequence[Range]) -> list[int]:
        out: list[int] = []
        for i in range(0, len(ranges), SUMS_PER_QUERY):
            own = ranges[i:i + SUMS_PER_QUERY]
            sums = [f"SUM(CASE WHEN {name} BETWEEN {a} AND {b} THEN 1 ELSE 0 END)" for a, b in own]
            out += [n or 0 for n in ask(sums, f" WHERE {name} BETWEEN {own[0][0]} AND {own[-1][1]}")]
        return out

    low, high, rows, valued = ask([f"MIN({name})", f"MAX({name})", "COUNT(*)", f"COUNT({name})"])
    ranges = even_ranges(low, high, valued, num_partitions, count) if valued else []
    predicates = [f"{name} BETWEEN {a} AND {b}" for a, b in ranges]
    # the ends stay open: rows that arrive while we measure are read as well
    if predicates:
        predicates[0] = f"{name} <= {ranges[0][1]}"
        predicates[-1] = f"{name} >= {ranges[-1][0]}" if len(ranges) > 1 else f"{name} IS NOT NULL"
    if rows > valued or not predicates:
        predicates.append(f"{name} IS NULL")
    return spark.read.jdbc(url, table, predicates=predicates, properties={k: str(v) for k, v in properties.items()})
