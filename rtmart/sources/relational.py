"""Relational tables over JDBC, read as whole frames and joined, never row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rtmart.schemas import USER_INFO


def jdbc_options(url: str, table: str, user: str = "", password: str = "", driver: str = "", **extra) -> dict[str, str]:
    named = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}
    return {k: str(v) for k, v in {**named, **extra}.items() if v not in ("", None)}


def read_table(
    spark: SparkSession,
    options: dict[str, str],
    split_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    splits: int = 1,
) -> DataFrame:
    """Read a table, in ``splits`` parallel ranges of a numeric or date column when bounds are given."""
    reader = spark.read.format("jdbc").options(**options)
    if split_column and bounds:
        low, high = bounds
        reader = reader.options(partitionColumn=split_column, lowerBound=low, upperBound=high, numPartitions=splits)
    return reader.load()


def read_users(spark: SparkSession, options: dict[str, str], **split) -> DataFrame:
    """The five user columns."""
    return read_table(spark, options, **split).select(*[c for c in USER_INFO.fieldNames()])


def read_single_column(spark: SparkSession, options: dict[str, str], column: str, **split) -> DataFrame:
    """One column of a table, such as the black list's ids; ``split`` as in :func:`read_table`."""
    return read_table(spark, options, **split).select(column)


def key_queries(table: str, key: str, ids: list[str], group: int = 500) -> list[str]:
    """Sub-queries for ``dbtable`` that ask a relational table for some ids only, ``group`` of them each."""
    quoted = ["'" + str(i).replace("'", "''") + "'" for i in ids]
    parts = [quoted[i : i + group] for i in range(0, len(quoted), group)]
    return [f"(SELECT * FROM {table} WHERE {key} IN ({', '.join(p)})) t" for p in parts]


def append_rows(df: DataFrame, options: dict[str, str], batch_rows: int = 1000, writers: int | None = None) -> None:
    """Insert rows in JDBC batches. One transaction per partition, so keep the target keyed for retries."""
    out = df.coalesce(writers) if writers else df
    out.write.format("jdbc").options(**options).option("batchsize", batch_rows).mode("append").save()
