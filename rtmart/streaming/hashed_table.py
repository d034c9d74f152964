"""Keyed tables in folders by the hash of one column, for look-ups that read what they ask for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rtmart.functions.sizing import width
from rtmart.operators import lookups
from rtmart.streaming.keyed_table import BATCH, KeyedTable

BUCKET = "bucket"
PUSHED_KEYS = 1000  # up to so many keys stand in the condition itself and meet the Bloom filters


class HashedTable:
    """Rows of ``schema`` in folders by the hash of the column ``by``, sorted by it, with a Bloom filter on it.

    A look-up names its folders, so others are not listed for reading. Few keys also go to the scan as a condition: row groups
    whose Bloom filter has none of them and pages whose range has none are skipped. More keys are joined, see
    :func:`lookups.narrowed`. Take ``buckets`` so that a folder is a few files; a table keeps the number that it was begun with.
    """

    def __init__(self, path: str, schema: T.StructType, key: tuple[str, ...], by: str, order=(), then: tuple[str, ...] = (), buckets: int = 64):
        self.by, self.buckets, self.key, self.order, self._fields = by, buckets, key, tuple(order), schema.fieldNames()
        full = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        self.table = KeyedTable(path, full, key, BUCKET, self.order, (BUCKET,), sorted_by=(by, *then), bloom=by)
        self.path = path

    def create(self, spark: SparkSession) -> "HashedTable":
        self.table.create(spark)
        return self

    def bucket(self, value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(self.buckets)).cast("int")

    def write(self, rows: DataFrame, batch_id: int) -> None:
        self.table.write(rows.withColumn(BUCKET, self.bucket(F.col(self.by))), batch_id)

    def merge(self, spark: SparkSession, upto: int, most: int = 20) -> None:
        self.table.merge(spark, upto, most)

    def batches(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        return self.table.batches(spark, before).select(*self._fields, BATCH)

    def latest(self, spark: SparkSession) -> DataFrame:
        return self.table.latest(spark).select(*self._fields)

    def holding(self, spark: SparkSession, values: list[str]) -> DataFrame:
        """The rows of all batches whose ``by`` is one of a few ``values``. The hashes are folded when the plan is made."""
        folders = F.col(BUCKET).isin(*[self.bucket(F.lit(v)) for v in values])
        return self.table.batches(spark).where(folders & F.col(self.by).isin(*values)).select(*self._fields, BATCH)

    def asked(self, spark: SparkSession, keys: DataFrame) -> DataFrame:
        """The rows of all batches whose ``by`` is among ``keys`` (one column of that name), which should be cheap to read twice."""
        keys = keys.select(self.by).where(F.col(self.by).isNotNull()).distinct()
        found = keys.agg(
            F.count(F.lit(1)).alias("n"), F.sum(width(self.by)).alias("size"), F.collect_set(self.bucket(F.col(self.by))).alias("buckets")
        ).first()
        if found["n"] <= PUSHED_KEYS:
            values = sorted(r[0] for r in keys.limit(PUSHED_KEYS + 1).collect())
            return self.holding(spark, values) if values else self.batches(spark).where(F.lit(False))
        rows = self.table.batches(spark).where(F.col(BUCKET).isin(*found["buckets"])).select(*self._fields, BATCH)
        return lookups.narrowed(rows, keys, [self.by], found["size"])
