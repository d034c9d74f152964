"""Which sales hold a word in their product name: posting lists kept by micro-batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rtmart.functions.columns import keyword_match, tokens
from rtmart.functions.sizing import width
from rtmart.operators import latest, lookups
from rtmart.streaming.hashed_table import HashedTable
from rtmart.streaming.keyed_table import BATCH, KeyedTable

IDS = ["order_id", "order_detail_id"]


class NameIndex:
    """Posting lists: a row per (word, sale), in folders by the word's hash, sorted by word, day and sale.

    A batch adds the words of its own sales. A sale that comes again with another name keeps its old words here; whoever
    searches looks at the sale's present name, so an old word costs a look and never a wrong hit.
    """

    def __init__(self, path: str, buckets: int = 64):
        fields = T.StructType.fromDDL("token string, dt string, order_id string, order_detail_id string")
        self.table = HashedTable(path, fields, ("token", *IDS), "token", then=("dt", *IDS), buckets=buckets)

    def create(self, spark: SparkSession) -> "NameIndex":
        self.table.create(spark)
        return self

    def merge(self, spark: SparkSession, upto: int, most: int = 20) -> None:
        self.table.merge(spark, upto, most)

    def add(self, sales: DataFrame, batch_id: int) -> None:
        words = F.explode(F.array_distinct(tokens(F.col("sku_name"))))
        self.table.write(sales.select(words.alias("token"), "dt", *IDS), batch_id)

    def candidates(self, spark: SparkSession, keyword: str, days: Column | None = None) -> DataFrame:
        """Sales (ids and day) that have or once had every word of the keyword, of the ``days`` that a condition on ``dt`` tells. Only
        the folders of these words are read.

        The shortest list goes through the others, broadcast if it is measured to be small and merged by id if not.
        """
        words = [r[0] for r in spark.range(1).select(F.explode(F.array_distinct(tokens(F.lit(keyword))))).collect()]
        if not words:
            return self.table.batches(spark).select(*IDS, "dt").where(F.lit(False))
        lists = self.table.holding(spark, words)
        lists = lists if days is None else lists.where(days)
        if len(words) == 1:
            return lists.select(*IDS, "dt").distinct()
        sizes = {r["token"]: r["size"] or 0 for r in lists.groupBy("token").agg(F.sum(width(*IDS)).alias("size")).collect()}
        words.sort(key=lambda w: sizes.get(w, 0))
        found = self._list(spark, words[0], days)
        for word in words[1:]:
            found = lookups.narrowed(self._list(spark, word, days), found, IDS, sizes.get(words[0], 0))
        return found.distinct()

    def _list(self, spark: SparkSession, word: str, days: Column | None) -> DataFrame:
        rows = self.table.holding(spark, [word])
        return (rows if days is None else rows.where(days)).select(*IDS, "dt")

    def search(self, spark: SparkSession, sales: KeyedTable, keyword: str, date: str | None = None) -> DataFrame:
        """Sales of a stored table whose present name holds every word of the keyword. A keyword without words finds nothing."""
        rows = sales.batches(spark)
        if date is not None:
            rows = rows.where(F.col("dt") == date)
            if sales.partition != "dt":
                rows = rows.where(F.col(sales.partition) == date[:7])
        return self._present(rows, self.candidates(spark, keyword, None if date is None else F.col("dt") == date), sales, keyword)

    def search_folders(self, spark: SparkSession, sales: KeyedTable, keyword: str, found: KeyedTable) -> DataFrame:
        """:func:`search` of all days, a folder of the sale table after the other, so that no more than one folder's sales are shuffled at
        a time. The folders are by a head of the day, such as its year. The hits are kept in ``found``, a batch per folder."""
        for n, value in enumerate(sales.values(spark)):
            folder = F.col(sales.partition).isNull() if value is None else F.col(sales.partition) == value
            days = None if value is None else F.col("dt").startswith(value)
            rows = sales.batches(spark).where(folder)
            found.write(self._present(rows, self.candidates(spark, keyword, days), sales, keyword), n)
        return found.batches(spark).drop(BATCH)

    @staticmethod
    def _present(rows: DataFrame, asked: DataFrame, sales: KeyedTable, keyword: str) -> DataFrame:
        """Of the rows that are ``asked`` for the newest per sale, where its name still holds every word."""
        rows = lookups.narrowed(rows, asked, IDS)
        rows = latest.latest_per_key(rows, [*sales.key, *sales.steady], [BATCH, *sales.order]).drop(BATCH)
        return rows.where(keyword_match(F.col("sku_name"), keyword))
