"""The driver's test tables and the stand-ins the queries use for the
reference's inputs (works, venues, ratings, movies, ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class StandIns:
    """Stand-ins, all derived from the driver's tables:

    venue = supplier; work = order (year of ``o_orderdate``, title = text of the
    document with the same id, NULL if none); host = (l_suppkey, l_orderkey);
    citation = (l_orderkey -> l_partkey * 8); movie = part (title ``p_name``,
    genres = its words); rating = line item (user ``o_custkey``, item
    ``l_partkey``, value ``l_quantity``); tag = line item with
    ``l_discount >= 0.1``; author = customer.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def t(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def texts(self, name: str) -> DataFrame:
        """A table of long texts."""
        return table(self.spark, self.sf_dir, name)

    def venues(self) -> DataFrame:
        return self.t("supplier").select(F.col("s_suppkey").alias("venue_id"))

    def host(self) -> DataFrame:
        return self.t("lineitem").select(F.col("l_suppkey").alias("venue_id"),
                                         F.col("l_orderkey").alias("work_id"))

    def works(self) -> DataFrame:
        return self.t("orders").select(F.col("o_orderkey").alias("work_id"),
                                       F.year("o_orderdate").alias("publication_year"))

    def years(self) -> DataFrame:
        return self.t("orders").select(F.year("o_orderdate").alias("year"))

    def works_titled(self) -> DataFrame:
        docs = self.t("documents").select(F.col("doc_id").alias("id"), F.col("text").alias("title"))
        return (self.t("orders")
                .select(F.col("o_orderkey").alias("id"),
                        F.year("o_orderdate").alias("publication_year"))
                .join(docs, "id", "left"))

    def references(self) -> DataFrame:
        return self.t("lineitem").select(F.col("l_orderkey").alias("work_id"),
                                         (F.col("l_partkey") * 8).alias("referenced_work_id"))

    def ratings(self) -> DataFrame:
        return self.t("lineitem").select(F.col("l_partkey").alias("item_id"),
                                         F.col("l_quantity").alias("rating"))

    def movies(self) -> DataFrame:
        return self.t("part").select(F.col("p_partkey").alias("item_id"),
                                     F.col("p_name").alias("title"))

    def tags(self) -> DataFrame:
        return (self.t("lineitem").where(F.col("l_discount") >= 0.1)
                .select(F.col("l_partkey").alias("item_id")))
