"""Statistics and itemsets of the snapshots without reading the history again.

Each refresh reads the micro-batches that came since the last one and writes a
summary of them: for every batch number the rows, and count, mean and sum of
squared deviations of each feature, and how often each item occurs. Summaries of the
same batch add up, so what all refreshes have written gives the figures of any
cumulative snapshot. A summary counts once its ledger entry is there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators.cleaning import MEAN_FILLED, clean_features, present
from marketloom.operators.mining import support_threshold
from marketloom.operators.snapshots import cumulative_snapshots, tier_of_rank
from marketloom.plans.training import require_batches
from marketloom.schema import FEATURES, ITEM_COLUMN, ITEMSET_PREFIX, MIN_SUPPORT, SNAPSHOTS, UNKNOWN_ITEM
from marketloom.session import staged, staging
from marketloom.sources.artifacts import save_itemsets
from marketloom.streaming.ingest import IngestStore

FEATURE_SUMMARY = "batch_no long, feature string, row_count long, present long, mean double, squares double, upto int"
ITEM_SUMMARY = "batch_no long, item string, freq long, upto int"


@dataclass(frozen=True)
class Summaries:
    """The summaries beside a batch store."""

    store: IngestStore

    def path(self, table: str) -> str:
        return f"{self.store.base}/summaries/{table}"

    def entries(self, spark: SparkSession) -> DataFrame:
        """``(since, upto)`` of each committed refresh."""
        try:
            return spark.read.schema("since int, upto int").parquet(self.path("ledger"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], "since int, upto int")

    def read(self, spark: SparkSession, table: str, schema: str) -> DataFrame:
        rows = spark.read.schema(schema).parquet(self.path(table))
        return rows.join(self.entries(spark).select("upto"), "upto", "left_semi")

    def refresh(self, spark: SparkSession) -> tuple[int, int]:
        """Summarise the micro-batches after the last one summarised; returns the first and the last of them."""
        last, _ = self.store.committed(spark)
        done = self.entries(spark).agg(F.coalesce(F.max("upto"), F.lit(-1))).first()[0]
        if last > done:
            new = clean_features(self.store.read_batches(spark).filter(F.col("micro") > done))
            with staging(spark):
                held = staged(new.select("batch_no", *FEATURES, ITEM_COLUMN), "new-features")
                for table, summary in (("features", summarise_features(held)), ("items", summarise_items(held))):
                    summary.write.mode("overwrite").parquet(f"{self.path(table)}/upto={last}")
            entry = spark.range(1).select(F.lit(done + 1).alias("since"))
            entry.write.mode("overwrite").parquet(f"{self.path('ledger')}/upto={last}")
        return done + 1, last

    def statistics(self, spark: SparkSession) -> DataFrame:
        """By snapshot and feature: rows, missing values, fill value, and mean and deviation once they are filled.

        NaN counts as missing. Ratings are filled with their mean, others with 0.0.
        """
        summary = self.read(spark, "features", FEATURE_SUMMARY).withColumn("tier", tier_of_rank(F.col("batch_no")))
        held = cumulative_snapshots(summary)
        n, mean = F.col("present"), F.col("mean")
        whole = held.groupBy("snapshot", "feature").agg(
            F.sum("row_count").alias("all_rows"),
            F.sum("present").alias("all_present"),
            (F.sum(n * mean) / F.nullif(F.sum(n), F.lit(0))).alias("all_mean"),
        )
        # Deviations from the common mean, so that no large squares are subtracted.
        apart = held.join(whole.select("snapshot", "feature", "all_mean"), ["snapshot", "feature"])
        squares = apart.groupBy("snapshot", "feature").agg(
            F.coalesce(F.sum(F.col("squares") + n * (mean - F.col("all_mean")) ** 2), F.lit(0.0)).alias("all_squares")
        )
        rows, there = F.col("all_rows"), F.col("all_present")
        own = F.coalesce("all_mean", F.lit(0.0))
        fill = F.when(F.col("feature") == MEAN_FILLED, own).otherwise(F.lit(0.0))
        filled_mean = (there * own + (rows - there) * fill) / rows
        filled_squares = F.col("all_squares") + there * (own - filled_mean) ** 2 + (rows - there) * (fill - filled_mean) ** 2
        return whole.join(squares, ["snapshot", "feature"]).select(
            "snapshot",
            "feature",
            rows.alias("row_count"),
            (rows - there).alias("missing"),
            fill.alias("fill"),
            filled_mean.alias("mean"),
            F.sqrt(filled_squares / F.nullif(rows - 1, F.lit(0))).alias("deviation"),
        )

    def itemsets(self, spark: SparkSession, min_support: float = MIN_SUPPORT) -> DataFrame:
        """``(snapshot, items, freq)`` of the frequent single items of each snapshot."""
        summary = self.read(spark, "items", ITEM_SUMMARY).withColumn("tier", tier_of_rank(F.col("batch_no")))
        counts = cumulative_snapshots(summary.groupBy("tier", "item").agg(F.sum("freq").alias("freq")))
        counts = counts.groupBy("snapshot", "item").agg(F.sum("freq").alias("freq"))
        totals = counts.groupBy("snapshot").agg(F.sum("freq").alias("total"))
        frequent = counts.join(totals, "snapshot").filter(
            F.col("freq") >= support_threshold(min_support, F.col("total"))
        )
        return frequent.select("snapshot", F.array("item").alias("items"), "freq")


def summarise_features(held: DataFrame) -> DataFrame:
    """A row for each batch number and feature, from one pass with partial sums."""
    figures = [
        F.struct(
            F.lit(c).alias("feature"),
            F.count(F.lit(1)).alias("row_count"),
            F.count(present(c, "missing")).alias("present"),
            F.avg(present(c, "missing")).alias("mean"),
            (F.var_pop(present(c, "missing")) * F.count(present(c, "missing"))).alias("squares"),
        ).alias(f"f{i}")
        for i, c in enumerate(FEATURES)
    ]
    by_batch = held.groupBy("batch_no").agg(*figures)
    return by_batch.select("batch_no", F.inline(F.array(*[F.col(f"f{i}") for i in range(len(FEATURES))])))


def summarise_items(held: DataFrame) -> DataFrame:
    item = F.coalesce(F.col(ITEM_COLUMN), F.lit(UNKNOWN_ITEM)).alias("item")
    return held.groupBy("batch_no", item).agg(F.count(F.lit(1)).alias("freq"))


def refresh_itemsets(
    spark: SparkSession, store: IngestStore, models: str, min_support: float = MIN_SUPPORT
) -> list[str]:
    """Summarise what is new and save the itemsets of all snapshots; returns their paths."""
    known, (_, rows) = store.settings(spark), store.committed(spark)
    require_batches(-(-rows // known["batch_size"]))
    summaries = Summaries(store)
    summaries.refresh(spark)
    with staging(spark):
        found = staged(summaries.itemsets(spark, min_support), "itemsets", ["snapshot"])
        return [
            save_itemsets(found.filter(F.col("snapshot") == name).drop("snapshot"), models, ITEMSET_PREFIX + name)
            for name in SNAPSHOTS
        ]
