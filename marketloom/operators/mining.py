"""Item support, frequent itemsets and association rules."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.schema import ITEM_COLUMN, MIN_CONFIDENCE, MIN_SUPPORT
from marketloom.session import staged


def support_threshold(min_support: float, total: Column) -> Column:
    """Smallest count that reaches the support."""
    return F.ceil(F.lit(float(min_support)) * total)


def item_support(
    df: DataFrame, item: str = ITEM_COLUMN, min_support: float = MIN_SUPPORT
) -> DataFrame:
    """Frequent itemsets of one-item transactions, as ``(items, freq)``.

    Equal to FP-growth over ``array(item)``, as one aggregate with map-side
    combine. The row total is summed from the same counts, whose shuffle is
    reused, so the data is scanned once.
    """
    counts = df.groupBy(F.col(item).alias("item")).agg(F.count(F.lit(1)).alias("freq"))
    total = counts.agg(F.sum("freq")).scalar()
    return counts.filter(F.col("freq") >= support_threshold(min_support, total)).select(
        F.array("item").alias("items"), "freq"
    )


def collect_baskets(
    df: DataFrame, key: str, item: str, min_support: float = MIN_SUPPORT
) -> DataFrame:
    """Distinct items per key, as ``(key, items)``, without items below the support.

    Such items are in no frequent itemset. Dropping them first bounds a basket by
    the number of frequent items (mean basket size / support), however many rows
    its key has; duplicates are removed before any basket is built. Every key
    with an item keeps its row, as the support counts baskets.

    The distinct pairs are read three times, so they are staged.
    """
    pairs = staged(df.filter(F.col(item).isNotNull()).select(key, item).distinct(), "pairs")
    total = pairs.agg(F.count_distinct(key)).scalar()
    counts = pairs.groupBy(item).agg(F.count(F.lit(1)).alias("_baskets"))
    frequent = staged(
        counts.filter(F.col("_baskets") >= support_threshold(min_support, total)).select(
            item, F.lit(True).alias("_frequent")
        ),
        "frequent",
    )
    return (
        pairs.join(frequent, item, "left")
        .groupBy(key)
        .agg(F.collect_list(F.when(F.col("_frequent"), F.col(item))).alias("items"))
    )


def transactions(df: DataFrame, items: str = "items") -> DataFrame:
    """Non-empty item sets: no NULL items, no duplicates."""
    clean = df.withColumn(items, F.array_distinct(F.array_compact(items)))
    return clean.filter(F.col(items).isNotNull() & (F.size(items) > 0))


def fit_itemsets(
    df: DataFrame,
    items: str = "items",
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> FPGrowthModel:
    """FP-growth over rows of distinct items; empty rows count towards the support."""
    growth = FPGrowth(itemsCol=items, minSupport=min_support, minConfidence=min_confidence)
    return growth.fit(df.select(items))


def frequent_itemsets(model: FPGrowthModel) -> DataFrame:
    """``(items, freq)`` with the items of a set in text order.

    Lazy: every use grows the trees anew from the input of the fit.
    """
    return model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")


def mine_baskets(
    baskets: DataFrame, items: str = "items", min_support: float = MIN_SUPPORT
) -> tuple[DataFrame, int]:
    """Frequent itemsets as a staged table, and the number of baskets.

    The miner reads its input several times and its result is lazy, so both are
    written to the shared folder: baskets are built once and mined once.
    """
    ready = staged(baskets.select(items), "baskets")
    model = fit_itemsets(ready, items, min_support)
    return staged(frequent_itemsets(model), "itemsets"), ready.count()


def association_rules(
    itemsets: DataFrame, total: int, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """``(antecedent, consequent, confidence, lift, support)`` from itemsets and row count.

    One rule per item of a set: the others imply it. Their frequencies are
    looked up among the itemsets, which hold every subset of each set.
    """
    consequent = F.array("item")
    rules = itemsets.filter(F.size("items") > 1).select(
        "items", F.col("freq").alias("together"), F.explode("items").alias("item")
    )
    rules = rules.select(
        F.array_except("items", consequent).alias("antecedent"),
        consequent.alias("consequent"),
        "together",
    )
    before = itemsets.select(F.col("items").alias("antecedent"), F.col("freq").alias("_before"))
    alone = (
        itemsets.filter(F.size("items") == 1)
        .select(F.col("items").alias("consequent"), F.col("freq").alias("_alone"))
    )
    confidence = F.col("together") / F.col("_before")
    return (
        rules.join(before, "antecedent")
        .filter(confidence >= F.lit(float(min_confidence)))
        .join(alone, "consequent")
        .select(
            "antecedent",
            "consequent",
            confidence.alias("confidence"),
            (confidence / (F.col("_alone") / F.lit(total))).alias("lift"),
            (F.col("together") / F.lit(total)).alias("support"),
        )
    )
