import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from marketloom.operators import mining


def found(df):
    return {tuple(r["items"]): r.freq for r in df.collect()}


@pytest.mark.parametrize(
    ("support", "want"),
    [
        (0.3, {("A",): 6, ("B",): 3}),
        (0.31, {("A",): 6}),
        (0.1, {("A",): 6, ("B",): 3, ("C",): 1}),
    ],
)
def test_single_items(spark, support, want):
    df = spark.createDataFrame([(c,) for c in "AAAAAABBBC"], "Category string")
    assert found(mining.item_support(df, min_support=support)) == want
    single = df.select(F.array("Category").alias("items"))
    model = mining.fit_itemsets(single, min_support=support)
    assert found(mining.frequent_itemsets(model)) == want
    assert model.associationRules.count() == 0
    assert mining.association_rules(mining.frequent_itemsets(model), 10).count() == 0


def test_counts_are_scanned_once(spark, tmp_path):
    spark.range(1000).select((F.col("id") % 7).cast("string").alias("Category")).write.parquet(
        str(tmp_path / "t")
    )
    support = mining.item_support(spark.read.parquet(str(tmp_path / "t")))
    support.collect()
    plan = support._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("== Initial Plan ==")[0]


def test_transactions_are_clean_sets(spark):
    rows = [(["b", "a", "b", None],), ([],), (None,), ([None],), (["c"],)]
    df = spark.createDataFrame(rows, "items array<string>")
    assert [r["items"] for r in mining.transactions(df).collect()] == [["b", "a"], ["c"]]


def brute_force(baskets, support):
    least = math.ceil(support * len(baskets))
    counts = {}
    for basket in baskets.values():
        for size in range(1, len(basket) + 1):
            for items in itertools.combinations(sorted(basket), size):
                counts[items] = counts.get(items, 0) + 1
    return {k: v for k, v in counts.items() if v >= least}


def test_baskets_with_a_hot_key(spark):
    """One key holds a third of all rows, one item is in most baskets."""
    rng = random.Random(5)
    rows = [("hot", f"i{rng.randint(0, 400)}") for _ in range(1_500)]
    for key in range(400):
        rows += [(f"k{key}", "common")] if key % 5 else []
        rows += [(f"k{key}", f"i{min(rng.randint(0, 12), rng.randint(0, 12))}") for _ in range(8)]
    rows += [("lonely", None)]
    baskets = {}
    for key, item in rows:
        if item is not None:
            baskets.setdefault(key, set()).add(item)
    df = spark.createDataFrame(rows, "k string, item string").repartition(6)
    support = 0.1
    collected = mining.collect_baskets(df, "k", "item", support)
    assert collected.count() == len(baskets)
    kept = {k: v & {i for (i,) in brute_single(baskets, support)} for k, v in baskets.items()}
    assert {r.k: set(r["items"]) for r in collected.collect()} == kept
    want = brute_force(kept, support)
    itemsets, total = mining.mine_baskets(collected, min_support=support)
    assert found(itemsets) == want and total == len(baskets)
    rules = mining.association_rules(itemsets, total, 0.5).collect()
    model = mining.fit_itemsets(collected, min_support=support, min_confidence=0.5)
    same = model.associationRules.collect()
    assert rules and {sides(r): measures(r) for r in rules} == {
        sides(r): pytest.approx(measures(r)) for r in same
    }
    for rule in rules:
        together = tuple(sorted([*rule.antecedent, *rule.consequent]))
        confidence = want[together] / want[tuple(rule.antecedent)]
        assert rule.confidence == pytest.approx(confidence) and confidence >= 0.5
        assert rule.support == pytest.approx(want[together] / len(baskets))
        assert rule.lift == pytest.approx(
            confidence / (want[tuple(rule.consequent)] / len(baskets))
        )


def sides(rule):
    return tuple(sorted(rule.antecedent)), tuple(rule.consequent)


def measures(rule):
    return rule.confidence, rule.lift, rule.support


def brute_single(baskets, support):
    least = math.ceil(support * len(baskets))
    counts = {}
    for basket in baskets.values():
        for item in basket:
            counts[item] = counts.get(item, 0) + 1
    return [(item,) for item, n in counts.items() if n >= least]


def test_support_is_anti_monotone(spark):
    df = spark.createDataFrame(
        [(k, i) for k in range(60) for i in "abcdef" if hash((k * 7 + ord(i)) % 5) > 1],
        "k int, i string",
    )
    sets = found(mining.frequent_itemsets(mining.fit_itemsets(mining.collect_baskets(df, "k", "i", 0.1), min_support=0.1)))
    for items, freq in sets.items():
        for item in items:
            rest = tuple(x for x in items if x != item)
            assert not rest or sets[rest] >= freq
