"""URLs allowed or blocked by rules, and by a ratio of character language models where no rule fits.

URLs that a rule decides are the examples: one variable-order Markov model
learns the accepted, another the rejected ones. Counts come from all examples
and stay a table; rows are judged in blocks, each with the counts of its own
grams. A tenth of the examples, by hash, is held out and sets the threshold.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import staged, whole_row, with_results
from marketloom.llm.shipping import ship_code

ORDER = 5
#: Characters beyond visible ASCII count as one.
ALPHABET = 96
OTHER, BEGIN, END = "ÿ", "\u0002", "\u0003"
FLUSH = 500_000
#: Characters of a block of rows, which bound the grams that one task looks up at a time.
BLOCK_CHARS = 100_000
SCORE_STEP = 0.01
VERDICTS = ("allow", "block")


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains, and a start of the path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass
class MarkovModel:
    """Witten-Bell smoothed: a context falls back on its shorter ones by how many characters followed it."""

    grams: dict[str, int]
    followed: dict[str, tuple[int, int]] = field(default_factory=dict)
    known: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.followed:
            return
        for gram, n in self.grams.items():
            total, kinds = self.followed.get(gram[:-1], (0, 0))
            self.followed[gram[:-1]] = (total + n, kinds + 1)

    def chance(self, gram: str) -> float:
        """Of the last character of ``gram`` after the others."""
        if gram in self.known:
            return self.known[gram]
        shorter = self.chance(gram[1:]) if len(gram) > 1 else 1 / ALPHABET
        total, kinds = self.followed.get(gram[:-1], (0, 0))
        chance = (self.grams.get(gram, 0) + kinds * shorter) / (total + kinds) if total else shorter
        if len(self.known) < FLUSH:
            self.known[gram] = chance
        return chance

    def log_likelihood(self, marked: str, order: int) -> float:
        return sum(log(self.chance(marked[max(0, at - order) : at + 1])) for at in range(1, len(marked)))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z in lower case, and path; both empty for NULL or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    upper = "".join(map(chr, range(65, 91)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, upper.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as its place in ``rules``; NULL if none does."""
    chosen = F.lit(None).cast("int")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, rules.index(rule)).otherwise(chosen)
    return chosen


def filter_urls(
    df: DataFrame,
    rules: list[Rule],
    url: str = "url",
    carry: list[str] | None = None,
    order: int = ORDER,
) -> DataFrame:
    """Every row of ``df`` with ``host``, ``path``, ``rule``, ``verdict`` and ``score``.

    ``score`` is the difference of the log-likelihoods of the whole URL under the
    accepted and the rejected URLs' models, by character; ``rule`` the text of the
    rule that decides by host and path, else NULL, and then the verdict is ``allow``
    where the score reaches the threshold. A URL that is NULL or without ``://``
    has empty parts; it is scored by its text, NULL as the empty one. With no example of one kind, models and threshold are
    those of no data, and every score is what smoothing leaves. The models hold
    every gram of every example that is not held out, as a table. ``carry`` names
    the input columns to return (all by default), which are written out with the
    parts; a result replaces an input column of its name. Repeated rows are judged
    alike; an empty table gives no rows.
    """
    names = df.columns if carry is None else carry
    host, path = url_parts(F.col("url"))
    rows = df.select(whole_row(df, names).alias("row"), F.col(url).alias("url"))
    rows = rows.select("row", F.xxhash64("url").alias("hash"), F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    place = fitting_rule(F.col("host"), F.col("path"), rules)
    texts = F.array(*[F.lit(rule.text) for rule in rules])
    verdicts = F.array(*[F.lit(rule.verdict) for rule in rules])
    ruled = rows.withColumn("place", place).select(
        "row", "url", "host", "path", F.get(texts, F.col("place")).alias("rule"), F.get(verdicts, F.col("place")).alias("ruled"),
        (F.pmod("hash", F.lit(10)) == 0).alias("held"),
    )
    ruled = staged(_in_blocks(ruled), "url-rows")
    counted = count_grams(ruled.where("rule is not null and not held").select("ruled", "url"), order)
    judged = staged(_scored(ruled, _facts(counted), order), "url-scores")
    threshold = _threshold(judged.where("rule is not null and held"))
    results = {
        "host": F.col("host"),
        "path": F.col("path"),
        "rule": F.col("rule"),
        "verdict": F.coalesce("ruled", F.when(F.col("score") >= threshold, "allow").otherwise("block")),
        "score": F.col("score"),
    }
    return with_results(judged, names, results)


def marked(*texts: str) -> str:
    text = "".join(c if "!" <= c <= "~" else OTHER for c in "".join(texts))
    return BEGIN + text + END


def count_grams(examples: DataFrame, order: int, flush: int = FLUSH) -> DataFrame:
    """``ruled, gram, n``: all runs of up to ``order`` characters and the next one, for either verdict.

    A row's text is its columns besides ``ruled``, one after the other. ``flush``
    bounds the grams that a task holds before it passes them on.
    """
    ship_code(examples.sparkSession)
    columns = [name for name in examples.columns if name != "ruled"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            keys = list(grams)
            arrays = [pa.array([v for v, _ in keys], pa.string()), pa.array([g for _, g in keys], pa.string()), pa.array(list(grams.values()), pa.int64())]
            grams.clear()
            return pa.RecordBatch.from_arrays(arrays, ["ruled", "gram", "n"])

        for batch in batches:
            for verdict, *texts in zip(*(batch.column(n).to_pylist() for n in ["ruled", *columns]), strict=True):
                text = marked(*texts)
                for at in range(1, len(text)):
                    for start in range(max(0, at - order), at + 1):
                        grams[verdict, text[start : at + 1]] += 1
                    if len(grams) >= flush:
                        yield flushed()
        yield flushed()

    partial = examples.select("ruled", *columns).mapInArrow(count, "ruled string, gram string, n long")
    return staged(partial.groupBy("ruled", "gram").agg(F.sum("n").alias("n")), "url-grams")


def fit_models(examples: DataFrame, order: int, flush: int = FLUSH) -> dict[str, dict[str, int]]:
    """All counts of a few examples on the driver, by verdict; ``filter_urls`` leaves them in their table."""
    models: dict[str, dict[str, int]] = {"allow": {}, "block": {}}
    for row in count_grams(examples, order, flush).collect():
        models[row["ruled"]][row["gram"]] = row["n"]
    return models


def _facts(counted: DataFrame) -> DataFrame:
    """For each gram or context: how often it is there, and the number and kinds of what follows it, by verdict."""
    gram = F.col("gram")
    zero = F.lit(0).cast("long")
    uses = F.array(
        F.struct(gram.alias("key"), F.col("n").alias("n"), zero.alias("total"), zero.alias("kinds")),
        F.struct(F.expr("left(gram, length(gram) - 1)").alias("key"), zero.alias("n"), F.col("n").alias("total"), F.lit(1).cast("long").alias("kinds")),
    )
    used = counted.select("ruled", F.explode(uses).alias("use")).select("ruled", "use.*")
    sums = [
        F.sum(F.when(F.col("ruled") == verdict, F.col(name)).otherwise(zero)).alias(f"{verdict}_{name}")
        for verdict in VERDICTS
        for name in ("n", "total", "kinds")
    ]
    return staged(used.groupBy("key").agg(*sums), "url-facts")


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Rows with ``block``: neighbours of up to ``BLOCK_CHARS`` characters together, or one row that has more."""
    ship_code(rows.sparkSession)
    schema = rows.select("*", F.lit(0).cast("long").alias("block")).schema

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, chars = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            blocks = []
            for url in batch.column("url").to_pylist():
                size = 2 + len(url)
                if chars and chars + size > BLOCK_CHARS:
                    block, chars = block + 1, 0
                chars += size
                blocks.append(block)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blocks, pa.int64())], schema.names)

    return rows.mapInArrow(number, schema)


def _scored(ruled: DataFrame, facts: DataFrame, order: int) -> DataFrame:
    """Rows with ``score``; every block of them meets the facts of its own grams, so no task holds a whole model."""
    schema = ruled.drop("block").select("*", F.lit(0.0).alias("score")).schema

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, found = None, set()
        for batch in batches:
            for block, url in zip(batch.column("block").to_pylist(), batch.column("url").to_pylist(), strict=True):
                if block != at:
                    yield _keys_batch(at, found)
                    at, found = block, set()
                text = marked(url)
                found.update(text[start:end] for end in range(len(text) + 1) for start in range(max(0, end - order - 1), end + 1))
        yield _keys_batch(at, found)

    def score(rows: pa.Table, known: pa.Table) -> pa.Table:
        names = known.column("key").to_pylist()
        models = []
        for verdict in VERDICTS:
            n, total, kinds = (known.column(f"{verdict}_{name}").to_pylist() for name in ("n", "total", "kinds"))
            grams = {key: value for key, value in zip(names, n, strict=True) if value}
            followed = {key: (t, k) for key, t, k in zip(names, total, kinds, strict=True) if t}
            models.append(MarkovModel(grams, followed))
        allow, block = models
        scores = []
        for url in rows.column("url").to_pylist():
            text = marked(url)
            apart = allow.log_likelihood(text, order) - block.log_likelihood(text, order)
            scores.append(apart / (len(text) - 1))
        return rows.drop_columns(["block"]).append_column("score", pa.array(scores, pa.float64()))

    # Spark guesses the grams to be as large as their URLs in files, a hundredth of what they are, and would broadcast them.
    grams = ruled.select("block", "url").mapInArrow(keys, "block long, key string").hint("merge")
    needed = grams.join(facts, "key")
    return ruled.groupBy("block").cogroup(needed.groupBy("block")).applyInArrow(score, schema)


def _keys_batch(block: int | None, found: set[str]) -> pa.RecordBatch:
    arrays = [pa.array([block] * len(found), pa.int64()), pa.array(list(found), pa.string())]
    return pa.RecordBatch.from_arrays(arrays, ["block", "key"])


def _threshold(held: DataFrame) -> float:
    """The score that splits held-out examples best, both kinds weighing the same; 0 without both."""
    step = F.floor(F.col("score") / SCORE_STEP).cast("int")
    # Scores lie within the log of the smallest chance, so the steps are few thousand at most.
    bins = held.groupBy(step.alias("step"), "ruled").count().collect()
    good = Counter({row["step"]: row["count"] for row in bins if row["ruled"] == "allow"})
    bad = Counter({row["step"]: row["count"] for row in bins if row["ruled"] == "block"})
    if not good or not bad:
        return 0.0
    below_good = below_bad = 0
    best, cut, last = -1.0, 0.0, None
    for at in sorted({*good, *bad}):
        right = below_bad / bad.total() - below_good / good.total()
        if right > best:  # halfway between this step and the one before
            best, cut = right, at if last is None else (last + 1 + at) / 2
        below_good, below_bad, last = below_good + good[at], below_bad + bad[at], at
    return cut * SCORE_STEP
