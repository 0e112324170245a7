"""Document rates that give domains their share of the tokens, where domains are known by a classifier only.

Everything on the way of the rows is column expressions. A naive Bayes model on
a few binned figures of the text, among them words that are typical of a domain,
learns from a table of labelled documents and gives every document a probability
for each domain. Rates start at one and follow the projected gradient of the
squared distance between expected and wanted domain tokens. A step needs the
domains' totals only, one aggregation over the documents, and the rates after
any number of steps are a function of the summed steps, so no state is kept by row.
"""

from __future__ import annotations

from collections import Counter
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import ascii_words, staged, whole_row, with_results

#: Labelled documents, by the order of their hashes, that typical words are looked for in.
SAMPLE = 8_000
TYPICAL_WORDS = 100
TYPICAL_FACTOR = 12.0
LEAST_SHARE = 0.01
CHANCE_DEVIATIONS = 1.5
#: Upper ends of the bins of each figure.
BINS = {
    "symbols": (0.5, 2.0, 5.0, 20.0),
    "capitals": (1.0, 5.0, 15.0, 40.0),
    "novel": (20.0, 40.0, 60.0, 80.0),
    "words": (50.0, 200.0, 1000.0, 5000.0),
}
TYPICAL_BINS = (0.5, 1.5, 2.5)
SMOOTHING = 0.5


def mix_to_weights(
    df: DataFrame,
    labels: DataFrame,
    weights: dict[str, float],
    text: str = "text",
    key: str = "doc_id",
    carry: list[str] | None = None,
    tolerance: float = 1e-4,
    max_steps: int = 60,
) -> DataFrame:
    """Every row of ``df`` with ``tokens``, ``p_<domain>`` for each domain of ``weights``, and ``rate``.

    ``labels`` has the key and a ``domain``; rows of other domains, and keys that
    are not in ``df``, teach nothing; a key that is there twice teaches twice.
    ``tokens`` counts words. Expected tokens of a domain are the sum of tokens x
    probability x rate. Their targets share out by ``weights`` the total at which
    the domain of the largest weight keeps its present tokens. Rates are not
    negative. Steps end when all totals are within ``tolerance`` of the whole, or
    after ``max_steps``; targets that no rates can reach are approached.

    NULL and blank texts have no tokens but probabilities and a rate like others.
    Without labels all domains are equally probable. ``carry`` names the input
    columns to return (all by default); a result replaces an input column of its
    name. Repeated rows are rated alike; an empty table gives no rows.
    """
    names = df.columns if carry is None else carry
    domains = list(weights)
    known = labels.where(F.col("domain").isin(domains)).select(F.col(key).alias("id"), "domain")
    rows = df.select(whole_row(df, names).alias("row"), F.col(key).alias("id"), F.col(text).alias("text"))
    typical = typical_words(rows.select("id", "text"), known, domains)
    narrow = carry is not None  # whole rows are not written out, but read again for the result
    figured = _figures(rows, typical)
    figures = staged(figured if narrow else figured.drop("row"), "mix-figures")
    posterior = _posterior(class_counts(figures, known), domains, [*typical, *BINS]).alias("p")
    rated = staged(figures.select(*["row"] * narrow, "tokens", posterior), "mix-posteriors")
    slope = fit_rates(rated, domains, weights, tolerance, max_steps)
    if not narrow:
        rated = figured.select("row", "tokens", posterior)
    results = {"tokens": F.col("tokens")}
    results |= {f"p_{domain}": F.get("p", F.lit(d)) for d, domain in enumerate(domains)}
    results["rate"] = _rate(slope)
    return with_results(rated, names, results)


def repeat_by_rate(
    rated: DataFrame, names: list[str], key: str = "doc_id", snap: float = 0.0, seed: int = 42
) -> DataFrame:
    """Rows as often as their rate says, in the columns ``names``.

    A rate between whole numbers is rounded up or down by chance, so that the
    expected number is the rate; the chance comes from a hash of the key. Rates
    within ``snap`` of a whole number are taken as it: fewer documents are left to
    chance, and totals meet the targets less closely.
    """
    near = F.round("rate")
    chance = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 20)) / F.lit(1 << 20)
    times = F.when(F.abs(F.col("rate") - near) <= snap, near).otherwise(F.floor(F.col("rate") + chance)).cast("int")
    repeated = rated.withColumn("_again", F.explode(F.array_repeat(F.lit(0), times)))
    return repeated.select(*names)


def typical_words(rows: DataFrame, known: DataFrame, domains: list[str]) -> dict[str, list[str]]:
    """For each domain, words in a fair share of its sampled documents and in far fewer of the others'.

    The sample is bounded, and so are the words that are taken.
    """
    sample = known.orderBy(F.xxhash64("id"), "id", "domain").limit(SAMPLE)
    words = rows.join(F.broadcast(sample), "id").select("domain", _letter_words().alias("words"))
    words = staged(words, "mix-sample")
    of = {row["domain"]: row["count"] for row in words.groupBy("domain").count().collect()}
    held = words.select("domain", F.explode(F.array_distinct("words")).alias("word")).groupBy("word").pivot("domain", domains).count()
    held = staged(held.na.fill(0), "mix-words")
    found = {}
    for domain in domains:
        n, others = of.get(domain, 0), sum(of.values()) - of.get(domain, 0)
        outside = sum((F.col(f"`{d}`") for d in domains if d != domain), F.lit(0))
        inside = F.col(f"`{domain}`")
        sure = inside - CHANCE_DEVIATIONS * F.sqrt(inside)  # what is left of it if part came by chance
        factor = F.greatest(sure, F.lit(0.0)) / (n + 1.0) / ((outside + 0.5) / (others + 1.0))
        likely = held.where((inside >= LEAST_SHARE * n) & (factor >= TYPICAL_FACTOR))
        top = likely.orderBy(F.desc(inside * F.log(factor)), "word").limit(TYPICAL_WORDS).collect() if n and others else []
        found[domain] = [row["word"] for row in top]
    return found


def class_counts(figures: DataFrame, known: DataFrame) -> dict[str, tuple[int, list[Counter]]]:
    """For each domain its labelled documents, and how they fall into the bins of each figure."""
    taught = figures.select("id", "bins").join(known, "id")
    rows = taught.select("domain", F.posexplode("bins").alias("figure", "bin")).groupBy("domain", "figure", "bin").count()
    found: dict[str, tuple[int, list[Counter]]] = {}
    for row in rows.collect():  # domains x figures x bins
        _, bins = found.setdefault(row["domain"], (0, []))
        bins.extend(Counter() for _ in range(row["figure"] + 1 - len(bins)))
        bins[row["figure"]][row["bin"]] += row["count"]
    return {domain: (bins[0].total(), bins) for domain, (_, bins) in found.items()}


def fit_rates(
    rated: DataFrame, domains: list[str], weights: dict[str, float], tolerance: float, max_steps: int
) -> list[float]:
    """The summed steps ``s`` of the projected gradient: rates are ``max(0, 1 + p . s)``."""
    places = range(len(domains))
    p = [F.get("p", F.lit(d)) for d in places]

    def totals(slope: list[float]) -> tuple[list[float], list[float]]:
        """Expected tokens of the domains at these rates, and present tokens of documents that have a rate."""
        rate = _rate(slope)
        own = [F.col("tokens") * p[d] for d in places]
        sums = [F.sum(x * rate) for x in own] + [F.sum(F.when(rate > 0, x)) for x in own]
        row = [float(x or 0.0) for x in rated.agg(*sums).first()]
        return row[: len(domains)], row[len(domains) :]

    share = [weights[d] / sum(weights.values()) for d in domains]
    main = max(places, key=lambda d: share[d])
    slope, damp = [0.0 for _ in places], 1.0
    expected, active = totals(slope)
    wanted = [active[main] / share[main] * s for s in share]
    whole = sum(wanted) or 1.0

    def miss(values: list[float]) -> float:
        return max(abs(e - w) for e, w in zip(values, wanted, strict=True))

    for _ in range(max_steps):
        if miss(expected) <= tolerance * whole:
            break
        # Rows of the Hessian over documents with a rate, sums of tokens x p x p, add up to these domains' tokens,
        # so the step cannot overshoot unless documents get a rate again; then it is shortened.
        step = [damp * (e - w) / n if n else 0.0 for e, w, n in zip(expected, wanted, active, strict=True)]
        trial = [s - d for s, d in zip(slope, step, strict=True)]
        found, with_rate = totals(trial)
        if miss(found) < miss(expected):
            slope, expected, active, damp = trial, found, with_rate, min(1.0, 1.5 * damp)
        else:
            damp /= 2
    return slope


def _rate(slope: list[float]) -> Column:
    along = sum((F.get("p", F.lit(d)) * s for d, s in enumerate(slope)), F.lit(1.0))
    return F.greatest(F.lit(0.0), along)


def _letter_words() -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+"), "")


def _figures(rows: DataFrame, typical: dict[str, list[str]]) -> DataFrame:
    """``row, id, tokens`` and ``bins``: the bin of each figure, the typical words of each domain first."""
    parts = F.struct(ascii_words(F.col("text")).alias("words"), F.array_distinct(_letter_words()).alias("letters"))
    rows = rows.withColumn("part", F.explode(F.array(parts)))
    words = F.size("part.words")
    chars = F.greatest(F.length(F.coalesce("text", F.lit(""))), F.lit(1))
    hits = [
        F.size(F.array_intersect("part.letters", F.array(*map(F.lit, ws)))) if ws else F.lit(0) for ws in typical.values()
    ]
    values = {
        "symbols": 100 * F.coalesce(F.regexp_count("text", F.lit(r"[#*$%&|<>!]")), F.lit(0)) / F.greatest(words, F.lit(1)),
        "capitals": 100 * F.coalesce(F.regexp_count("text", F.lit("[A-Z]")), F.lit(0)) / chars,
        "novel": 100 * F.size(F.array_distinct("part.words")) / F.greatest(words, F.lit(1)),
        "words": words,
    }
    bins = [_bin(hit, TYPICAL_BINS) for hit in hits] + [_bin(values[name], BINS[name]) for name in BINS]
    return rows.select("row", "id", words.cast("long").alias("tokens"), F.array(*bins).alias("bins"))


def _bin(value: Column, ends: tuple[float, ...]) -> Column:
    return sum(((value > end).cast("int") for end in ends), F.lit(0))


def _posterior(counts: dict[str, tuple[int, list[Counter]]], domains: list[str], figures: list[str]) -> Column:
    """Probabilities of the domains, in their order, by naive Bayes with smoothed counts."""
    whole = sum(n for n, _ in counts.values())
    logs = []
    for domain in domains:
        n, bins = counts.get(domain, (0, [Counter() for _ in figures]))
        score = F.lit(log((n + SMOOTHING) / (whole + SMOOTHING * len(domains))))
        for at, figure in enumerate(figures):
            size = 1 + len(BINS.get(figure, TYPICAL_BINS) if at >= len(domains) else TYPICAL_BINS)
            table = [log((bins[at][b] + SMOOTHING) / (n + SMOOTHING * size)) for b in range(size)]
            score += F.get(F.array(*map(F.lit, table)), F.get("bins", F.lit(at)))
        logs.append(score)
    most = F.greatest(*logs) if len(logs) > 1 else logs[0]
    powers = F.transform(F.array(*logs), lambda x: F.exp(x - most))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))
