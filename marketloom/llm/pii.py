"""Personal data in texts: exact patterns, and further spans by weak supervision.

Everything on the way of the rows is column expressions. Candidates are what the
patterns match, valid or not, and looser shapes. Labelers (pattern, gazetteer,
context and shape) vote on each; the votes are counted over all documents; a
few thousand counts at most reach the driver, where expectation-maximisation
estimates how reliable each labeler is and a logistic span classifier is
trained on the resulting probabilities. Its weights go back as literals.
"""

from __future__ import annotations

from collections.abc import Callable
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import staged, whole_row, with_results

KINDS = ("email", "ip", "card", "phone")

# The exact patterns. Possessive repeats and the look at the character before keep the
# search linear; they change no match, as a match from the middle of a run could start at its head.
EXACT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser shapes. Addresses are spelled out; IPv6 is written in full or with its zeros left
# out; phone numbers are of ten digits in threes and four, begin with a trunk zero, or have nine digits in threes.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\[at\]|\(at\)|(?<=\x20)at(?=\x20))\x20?[A-Za-z0-9-]++"
    r"(?:\x20?(?:\[dot\]|\(dot\)|(?<=\x20)dot(?=\x20)|\.)\x20?[A-Za-z0-9-]{2,}+)++",
    "ip": r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}|(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?"
    r"::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![0-9A-Za-z:])",
    "phone": r"(?<![0-9A-Za-z+./-])(?:(?:\+[0-9]{1,3}[\x20.-])?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}"
    r"|\(?0[0-9]{1,4}\)?(?:[\x20./-][0-9]{2,8}){1,5}|[6-9][0-9]{2}\x20[0-9]{3}\x20[0-9]{3})(?![0-9A-Za-z]|[./-][0-9])",
}
DATE = r"^[0-9]{1,2}([./-])[0-9]{1,2}\1[0-9]{2,4}$"
# A text without this needs no search for the kind.
HINT = {
    ("email", True): "@", ("ip", True): "[0-9]\\.[0-9]", ("card", True): "[0-9]{2}|[0-9][ -][0-9]", ("phone", True): "\\+[0-9]",
    ("email", False): "[(\\[ ](?:at)[)\\] ]", ("ip", False): "[0-9A-Fa-f]:[0-9A-Fa-f]|::", ("phone", False): "[0-9]{3}[ .-][0-9]{3}|0[0-9]+\\)?[ ./-][0-9]",
}
# Gazetteers and context.
KNOWN = {
    "email": r"(?i)(?:\.|dot\x20?\]?)\x20?(?:com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|us)$",
    "ip": r"^(?:0|10|127|169\.254|172\.(?:1[6-9]|2[0-9]|3[01])|192\.168|22[4-9]|2[3-5][0-9])\.",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6011|6[45]|35)",
    "phone": r"^(?:\+|\(|0)",
}
# Words before personal data, in English, French, German and Spanish.
CUES = {
    "email": r"(?i)(?:e-?mail|contact|write\x20to|mailto|reach|courriel|[eé]crire|adresse|schreib|kontakt|correo|escrib)[^.\n]{0,24}$",
    "ip": r"(?i)(?:\bip\b|address|adresse|host|server|serveur|servidor|login\x20from|direcci[oó]n)[^.\n]{0,24}$",
    "card": r"(?i)(?:card|visa|master|amex|credit|debit|pay|carte|cr[eé]dit|karte|tarjeta)[^.\n]{0,24}$",
    "phone": r"(?i)(?:phone|\bt[eé]l|call|mobile|cell|fax|contact|whatsapp|appel|portable|telefon|handy|\bruf|anruf|kontakt|tel[eé]fono|m[oó]vil|llam)"
    r"[^.\n]{0,24}$",
}
AGAINST = r"(?i)(?:order|invoice|isbn|issn|version|\bv|serial|tracking|ticket|article|\bno\.?|#|token|sha|hash|id)[\x20:=\"]{0,3}$"
GLUED_BEFORE, GLUED_AFTER = r"[A-Za-z0-9_/=.-]$", r"^(?:[A-Za-z0-9_/=]|[.-][0-9A-Za-z])"
SHAPE = {
    "email": r"^\S+$|[\[(]at[\])]|\x20at\x20[A-Za-z0-9-]+(?:\x20dot\x20[A-Za-z0-9-]+)+$",
    "ip": r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$|:",
    "card": r"^[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{0,7}$|^[0-9]{4}([ -]?)[0-9]{6}\2[0-9]{5}$",
    "phone": r"[0-9]{3}[)]?[ .-][0-9]{3}[ .-][0-9]{4}$|^0[1-9](?:[ .-][0-9]{2}){4}$"
    r"|^\(?0[1-9][0-9]{1,3}\)?[ /-][0-9]{5,8}$|^[6-9][0-9]{2}(?: [0-9]{3}){2}$",
}
LABELERS = ("pattern", "gazetteer", "context", "against", "apart", "shape")
LENGTHS = 4
PATTERN_TRUST, OTHER_TRUST = 50.0, 3.0


def personal_spans(
    df: DataFrame, text: str = "text", carry: list[str] | None = None, threshold: float = 0.8
) -> DataFrame:
    """Every row of ``df`` with ``n_<kind>`` for each of ``KINDS``, ``base`` and ``spans``.

    ``base`` and ``spans`` are arrays of ``(start, kind, end)`` by start and kind,
    in code points, ``kind`` a place in ``KINDS``. ``base`` holds the matches of the
    exact patterns that pass their check; ``n_<kind>`` counts them. ``spans`` adds
    candidates that overlap none of these and whose probability is above
    ``threshold``. NULL counts as empty; a text without candidates has empty
    arrays. ``carry`` names the input columns to return (all by default); a result
    replaces an input column of its name. Repeated rows are judged alike, texts of
    any length whole and in time linear in them; an empty table gives no rows.
    """
    names = df.columns if carry is None else carry
    found = staged(_candidates(df.select(whole_row(df, names).alias("row"), F.col(text).alias("text"))), "pii-candidates")
    weights = train(vote_counts(found))
    base = F.filter("found", lambda s: s["valid"])
    kinds = F.transform(base, lambda s: s["kind"])
    results = {f"n_{kind}": F.size(F.filter(kinds, _equals(k))).cast("long") for k, kind in enumerate(KINDS)}

    def added(span: Column) -> Column:
        apart = ~F.exists("found", lambda b: b["valid"] & (b["start"] < span["end"]) & (span["start"] < b["end"]))
        return ~span["valid"] & apart & (_score(span, weights) > log(threshold / (1 - threshold)))

    plain = lambda spans: F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    results["base"] = plain(base)
    results["spans"] = F.sort_array(F.array_distinct(F.concat(plain(base), plain(F.filter("found", added)))))
    return with_results(found, names, results)


def _equals(value: int) -> Callable[[Column], Column]:
    return lambda x: x == value


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def vote_counts(found: DataFrame) -> list[tuple[tuple[int, ...], int]]:
    """How often each kind, length class and pattern of votes occurs over all documents.

    At most kinds x length classes x 3 ** labelers rows, whatever the input.
    """
    spans = found.select(F.explode("found").alias("s")).select("s.kind", "s.size", *[f"s.{v}" for v in LABELERS])
    rows = spans.groupBy(*spans.columns).count().collect()
    return sorted((tuple(row[:-1]), row["count"]) for row in rows)


def train(counts: list[tuple[tuple[int, ...], int]], rounds: int = 60) -> list[list[float]]:
    """Weights of the span classifier for each kind: intercept, votes for and against, length classes."""
    weights = []
    for kind in range(len(KINDS)):
        own = [(pattern[1], pattern[2:], n) for pattern, n in counts if pattern[0] == kind]
        weights.append(_fit([(_features(size, votes), p, n) for (size, votes, n), p in zip(own, _reliability(own, rounds), strict=True)]))
    return weights


def _reliability(own: list[tuple[int, tuple[int, ...], int]], rounds: int) -> list[float]:
    """Probability of each vote pattern to be personal data, by expectation-maximisation.

    Labelers vote independently given the truth. Counts are smoothed by votes that
    are right more often than wrong, so no labeler flips; the exact pattern with
    its check digits is trusted most.
    """
    truth = [1 / (1 + exp(-1.5 * sum(votes))) for _, votes, _ in own]
    for _ in range(rounds if own else 0):
        share = (1 + sum(p * n for p, (_, _, n) in zip(truth, own, strict=True))) / (2 + sum(n for *_, n in own))
        odds = [log(share / (1 - share))] * len(own)
        for labeler in range(len(LABELERS)):
            right = PATTERN_TRUST if LABELERS[labeler] == "pattern" else OTHER_TRUST
            table = {(v, y): right if v == 2 * y - 1 else 1.0 for v in (-1, 0, 1) for y in (0, 1)}
            for p, (_, votes, n) in zip(truth, own, strict=True):
                table[votes[labeler], 1] += p * n
                table[votes[labeler], 0] += (1 - p) * n
            total = [sum(table[v, y] for v in (-1, 0, 1)) for y in (0, 1)]
            for at, (_, votes, _) in enumerate(own):
                v = votes[labeler]
                if v:  # an abstention says nothing
                    odds[at] += log(table[v, 1] / total[1]) - log(table[v, 0] / total[0])
        truth = [1 / (1 + exp(-max(-30.0, min(30.0, o)))) for o in odds]
    return truth


def _features(size: int, votes: tuple[int, ...]) -> list[float]:
    return [1.0, *[float(v == s) for v in votes for s in (1, -1)], *[float(size == k) for k in range(LENGTHS)]]


def _fit(rows: list[tuple[list[float], float, int]], steps: int = 400, ridge: float = 0.01) -> list[float]:
    """Logistic regression on probabilities as targets, by gradient steps of momentum; rows count by log frequency."""
    width = 1 + 2 * len(LABELERS) + LENGTHS
    weight, speed = [0.0] * width, [0.0] * width
    total = sum(log(1 + n) for *_, n in rows) or 1.0
    for _ in range(steps):
        slope = [ridge * w for w in weight]
        for x, p, n in rows:
            z = sum(w * f for w, f in zip(weight, x, strict=True))
            miss = (1 / (1 + exp(-max(-30.0, min(30.0, z)))) - p) * log(1 + n) / total
            for at, f in enumerate(x):
                if f:
                    slope[at] += miss * f
        speed = [0.9 * s - 0.5 * g for s, g in zip(speed, slope, strict=True)]
        weight = [w + s for w, s in zip(weight, speed, strict=True)]
    return weight


def _score(span: Column, weights: list[list[float]]) -> Column:
    """Log odds of a candidate by the weights of its kind."""
    score = F.lit(-30.0)
    for kind, weight in enumerate(weights):
        own = F.lit(weight[0])
        for at, labeler in enumerate(LABELERS):
            own += F.when(span[labeler] == 1, weight[1 + 2 * at]).when(span[labeler] == -1, weight[2 + 2 * at]).otherwise(0.0)
        for size in range(LENGTHS):
            own += F.when(span["size"] == size, weight[1 + 2 * len(LABELERS) + size]).otherwise(0.0)
        score = F.when(span["kind"] == kind, own).otherwise(score)
    return score


def _candidates(rows: DataFrame) -> DataFrame:
    """``row`` and ``found``: all candidates of a text with their votes."""
    columns = []
    for exact, patterns in ((True, EXACT), (False, LOOSE)):
        for kind, pattern in patterns.items():
            name = f"{kind}_{'exact' if exact else 'loose'}"
            columns.append(name)
            rows = _matches(rows, name, pattern, HINT[kind, exact], kind, exact)
    return rows.select("row", F.concat(*columns).alias("found"))


def _matches(rows: DataFrame, name: str, pattern: str, hint: str, kind: str, exact: bool) -> DataFrame:
    """Add the array of candidates of one pattern.

    What lies between the matches gives their places: its pieces and the matches
    in turn add up to the text.
    """
    hit = F.col("text").rlike(hint)
    parts = F.struct(
        F.when(hit, F.split("text", pattern, -1)).alias("pieces"),
        F.when(hit, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("matches"),
    )
    rows = rows.withColumn("part", F.explode(F.array(parts)))
    cut = F.transform(
        F.col("part.matches"),
        lambda m, k: F.struct(
            F.length(F.get("part.pieces", k)).alias("gap"),
            F.length(m).alias("long"),
            m.alias("m"),
            F.right(F.get("part.pieces", k), F.lit(48)).alias("before"),
            F.left(F.get("part.pieces", k + 1), F.lit(8)).alias("after"),
        ),
    )
    rows = rows.withColumn("cut", F.explode(F.array(F.coalesce(cut, F.array().cast("array<struct<gap:int,long:int,m:string,before:string,after:string>>")))))
    none = F.array().cast("array<struct<kind:int,start:int,end:int,m:string,before:string,after:string>>")

    def step(so_far: Column, x: Column) -> Column:
        start = so_far["at"] + x["gap"]
        end = start + x["long"]
        span = F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), end.alias("end"), x["m"], x["before"], x["after"]
        )
        kept = F.when(_worth(kind, exact)(x["m"]), F.concat(so_far["out"], F.array(span))).otherwise(so_far["out"])
        return F.struct(end.alias("at"), kept.alias("out"))

    placed = F.aggregate("cut", F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda x: x["out"])
    rows = rows.withColumn("placed", F.explode(F.array(placed)))
    voted = F.transform("placed", lambda s: _voted(s, kind, exact))
    return rows.withColumn(name, F.explode(F.array(voted))).drop("part", "cut", "placed")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _worth(kind: str, exact: bool) -> Callable[[Column], Column]:
    """Whether a match is a candidate at all; all that can be valid are."""
    if exact and kind == "card":
        return lambda m: F.length(_digits(m)).between(12, 19)
    if exact and kind == "phone":
        return lambda m: F.length(_digits(m)).between(7, 15)
    if kind == "phone":
        return lambda m: F.length(_digits(m)).between(9, 15) & ~m.rlike(DATE)
    if not exact and kind == "ip":
        return lambda m: m.rlike("[0-9A-Fa-f]")
    return lambda m: F.lit(True)


def _valid(match: Column, kind: str) -> Column:
    digits = _digits(match)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        stripped = F.transform(F.split(match, r"\."), lambda part: F.regexp_replace(part, "^0+", ""))
        return F.forall(stripped, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        # Doubling every second digit from the right; two digits of a double add up to it less nine.
        values = F.transform(
            F.split(F.reverse(digits), ""),
            lambda d, k: F.ascii(d) * (1 + k % 2) - 48 * (1 + k % 2) - F.when((k % 2 == 1) & (d >= "5"), 9).otherwise(0),
        )
        total = F.aggregate(values, F.lit(0), lambda a, b: a + b)
        return F.length(digits).between(12, 19) & (total % 10 == 0)
    return F.length(digits).between(9, 15)


def _voted(span: Column, kind: str, exact: bool) -> Column:
    match, before, after = span["m"], span["before"], F.coalesce(span["after"], F.lit(""))
    valid = _valid(match, kind) if exact else F.lit(False)
    vote = lambda good, bad: F.when(good, 1).when(bad, -1).otherwise(0)
    never = F.lit(False)
    normal = _digits(match) if kind == "card" else match
    known = normal.rlike(KNOWN[kind])
    glued = before.rlike(GLUED_BEFORE) | after.rlike(GLUED_AFTER)
    return F.struct(
        span["kind"],
        span["start"],
        span["end"],
        valid.alias("valid"),
        F.least(F.floor(F.length(match) / 8), F.lit(LENGTHS - 1)).cast("int").alias("size"),
        (vote(valid, ~valid) if exact else F.lit(0)).alias("pattern"),
        # What is listed speaks for phone numbers and against addresses; the rest is no evidence there.
        {"ip": vote(never, known), "phone": vote(known, never)}.get(kind, vote(known, ~known)).alias("gazetteer"),
        vote(before.rlike(CUES[kind]), never).alias("context"),
        vote(never, before.rlike(AGAINST)).alias("against"),
        vote(never, glued).alias("apart"),
        vote(match.rlike(SHAPE[kind]), ~match.rlike(SHAPE[kind])).alias("shape"),
    )
