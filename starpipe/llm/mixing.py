"""Mixing domains to target weights with soft membership, in built-in functions only.

1. A naive Bayes classifier over the presence of words is fitted on a bounded sample of labelled
   documents: word counts by domain are one aggregate, and all words that mark a domain become the
   model, a table of buckets by the word's hash. The leading domain and its lead over the next
   one put a text into one of few bins, and the labels in a bin give the bin's posterior, so that
   probabilities mean shares and texts without any such word are a bin of their own.
2. Every document gets a posterior for each domain and its number of tokens, row by row.
3. Tokens are added up by bin, and rates r >= 0, at most ``max_rate``, are solved for on that table, so
   that the expected tokens of each domain, the sum of rate * tokens * posterior, have the target
   shares. A domain that is short is repeated as far as ``max_rate`` lets it, and beyond that the total
   is brought down.
4. A document's rate becomes a whole number of copies by rounding with a draw from its doc_id.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starpipe.llm.common import cut, unused

#: Labelled documents that the classifier is fitted on: those with the smallest hashes.
SAMPLE = 20_000
#: A word counts if so large a part of a domain's labelled documents, and so many, have it, if that
#: part is so many times the part elsewhere, and if the two differ by so many standard errors.
LEAST_SHARE = 0.02
LEAST_DOCS = 10
LEAST_LIFT = 4.0
LEAST_Z = 6.0
#: Bins of a leading domain begin at these leads in log odds.
LEADS = (0.0, 3.0, 8.0)
BUCKETS = "array<array<struct<word: string, weight: array<double>>>>"
#: Words start and end at these.
BETWEEN = r"[\s,.;:!?]+"
#: Largest miss of a share.
CLOSE = 1e-4
#: Weight of the wish for equal rates against that for the shares, and in how many steps it falls from 1.
PULL = 1e-10
PULLS = 11
#: Largest slope at an optimum.
EXACT = 1e-6
#: Of the gradient steps in the pipeline's test; nothing here takes steps.
STEPS = 60
LEAST_SCALE = 0.05
#: Documents are not repeated.
MAX_RATE = 1.0

#: Weights of the registered query and the pipeline: tokens of good documents stay, toxic and low
#: ones are brought down to what the weights leave them.
TARGETS: Mapping[str, float] = {"good": 0.945, "low": 0.045, "toxic": 0.01}
ANCHOR = "good"


def domain_of_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of a table doc_id, quality, toxic: a toxic label outweighs a low one."""
    return labels.select(
        F.col("doc_id").cast("long"),
        F.when(F.col("toxic") == 1, "toxic")
        .when(F.col("quality") == 0, "low")
        .when((F.col("quality") == 1) & (F.col("toxic") == 0), "good")
        .alias("domain"),
    )


class Classifier:
    """The log share of each word in each domain, and the posterior of each bin."""

    def __init__(
        self, domains: Sequence[str], words: list[str], weight: np.ndarray, hashes: Sequence[int] = ()
    ):
        """``hashes`` are xxhash64 of the words."""
        self.domains, self.words, self.weight = list(domains), words, weight
        self.buckets: list[list[dict]] = [[] for _ in range(2 * len(words))]
        for word, row, number in zip(words, weight.tolist(), hashes, strict=True):
            self.buckets[number % len(self.buckets)].append({"word": word, "weight": row})
        self.bins = len(self.domains) * len(LEADS) + 1
        self.posterior = np.tile(np.eye(len(self.domains))[0], (self.bins, 1))

    def bin_of(self, words: Column) -> Column:
        """0 without a known word, else by leading domain and lead; for an array of words."""
        if not self.words:
            return F.lit(0)
        # One constant, whatever the number of words; a word is compared with those of its bucket only.
        table = F.from_json(F.lit(json.dumps(self.buckets)), BUCKETS)

        def found(word: Column) -> Column:
            bucket = F.get(table, F.pmod(F.xxhash64(word), F.lit(len(self.buckets))).cast("int"))
            return F.filter(bucket, lambda entry: entry["word"] == word)

        at = F.flatten(F.transform(F.array_distinct(words), found))

        def added(d: int) -> Callable[[Column, Column], Column]:
            return lambda total, entry: total + F.get(entry["weight"], F.lit(d))

        def scored(at: Column) -> Column:
            scores = [F.aggregate(at, F.lit(0.0), added(d)) for d in range(len(self.domains))]
            return F.struct(F.array(*scores).alias("scores"), at.alias("at"))

        def numbered(of: Column) -> Column:
            first = F.array_position(of["scores"], F.array_max(of["scores"])).cast("int") - 1
            ordered = F.sort_array(of["scores"], asc=False)
            lead = F.get(ordered, F.lit(0)) - F.coalesce(F.get(ordered, F.lit(1)), F.lit(-math.inf))
            step = reduce(lambda a, b: a + b, [(lead >= x).cast("int") for x in LEADS])
            return F.when(F.size(of["at"]) > 0, first * len(LEADS) + step).otherwise(0)

        # Lists of one, so that words and scores are found once for all their uses.
        return F.transform(F.transform(F.array(at), scored), numbered)[0]

    def calibrate(self, seen: np.ndarray) -> None:
        """``seen`` has labelled texts by bin and domain; rare bins lean on the overall shares."""
        overall = (seen.sum(axis=0) + 0.5) / (seen.sum() + 0.5 * seen.shape[1])
        self.posterior = (seen + overall) / (seen.sum(axis=1, keepdims=True) + 1)

    def posteriors(self, words: Column) -> Column:
        table = F.array(*[F.array(*[F.lit(float(p)) for p in row]) for row in self.posterior])
        return F.get(table, self.bin_of(words))


def words_of(text: Column) -> Column:
    """Null and empty texts have no words."""
    parts = F.split(F.coalesce(text, F.lit("")), BETWEEN, -1)
    return F.filter(parts, lambda word: word != "")


def fit(
    docs: DataFrame,
    labelled: DataFrame,
    domains: Sequence[str],
    text: str = "text",
    sample: int = SAMPLE,
) -> Classifier:
    """The classifier from the (doc_id, domain) rows whose domain is one of ``domains``.

    A doc_id with several labels counts for the domain that ``domains`` names last. Without any
    labelled document everything belongs to the first domain.
    """
    rank = F.array_position(F.array(*map(F.lit, domains)), F.col("domain"))
    chosen = (
        labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isin(*domains))
        .groupBy(F.col("doc_id").alias("__id"))
        .agg((F.max(rank) - 1).cast("int").alias("__domain"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(sample)
    )
    # At most ``sample`` rows of two numbers, whatever the corpus.
    given = docs.select("doc_id", F.col(f"`{text}`").cast("string").alias("text"))
    texts = given.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select(
        "__domain", F.array_distinct(words_of(F.col("text"))).alias("words")
    )
    texts = cut(texts, "labelled")
    sizes = np.zeros(len(domains))
    for row in texts.groupBy("__domain").count().collect():
        sizes[row["__domain"]] = row["count"]
    if not sizes.sum():
        return Classifier(domains, [], np.zeros((0, len(domains))))
    each = [F.count_if(F.col("__domain") == d).alias(f"n{d}") for d in range(len(domains))]
    counts = texts.select("__domain", F.explode("words").alias("word")).groupBy("word").agg(*each)
    everyone = sizes.sum()
    total = reduce(lambda a, b: a + b, [F.col(f"n{d}") for d in range(len(domains))])
    marks = []
    for d, size in enumerate(sizes):
        if 0 < size < everyone:
            share = total / F.lit(everyone)
            error = F.sqrt(share * (1 - share) * (1 / size + 1 / (everyone - size)))
            own = F.col(f"n{d}") / F.lit(size)
            rest = (total - F.col(f"n{d}")) / F.lit(everyone - size)
            marked = (
                (error > 0)
                & (F.col(f"n{d}") >= LEAST_DOCS)
                & (own >= LEAST_SHARE)
                & (own >= LEAST_LIFT * rest)
            )
            marks.append(F.when(marked, (own - rest) / error).otherwise(0.0))
    strongest = F.greatest(F.lit(0.0), F.lit(0.0), *marks)
    best = (
        counts.withColumn("z", strongest)
        .where(F.col("z") >= LEAST_Z)
        .orderBy(F.desc("z"), "word")
        .withColumn("hash", F.xxhash64("word"))
        .collect()
    )
    seen = np.array([[row[f"n{d}"] for d in range(len(domains))] for row in best], dtype=float)
    seen = seen.reshape(len(best), len(domains))
    # A domain of few documents leans on the share of the word in all of them.
    overall = seen.sum(axis=1, keepdims=True) / everyone
    present = (seen + 2 * overall) / (sizes + 2)
    hashes = [row["hash"] for row in best]
    model = Classifier(domains, [row["word"] for row in best], np.log(present), hashes)
    binned = texts.groupBy(model.bin_of(F.col("words")).alias("bin"), "__domain").count()
    table = np.zeros((model.bins, len(domains)))
    for row in binned.collect():
        table[row["bin"], row["__domain"]] = row["count"]
    model.calibrate(table)
    return model


def classify(
    docs: DataFrame, model: Classifier, text: str, carry: Sequence[str], into: str
) -> DataFrame:
    """The ``carry`` columns and a struct ``into`` of tokens and posterior."""
    words = words_of(F.col(f"`{text}`").cast("string"))
    rows = docs.select(*[F.col(f"`{c}`") for c in carry], words.alias(into))
    return rows.withColumn(
        into,
        F.struct(
            F.size(into).cast("long").alias("tokens"), model.posteriors(F.col(into)).alias("posterior")
        ),
    )


def fit_rates(
    scored: DataFrame, weights: np.ndarray, anchor: int, into: str, max_rate: float = MAX_RATE
) -> Column:
    """The rate of each row as a column over its posterior.

    Tokens are added up by distinct posterior, of which a model has no more than bins.
    """
    tokens, posterior = F.col(into)["tokens"], F.col(into)["posterior"]
    rows = scored.groupBy(posterior.alias("p")).agg(F.sum(tokens).alias("n")).collect()
    rows = sorted((list(row["p"]), float(row["n"] or 0)) for row in rows)
    if not sum(n for _, n in rows):
        return F.lit(1.0)
    p, n = np.array([p for p, _ in rows]), np.array([n for _, n in rows])
    rates = solve_rates(p, n, weights, anchor, max_rate)
    known = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in p])
    values = F.array(*[F.lit(float(rate)) for rate in rates])
    return F.get(values, F.array_position(known, posterior).cast("int") - 1)


def nearest_shares(p: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of all mixtures of the rows of ``p``, the one nearest to ``weights``: the nearest point of a
    polytope, by Wolfe's method."""
    points = p - weights
    chosen = [int((points**2).sum(axis=1).argmin())]
    part = np.ones(1)
    for _ in range(100 * len(p) + 100):
        at = part @ points[chosen]
        new = int((points @ at).argmin())
        if new in chosen or points[new] @ at >= at @ at - 1e-15:
            break
        chosen.append(new)
        part = np.append(part, 0.0)
        while True:
            # The nearest point of the flat through the chosen ones.
            size = len(chosen)
            system = np.ones((size + 1, size + 1))
            system[:size, :size] = points[chosen] @ points[chosen].T
            system[size, size] = 0
            flat = np.linalg.lstsq(system, np.append(np.zeros(size), 1.0), rcond=None)[0][:size]
            if flat.min() > 1e-12:
                part = flat
                break
            out = flat <= 1e-12
            reach = min(1.0, (part[out] / np.maximum(part[out] - flat[out], 1e-300)).min())
            part = part + reach * (flat - part)
            left = part > 1e-12
            chosen = [i for i, stays in zip(chosen, left) if stays]
            part = part[left] / part[left].sum()
    return weights + part @ points[chosen]


def nearest_rates(
    p: np.ndarray, n: np.ndarray, goal: np.ndarray, total: float, max_rate: float
) -> np.ndarray:
    """Rates in [0, max_rate] whose shares of ``total`` come nearest to ``goal``, and of these the ones
    nearest to each other.

    By Newton steps on the dual, one number per domain, until its gradient vanishes; the wish for
    equal rates is strong at first, so that each optimum is near the one before.
    """
    amount, even = n / total, total / n.sum()
    x, pulls = np.zeros(len(goal)), np.geomspace(1, PULL, PULLS)

    def gradient(x: np.ndarray, pull: float) -> tuple[np.ndarray, np.ndarray]:
        rate = np.clip(even - p @ x, 0, max_rate)
        return pull * x + goal - (amount * rate) @ p, rate

    for pull in pulls * n.sum() / total:
        slope, rate = gradient(x, pull)
        for _ in range(200):
            if np.abs(slope).max() <= EXACT:
                break
            inside = (rate > 0) & (rate < max_rate)
            hesse = pull * np.eye(len(x)) + (p[inside].T * amount[inside]) @ p[inside]
            move = -np.linalg.solve(hesse, slope)
            length = 1.0
            new = gradient(x + move, pull)
            # Convex: past the least point along the move, the slope turns.
            while new[0] @ move > -0.5 * (slope @ move) and length > 1e-18:
                length /= 2
                new = gradient(x + length * move, pull)
            x = x + length * move
            slope, rate = new
    if np.abs(slope).max() > EXACT:
        raise ArithmeticError(f"rates for {goal.tolist()} of {total} tokens are not at their optimum")
    return rate


def solve_rates(
    p: np.ndarray, n: np.ndarray, weights: np.ndarray, anchor: int, max_rate: float
) -> np.ndarray:
    """Rates of groups with posteriors ``p`` and ``n`` tokens, so that the expected tokens of the
    domains have the shares ``weights``.

    Where no rates give these shares, since every group is a mixture of domains, the nearest ones that
    some rates give take their place. The total is the one at which the anchor keeps its tokens, or
    the largest at which no rate exceeds ``max_rate``. Among the rates that fit, those nearest to
    each other are taken. Groups without tokens keep rate 1.
    """
    full = n > 0
    rates = np.ones(len(n))
    p, n = p[full], n[full]
    goal = nearest_shares(p, weights)
    have = n @ p
    total = have[anchor] / goal[anchor] if goal[anchor] > 0 else n.sum()
    total = min(total, max_rate * n.sum())

    def missed(total: float) -> float:
        found = nearest_rates(p, n, goal, total, max_rate)
        return np.abs((found * n) @ p / total - goal).max()

    if missed(total) > CLOSE:
        low, high = 0.0, total
        while high - low > 1e-6 * high:
            middle = (low + high) / 2
            low, high = (low, middle) if missed(middle) > CLOSE else (middle, high)
        total = low or high
    rates[full] = nearest_rates(p, n, goal, total, max_rate)
    return rates


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: Mapping[str, float] = TARGETS,
    anchor: str = ANCHOR,
    text: str = "text",
    carry: Sequence[str] | None = None,
    max_rate: float = MAX_RATE,
    into: str = "__mix",
) -> DataFrame:
    """The ``carry`` columns (all, if None) and a struct ``into`` with tokens, posterior (in the
    order of ``targets``), rate and copies; a row for each row of ``docs``.

    ``labelled`` has (doc_id, domain); rows with nulls or unknown domains are ignored. Null and
    empty texts have no tokens and the posterior of a text without any known word. Rows that
    repeat a doc_id have one draw, and so, with equal texts, as many copies. A null doc_id is drawn
    like a value. Columns are carried whatever their names; only ``into`` is replaced. An empty table
    gives an empty result.
    """
    domains = list(targets)
    weights = np.array([targets[d] for d in domains], dtype=float)
    weights = weights / math.fsum(weights)
    carry = [c for c in (docs.columns if carry is None else carry) if c != into]
    model = fit(docs, labelled, domains, text)
    # The draw depends on the doc_id alone.
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("mix")), F.lit(1 << 53)) / F.lit(float(1 << 53))
    draw_name, rate_name = unused(docs, "__draw"), unused(docs, "__rate")
    scored = classify(docs.withColumn(draw_name, draw), model, text, [*carry, draw_name], into)
    scored = cut(scored, "mixing")
    rate = fit_rates(scored, weights, domains.index(anchor), into, max_rate)
    found = F.col(rate_name)
    copies = F.floor(found + F.col(draw_name))
    result = F.col(into).withField("rate", found).withField("copies", copies.cast("long"))
    return scored.withColumn(rate_name, rate).withColumn(into, result).drop(rate_name, draw_name)


def copies_of(mixed: DataFrame, into: str = "__mix") -> DataFrame:
    """Each row as often as its copies say, without ``into``."""
    kept = mixed.where(F.col(into)["copies"] > 0)
    many = F.sequence(F.lit(1).cast("long"), F.col(into)["copies"])
    return kept.withColumn(into, F.explode(many)).drop(into)
