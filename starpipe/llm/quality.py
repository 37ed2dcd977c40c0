"""Quality by weak supervision: rules vote or abstain, a label model weighs them.

1. One pass over the texts counts what the rules look at.
2. Each rule votes for (1) or against (-1) a document, or abstains (0).
3. Documents are counted by vote pattern, at most 3 ** len(RULES) rows whatever the corpus, and
   expectation-maximisation over that table estimates, without labels, the share of good documents
   and how often each rule votes against, abstains and votes for good and bad ones, so that a rule
   that only ever votes against weighs what its votes say.
4. A document's posterior is a sum of log odds of its outcomes, a plain column expression.

Documents that fail the base test (too few words, too many repeated ones) are rejected whatever
the posterior.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starpipe.llm.common import cut

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
GRAM = 5
THRESHOLD = 0.5

COUNTS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_upper long, n_ends long, n_plain long, n_distinct long, n_echo long"
)
_NAMES = [field.split()[0] for field in COUNTS.split(", ")]
_ENDS = (b".", b"!", b"?")
_MARKS = frozenset(b".,;:!?"[i : i + 1] for i in range(6))
_UPPER = bytes(range(ord("A"), ord("Z") + 1))


def count_text(text: str) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS."""
    data = text.encode("utf-8", "surrogatepass")
    # Without an argument, bytes.split() cuts at exactly the six characters in SPACES.
    words = data.split()
    if not words:
        return (0,) * len(_NAMES)
    number: dict[bytes, int] = {}
    ids = [number.setdefault(word, len(number)) for word in words]
    lines = [line for line in data.split(b"\n") if line.strip()]
    times = np.bincount(ids)
    ends = np.fromiter((word.endswith(_ENDS) for word in number), bool, len(number))
    plain = np.fromiter(map(_is_plain, number), bool, len(number))
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated(ids, GRAM),
        len(lines),
        len(data) - len(data.translate(None, _UPPER)),
        int(times @ ends),
        int(times @ plain),
        len(number),
        sum(map(int.__eq__, ids, ids[1:])),
    )


def _is_plain(word: bytes) -> bool:
    """Letters, with one mark at most behind them."""
    if word[-1:] in _MARKS:
        word = word[:-1]
    return word.decode("utf-8", "replace").isalpha()


def repeated(ids: Sequence[int], gram: int) -> int:
    """Positions inside windows of ``gram`` ids that occur at least twice."""
    if len(ids) <= gram:
        return 0
    windows = list(zip(*(ids[k:] for k in range(gram))))
    if len(set(windows)) == len(windows):
        return 0
    times: dict[tuple, int] = {}
    for window in windows:
        times[window] = times.get(window, 0) + 1
    covered, upto = 0, 0
    for start, window in enumerate(windows):
        if times[window] > 1:
            covered += start + gram - max(start, upto)
            upto = start + gram
    return covered


def _counts(texts: pd.Series) -> pd.DataFrame:
    rows = [count_text(text) if text else (0,) * len(_NAMES) for text in texts]
    return pd.DataFrame(rows, columns=_NAMES, dtype="int64")


@dataclass(frozen=True)
class Rule:
    """``bad`` and ``good`` are conditions on the struct of counts; neither: the rule abstains."""

    name: str
    bad: Callable[[Column], Column]
    good: Callable[[Column], Column]


#: Written without division, so that empty texts need no special case.
RULES = (
    Rule("length", lambda q: q["n_words"] < 5, lambda q: q["n_words"] >= 40),
    Rule(
        "word_length",
        lambda q: ~q["word_chars"].between(2 * q["n_words"], 12 * q["n_words"]),
        lambda q: q["word_chars"].between(3 * q["n_words"], 8 * q["n_words"]),
    ),
    Rule(
        "symbols",
        lambda q: 10 * q["n_symbols"] > q["n_words"],
        lambda q: 100 * q["n_symbols"] <= q["n_words"],
    ),
    Rule(
        "plain_words",
        lambda q: 10 * q["n_plain"] < 7 * q["n_words"],
        lambda q: 10 * q["n_plain"] > 9 * q["n_words"],
    ),
    Rule(
        "sentences",
        lambda q: ((q["n_words"] >= 40) & (100 * q["n_ends"] < 3 * q["n_words"]))
        | (10 * q["n_ends"] > 6 * q["n_words"]),
        lambda q: (100 * q["n_ends"]).between(4 * q["n_words"], 40 * q["n_words"]),
    ),
    Rule("case", lambda q: 10 * q["n_upper"] > 4 * q["word_chars"], lambda q: F.lit(False)),
    Rule("lines", lambda q: 10 * q["n_dup_lines"] > 6 * q["n_lines"], lambda q: F.lit(False)),
    Rule("repeats", lambda q: 10 * q["n_repeat_words"] > 4 * q["n_words"], lambda q: F.lit(False)),
    Rule("echo", lambda q: 100 * q["n_echo"] > 15 * q["n_words"], lambda q: F.lit(False)),
    Rule(
        "variety",
        lambda q: (q["n_words"] >= 40) & (q["n_distinct"] * q["n_distinct"] < 4 * q["n_words"]),
        lambda q: F.lit(False),
    ),
)


#: Places of a rule's outcomes in the model's tables.
OUTCOMES = (-1, 0, 1)


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents; of[rule][class][outcome]: how often a rule votes against, abstains and
    votes for a document of the class; 0 bad, 1 good."""

    prior: float
    of: np.ndarray

    @property
    def right(self) -> np.ndarray:
        """[rule][class]: how often a vote is right."""
        bad, good = self.of[:, 0], self.of[:, 1]
        return np.stack([bad[:, 0] / (bad[:, 0] + bad[:, 2]), good[:, 2] / (good[:, 0] + good[:, 2])], 1)

    def log_odds(self) -> tuple[float, list[tuple[float, float]]]:
        """Of a document all rules abstain on, and what each rule's vote against and for adds."""
        odds = np.log(self.of[:, 1] / self.of[:, 0])
        base = math.log(self.prior / (1 - self.prior)) + odds[:, 1].sum()
        votes = odds[:, [0, 2]] - odds[:, 1:2]
        return float(base), [tuple(row) for row in votes.tolist()]


def fit(votes: np.ndarray, counts: np.ndarray, rounds: int = 500) -> LabelModel:
    """Expectation-maximisation over distinct vote patterns, with one pseudo document per cell.

    A vote against is no rarer among bad documents than among good ones, and a vote for no rarer among
    good ones, which tells the good class from the bad one. At first a vote is right four times in
    five and abstaining says nothing.
    """
    seen = np.stack([votes == outcome for outcome in OUTCOMES], axis=2).astype(float)
    first = np.array([[0.8, 1.0, 0.2], [0.2, 1.0, 0.8]])
    prior, of = 0.8, np.tile(first / first.sum(axis=1, keepdims=True), (votes.shape[1], 1, 1))
    for _ in range(rounds):
        score = math.log(prior / (1 - prior)) + np.einsum("pro,ro->p", seen, np.log(of[:, 1] / of[:, 0]))
        good = 1 / (1 + np.exp(-score))
        share = float(np.clip((counts @ good + 1) / (counts.sum() + 2), 0.01, 0.99))
        mass = np.stack([counts * (1 - good), counts * good])
        cells = np.einsum("cp,pro->rco", mass, seen) + 1
        new = _ordered(cells)
        done = abs(share - prior) < 1e-7 and np.abs(new - of).max() < 1e-7
        prior, of = share, new
        if done:
            break
    return LabelModel(prior, of)


def _ordered(cells: np.ndarray) -> np.ndarray:
    """Shares of outcomes; where a vote would speak for the wrong class, its share is that of both."""
    of = cells / cells.sum(axis=2, keepdims=True)
    both = cells.sum(axis=1) / cells.sum(axis=(1, 2))[:, None]
    for outcome, bad_more in ((0, True), (2, False)):
        wrong = (of[:, 0, outcome] < of[:, 1, outcome]) == bad_more
        wrong &= of[:, 0, outcome] != of[:, 1, outcome]
        of[wrong, :, outcome] = both[wrong, None, outcome]
    of[:, :, 1] = np.maximum(1 - of[:, :, 0] - of[:, :, 2], 1e-9)
    return of / of.sum(axis=2, keepdims=True)


def _votes(quality: Column, rules: Sequence[Rule]) -> Column:
    return F.array(
        *[F.when(r.bad(quality), -1).when(r.good(quality), 1).otherwise(0) for r in rules]
    )


def judge(
    docs: DataFrame,
    text: str = "text",
    carry: Sequence[str] | None = None,
    rules: Sequence[Rule] = RULES,
    into: str = "__quality",
) -> DataFrame:
    """The ``carry`` columns (all, if None) and a struct ``into`` with the counts, ``votes``,
    ``base_failed``, ``posterior`` and ``kept``; a row for each row of ``docs``.

    Null and empty texts have no words and fail the base test. Ties at the threshold are kept.
    Repeated rows are judged alike. Extra columns are carried unchanged, whatever their names;
    only one named like ``into`` is replaced. An empty table gives an empty result.
    """
    carry = [c for c in (docs.columns if carry is None else carry) if c != into]
    counted = docs.select(
        *[F.col(f"`{c}`") for c in carry],
        F.pandas_udf(_counts, COUNTS)(F.col(f"`{text}`").cast("string")).alias(into),
    )
    quality = F.col(f"`{into}`")
    voted = cut(
        counted.withColumn(into, quality.withField("votes", _votes(quality, rules))), "quality"
    )
    patterns = voted.groupBy(quality["votes"].alias("votes")).count().collect()
    votes = np.array([row["votes"] for row in patterns]).reshape(-1, len(rules))
    times = np.array([row["count"] for row in patterns], dtype=float)
    return voted.withColumn(into, _verdict(quality, fit(votes, times)))


def _verdict(quality: Column, model: LabelModel) -> Column:
    base, weights = model.log_odds()
    vote = quality["votes"]
    odds = reduce(
        lambda total, jw: total
        + F.when(vote[jw[0]] < 0, jw[1][0]).when(vote[jw[0]] > 0, jw[1][1]).otherwise(0.0),
        enumerate(weights),
        F.lit(base),
    )
    failed = (quality["n_words"] < MIN_WORDS) | (
        100 * quality["n_repeat_words"] > MAX_REPEAT_PERCENT * quality["n_words"]
    )
    posterior = 1 / (1 + F.exp(-odds))
    return (
        quality.withField("base_failed", failed)
        .withField("posterior", posterior)
        .withField("kept", ~failed & (posterior >= THRESHOLD))
    )
