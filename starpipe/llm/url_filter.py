"""URL filters: host and path rules, and a weighted vocabulary searched in one pass per url.

Rules name a host and the beginning of a path (``example.net/en/``). A rule fits its host and all
subdomains; of several the longest wins and settles the verdict. Urls without a rule are judged by
their words: one automaton finds all terms of the vocabulary, terms inside a longer word do not
count, and the url is blocked when the weights of the distinct terms reach the threshold. A strict
term weighs the threshold by itself; soft ones must come together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starpipe.llm.common import UPPER, lower_ascii

BLOCK, ALLOW = "block", "allow"
THRESHOLD = 2

#: Fixed values of the production rules.
RULES: Mapping[str, str] = {
    "net/": BLOCK,
    "example.net/en/": ALLOW,
    "example.com/de/": BLOCK,
    "org/fr/": ALLOW,
}

#: Words that settle a verdict alone, and words of which two different ones do.
STRICT = ("adult", "casino", "escort", "hentai", "malware", "phishing", "porn", "spam", "viagra",
          "warez", "xxx")
SOFT = ("bet", "bets", "bonus", "cheap", "dating", "download", "farm", "free", "gambling", "jackpot",
        "lottery", "nude", "pills", "poker", "sex", "slots", "torrent", "win")
VOCABULARY: Mapping[str, int] = {**dict.fromkeys(STRICT, THRESHOLD), **dict.fromkeys(SOFT, 1)}

_LOWER = str.maketrans(UPPER, UPPER.lower())


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(F.coalesce(host, F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules: Iterable[str]) -> Column:
    """The longest rule that fits, else null; of equally long ones the longer host's."""

    def fits(rule: str) -> Column:
        at, slash, start = rule.partition("/")
        own_host = (host == at) | host.endswith("." + at)
        return own_host & path.startswith(slash + start)

    ordered = sorted(rules, key=lambda rule: (-len(rule), -rule.find("/"), rule))
    if not ordered:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(fits(rule), F.lit(rule)) for rule in ordered])


class Vocabulary:
    """Counts the terms in texts; built once in each task."""

    def __init__(self, terms: Mapping[str, int]):
        import ahocorasick

        self.automaton = None
        if terms:
            self.automaton = ahocorasick.Automaton()
            for term, weight in terms.items():
                self.automaton.add_word(term, (term, weight))
            self.automaton.make_automaton()

    def weight(self, text: str | None) -> int:
        """Of the distinct terms that stand between characters other than letters and digits."""
        if not text or self.automaton is None:
            return 0
        text = text.translate(_LOWER)
        found: dict[str, int] = {}
        for end, (term, weight) in self.automaton.iter(text):
            before = end - len(term)
            if (before < 0 or not _inside(text[before])) and (
                end + 1 == len(text) or not _inside(text[end + 1])
            ):
                found[term] = weight
        return sum(found.values())


def _inside(character: str) -> bool:
    return character.isascii() and character.isalnum()


def judge_urls(
    pages: DataFrame,
    url: str = "url",
    rules: Mapping[str, str] = RULES,
    vocabulary: Mapping[str, int] = VOCABULARY,
    threshold: int = THRESHOLD,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """The ``carry`` columns (all, if None), then host, path, rule, term_weight, verdict.

    Null urls and urls without ``://`` have an empty host and path; no rule fits them, and their
    whole text is searched (nothing, if null). Columns that are carried and named like a result
    are replaced by it. One row for each row; an empty table gives an empty result. Rules and
    vocabulary are parameters held by every task, so they must fit there.
    """

    def weights(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = Vocabulary(vocabulary)
        for urls in batches:
            yield pd.Series([words.weight(x) for x in urls], dtype="int64")

    text = F.col(f"`{url}`").cast("string")
    host, path = host_of(text), path_of(text)
    weighed = {
        "host": host,
        "path": path,
        "rule": rule_for(host, path, rules),
        "term_weight": F.pandas_udf(weights, "long")(text),
    }
    names = {*weighed, "verdict"}
    carry = [c for c in (pages.columns if carry is None else carry) if c.lower() not in names]
    by_words = F.when(F.col("term_weight") >= threshold, BLOCK).otherwise(ALLOW)
    by_rule = [F.when(F.col("rule") == rule, verdict) for rule, verdict in rules.items()]
    return pages.select(
        *[F.col(f"`{c}`") for c in carry], *[column.alias(name) for name, column in weighed.items()]
    ).withColumn("verdict", F.coalesce(*by_rule, by_words))

