import random
import re

import numpy as np
import pytest

from starpipe.llm.common import WORD, read_table
from starpipe.llm.quality import COUNTS, MAX_REPEAT_PERCENT, MIN_WORDS, count_text, fit, judge

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, n_words string, votes int"


def plain_counts(text):
    words = re.findall(WORD, text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        sum(line in lines[:i] for i, line in enumerate(lines)),
        len(covered),
    )


@pytest.mark.parametrize("seed", range(30))
def test_counts_agree_with_brute_force(seed):
    draw = random.Random(seed)
    pieces = ["a", "b", "ab", "#", "%%%", "é", "\u00a0", " ", "  ", "\n", "\t", "\x1c", "\x85", ".", "x|y"]
    text = "".join(draw.choice(pieces) + draw.choice(["", " ", "\n"]) for _ in range(draw.randint(0, 60)))
    assert count_text(text)[:5] == plain_counts(text)


def test_edge_cases_have_defined_results(make):
    long = "word " * 200_000
    rows = [(1, None, "x", 1), (2, "", "x", 1), (3, " \n ", None, 1), (None, "one two.", "x", None),
            (5, long, "x", 1), (5, long, "x", 1)]
    got = judge(make(rows, SCHEMA)).collect()
    assert len(got) == len(rows) and got[0]["n_words"] is not None
    by_id = {(r["doc_id"], r["text"]): r["__quality"] for r in got}
    for key in ((1, None), (2, ""), (3, " \n ")):
        assert by_id[key]["n_words"] == 0 and by_id[key]["base_failed"] and not by_id[key]["kept"]
    assert by_id[(5, long)]["n_repeat_words"] == 200_000 and by_id[(5, long)]["base_failed"]
    assert judge(make([], SCHEMA)).count() == 0


def test_base_test_and_verdict(spark):
    rows = judge(read_table(spark, SF, "documents"), carry=["doc_id"]).select("doc_id", "__quality.*").collect()
    labels = {r["doc_id"]: r["quality"] for r in read_table(spark, SF, "labels").collect()}
    for r in rows:
        failed = r["n_words"] < MIN_WORDS or 100 * r["n_repeat_words"] > MAX_REPEAT_PERCENT * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    judged = [r for r in rows if r["doc_id"] in labels and not r["base_failed"]]
    good = [r["kept"] for r in judged if labels[r["doc_id"]] == 1]
    bad = [r["kept"] for r in judged if labels[r["doc_id"]] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_label_model_recovers_accuracies():
    draw = np.random.default_rng(1)
    truth = draw.random(20_000) < 0.7
    right = np.array([[0.9, 0.95], [0.8, 0.9], [0.7, 0.85], [0.9, 0.6]])
    votes = []
    for bad, good in right:
        correct = draw.random(len(truth)) < np.where(truth, good, bad)
        vote = np.where(correct == truth, 1, -1)
        votes.append(np.where(draw.random(len(truth)) < 0.8, vote, 0))
    patterns, counts = np.unique(np.stack(votes, axis=1), axis=0, return_counts=True)
    model = fit(patterns, counts.astype(float))
    assert abs(model.prior - 0.7) < 0.03
    assert np.abs(model.right - right).max() < 0.06


def test_counts_are_the_declared_columns():
    assert len(count_text("some words")) == len(COUNTS.split(", "))


@pytest.mark.parametrize("rule", range(3))
def test_a_rule_that_only_votes_against_moves_the_verdict(rule):
    draw = np.random.default_rng(7)
    bad = draw.random(50_000) < 0.2
    votes = []
    for _ in range(5):
        vote = np.where(draw.random(len(bad)) < 0.85, 1, -1) * np.where(bad, -1, 1)
        votes.append(np.where(draw.random(len(bad)) < 0.7, vote, 0))
    for _ in range(3):
        votes.append(np.where(draw.random(len(bad)) < np.where(bad, 0.2, 0.0002), -1, 0))
    patterns, counts = np.unique(np.stack(votes, axis=1), axis=0, return_counts=True)
    base, weights = fit(patterns, counts.astype(float)).log_odds()
    against = weights[5 + rule][0]
    assert against < -4
    # Two good votes and this rule's vote against.
    two = base + weights[0][1] + weights[1][1]
    assert two > 0 > two + against


def test_documents_with_an_echo_are_rejected(spark):
    rows = judge(read_table(spark, "/root/testdata/sf0.1", "documents"), carry=["doc_id"])
    echo = rows.where("NOT __quality.base_failed AND 100 * __quality.n_echo > 15 * __quality.n_words")
    assert echo.count() > 0 and echo.where("__quality.kept").count() == 0
