import numpy as np
import pytest
from pyspark.sql import functions as F

from starpipe.llm.common import read_table
from starpipe.llm.mixing import (
    TARGETS, copies_of, domain_of_labels, fit, fit_rates, mix, nearest_shares, solve_rates,
)

SF = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, rate string, copies int"


def test_held_out_documents_are_told_apart(spark):
    docs, labels = read_table(spark, SF, "documents"), domain_of_labels(read_table(spark, SF, "labels"))
    mixed = mix(docs, labels.where("doc_id % 2 = 0"), carry=["doc_id"])
    held = mixed.join(labels.where("doc_id % 2 = 1"), "doc_id")
    rows = held.select("domain", "__mix.posterior", "__mix.copies").toPandas()
    best = np.array(list(TARGETS))[np.array(rows.posterior.tolist()).argmax(axis=1)]
    assert (best[rows.domain == "good"] == "good").mean() > 0.97
    assert (best[rows.domain == "toxic"] != "good").mean() > 0.8
    assert (rows.copies[rows.domain == "good"] == 1).mean() > 0.97
    assert (rows.copies[rows.domain == "toxic"] == 0).mean() > 0.7


def scored(make, posteriors, tokens):
    rows = [((t, p),) for t, p in zip(tokens, posteriors)]
    return make(rows, "m struct<tokens: long, posterior: array<double>>")


@pytest.mark.parametrize("max_rate", [1.0, 4.0])
def test_expected_tokens_match_the_targets(make, max_rate):
    draw = np.random.default_rng(2)
    posteriors = draw.dirichlet([0.3, 0.2, 0.1], 400)
    tokens = draw.integers(1, 900, 400)
    weights = np.array([0.8, 0.15, 0.05])
    frame = scored(make, posteriors.tolist(), tokens.tolist())
    rows = frame.select("m", fit_rates(frame, weights, 0, "m", max_rate).alias("r")).collect()
    rate = np.array([r["r"] for r in rows])
    p, t = np.array([r["m"]["posterior"] for r in rows]), np.array([r["m"]["tokens"] for r in rows])
    have = ((rate * t)[:, None] * p).sum(axis=0)
    assert rate.min() >= 0 and rate.max() <= max_rate
    if max_rate > 1:
        assert np.abs(have / have.sum() - weights).max() < 2e-3
    start = (t[:, None] * p).sum(axis=0)
    goal = np.minimum(weights / weights[0] * start[0], max_rate * start)
    assert np.abs(have - goal).max() < np.abs(start - goal).max()


def test_edge_cases_have_defined_results(make):
    rows = [(1, None, "a", 1), (2, "", "a", 1), (None, "some words", None, None), (3, "some words", "a", 1),
            (3, "some words", "a", 1), (4, "word " * 100_000, "a", 1)]
    labels = make([(None, "good"), (3, None), (3, "unknown")], "doc_id long, domain string")
    mixed = mix(make(rows, SCHEMA), labels)
    assert mixed.columns == ["doc_id", "text", "rate", "copies", "__mix"]
    got = mixed.collect()
    assert len(got) == len(rows) and all(r["__mix"]["copies"] == 1 for r in got)
    assert sorted(r["__mix"]["tokens"] for r in got) == [0, 0, 2, 2, 2, 100_000]
    assert copies_of(mixed).columns == ["doc_id", "text", "rate", "copies"]
    assert mix(make([], SCHEMA), labels).count() == 0


def test_columns_named_like_internal_ones_stay(make):
    names = ["__rate", "__draw", "__domain", "__id", "words", "text", "z"]
    frame = make([(1, "some words", *names[:5], *names[6:])],
                 "doc_id long, body string, " + ", ".join(f"{n} string" for n in names if n != "text"))
    labels = make([(1, "good")], "doc_id long, domain string")
    (row,) = mix(frame, labels, text="body").collect()
    assert all(row[n] == n for n in names if n != "text") and row["__mix"]["tokens"] == 2


def test_copies_are_rows(make):
    frame = make([(1, (0,)), (2, (1,)), (3, (3,))], "doc_id long, m struct<copies: long>")
    got = copies_of(frame.select("doc_id", F.col("m").alias("__mix")))
    assert sorted(r["doc_id"] for r in got.collect()) == [2, 3, 3, 3]


@pytest.mark.parametrize("targets", [{"good": 0.6, "low": 0.3, "toxic": 0.1}, TARGETS])
def test_shares_are_the_targets_at_the_default_rates(spark, targets):
    docs, labels = read_table(spark, SF, "documents"), domain_of_labels(read_table(spark, SF, "labels"))
    rows = mix(docs, labels, targets, carry=["doc_id"]).select("__mix.*").toPandas()
    p, weights = np.array(rows.posterior.tolist()), np.array(list(targets.values()))
    for kept, miss in ((rows.rate, 2e-4), (rows.copies, 0.02)):
        have = (kept * rows.tokens).to_numpy() @ p
        assert np.abs(have / have.sum() - weights).max() < miss
    assert rows.rate.max() <= 1 and rows.copies.max() <= 1


def test_small_rates_keep_their_part(make):
    rows = [(i, "word" if i < 8000 else "marker word", "x", 1) for i in range(10_000)]
    labels = [(i, "good" if i < 8000 else "toxic") for i in range(10_000)]
    mixed = mix(make(rows, SCHEMA), make(labels, "doc_id long, domain string"), {"good": 0.99, "toxic": 0.01}, carry=["doc_id"])
    got = mixed.where("doc_id >= 8000").select("__mix.rate", "__mix.copies").toPandas()
    assert 0 < got.rate.max() < 0.05
    assert abs(got.copies.sum() - got.rate.sum()) < 4 * got.rate.sum() ** 0.5 and got.copies.sum() > 0


@pytest.mark.parametrize("max_rate", [1.0, 3.0])
def test_rates_are_at_the_optimum(max_rate):
    draw = np.random.default_rng(5)
    for _ in range(30):
        p = draw.dirichlet([0.5, 0.3, 0.2], int(draw.integers(1, 10)))
        n, weights = draw.integers(1, 10_000, len(p)).astype(float), draw.dirichlet([1, 1, 1])
        shares = nearest_shares(p, weights)
        # The nearest point of a polytope: no corner is further along the way to the weights.
        assert (p @ (shares - weights)).min() >= shares @ (shares - weights) - 1e-9
        rate = solve_rates(p, n, weights, 0, max_rate)
        have = (rate * n) @ p
        assert rate.min() >= 0 and rate.max() <= max_rate
        assert np.abs(have / have.sum() - shares).max() < 3e-4
        # A total 2% larger misses the shares, or the anchor has its tokens.
        total, part = 1.02 * have.sum(), rate.copy()
        system = p.T * n / total
        step = 1 / np.linalg.eigvalsh(system @ system.T).max()
        for _ in range(20_000):
            part = np.clip(part - step * (system.T @ (system @ part - shares)), 0, max_rate)
        assert have[0] >= 0.999 * (n @ p)[0] or np.abs(system @ part - shares).max() > 1e-4


def test_every_word_that_marks_a_domain_is_in_the_model(make):
    words = [[f"w{i}x{k}" for k in range(20)] for i in range(20)]
    rows = [(i, "common " + " ".join(words[i // 20] if i < 400 else ["plain"]), "x", 1) for i in range(4000)]
    labels = make([(i, "toxic" if i < 400 else "good") for i in range(4000)], "doc_id long, domain string")
    docs = make(rows, SCHEMA)
    model = fit(docs, labels, ["good", "toxic"])
    assert set(sum(words, [])) <= set(model.words)
    mixed = mix(docs, labels, {"good": 0.9, "toxic": 0.1}, carry=["doc_id"]).where("doc_id < 400")
    assert mixed.where(F.col("__mix.posterior")[1] < 0.9).count() == 0
