import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from starpipe.llm import mixing
from starpipe.llm.common import cut, read_table
from starpipe.llm.quality import COUNTS, RULES, count_text, fit
from starpipe.llm.registry import tokenizer_files
from tests.llm.test_setjoin import brute

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = read_table(spark, SF, "documents")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF), name.replace(" ", "-"))
        found.append(docs)
    return found


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_stages_call_their_operators_in_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "n-gram Jaccard join", "PII", "mixing sources to target weights", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and set(corpus_pipeline.QUERIES) == {"pipeline"}


def test_all_but_the_last_return_the_columns_of_documents(stages):
    assert all(frame.columns == COLUMNS for frame in stages[:-1])


def test_quality_against_plain_python(stages, make):
    given, kept = texts(stages[0]), texts(stages[1])
    names = [field.split()[0] for field in COUNTS.split(", ")]
    counts = {i: dict(zip(names, count_text(t))) for i, t in given.items()}
    rows = [(i, c) for i, c in counts.items()]
    struct = ", ".join(f.replace(" ", ": ") for f in COUNTS.split(", "))
    frame = make(rows, f"doc_id long, q struct<{struct}>")
    q = F.col("q")
    votes = F.array(*[F.when(r.bad(q), -1).when(r.good(q), 1).otherwise(0) for r in RULES])
    votes = {r["doc_id"]: r["v"] for r in frame.select("doc_id", votes.alias("v")).collect()}
    patterns, times = np.unique(np.array(list(votes.values())), axis=0, return_counts=True)
    base, weights = fit(patterns, times.astype(float)).log_odds()

    def accepted(i):
        c = counts[i]
        odds = base + sum(w[0] if v < 0 else w[1] for v, w in zip(votes[i], weights) if v)
        return c["n_words"] >= 10 and 100 * c["n_repeat_words"] <= 20 * c["n_words"] and odds >= 0

    assert set(kept) == {i for i in given if accepted(i)}


def test_near_duplicates_against_all_pairs(stages):
    given, kept = texts(stages[1]), texts(stages[2])
    groups = brute(sorted(given.items()))
    assert set(map(str, kept)) == {doc_id for doc_id, size, root in groups if doc_id == root}


def test_pii_changes_digits_and_addresses_only(stages):
    before, after = texts(stages[2]), texts(stages[3])
    assert before.keys() == after.keys()
    changed = 0
    for i, old in before.items():
        assert len(old) == len(after[i]) or re.search(r"\d+\.\d+\.\d+\.\d+", old)
        plain = lambda t: re.sub(r"[\w.+-]+@[\w.-]+|[\d.]+", "", t)
        assert plain(old) == plain(after[i])
        changed += old != after[i]
    assert changed > 10


def test_mixing_against_plain_python(spark, stages):
    docs = stages[3]
    labels = mixing.domain_of_labels(read_table(spark, SF, "labels"))
    domains = list(mixing.TARGETS)
    model = mixing.fit(docs, labels, domains)
    words = {r["doc_id"]: r["w"] for r in docs.select("doc_id", mixing.words_of(F.col("text")).alias("w")).collect()}
    ids = list(words)

    def bin_of(text_words):
        known = [model.words.index(w) for w in set(text_words) & set(model.words)]
        if not known:
            return 0
        score = model.weight[known].sum(axis=0)
        order = np.sort(score)[::-1]
        lead = order[0] - order[1]
        return int(score.argmax()) * len(mixing.LEADS) + sum(lead >= x for x in mixing.LEADS)

    p = np.array([model.posterior[bin_of(words[i])] for i in ids])
    t = np.array([len(words[i]) for i in ids], float)
    weights = np.array(list(mixing.TARGETS.values()))
    have = (t[:, None] * p).sum(axis=0)
    gram = (t[:, None] * p).T @ p
    goal = np.minimum(weights / weights[0] * have[0], have)
    scale = 1 / np.maximum(np.diag(gram), mixing.LEAST_SCALE * np.diag(gram).max())
    step = 1 / np.linalg.eigvalsh(np.sqrt(scale)[:, None] * gram * np.sqrt(scale)).max()
    rate = np.ones(len(ids))
    # Steps end where the totals stand still, as in the operator.
    for _ in range(mixing.STEPS):
        if np.abs(have - goal).max() <= mixing.CLOSE * goal.sum():
            break
        rate = np.clip(rate - p @ (step * scale * (have - goal)), 0, 1)
        before, have = have, ((rate * t)[:, None] * p).sum(axis=0)
        if np.abs(have - before).max() <= 0.1 * mixing.CLOSE * goal.sum():
            break
    kept = texts(stages[4])
    sure = {i: r for i, r in zip(ids, rate) if r > 0.96 or r < 0.04}
    assert len(sure) > 0.9 * len(ids)
    assert all((i in kept) == (r > 0.5) for i, r in sure.items())
    assert stages[4].count() == len(kept)


def test_packing_covers_every_token_once(stages):
    given = texts(stages[4])
    tokenizer = Tokenizer.from_file(tokenizer_files()[0])
    pieces = stages[5].toPandas()
    assert set(pieces.doc_id) == set(given)
    for doc_id, some in pieces.sort_values("start").groupby("doc_id"):
        ids = np.array([*tokenizer.encode(given[doc_id], add_special_tokens=False).ids, 0], "<u4")
        assert some.length.sum() == len(ids)
        for r in some.itertuples():
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    assert pieces.groupby("sequence_id").length.sum().max() <= 1024


def test_empty_documents_pass_all_stages(spark, make):
    docs = make([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF), "empty")
        assert docs.count() == 0
