import random

import numpy as np
import pyarrow as pa
import pytest

from starpipe.llm import setjoin
from starpipe.llm.common import read_table
from starpipe.llm.setjoin import Bands, difference_bound, one_of_each, similar_sets

SCHEMA = "doc_id long, text string, leader string, n int"


def brute(rows, percent=85):
    """Components by comparing all pairs of shingle sets."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        size = min(4, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    parent = {doc_id: doc_id for doc_id, _ in rows if doc_id is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            both = len(sets[i] & sets[j])
            if both and None not in (a, b) and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted(
        (str(d), len(s), str(root(d) if d is not None else None)) for (d, _), s in zip(rows, sets)
    )


def got(frame):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in frame.collect())


def family(draw, base, edits):
    words = list(base)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_families_against_brute_force(make, seed):
    """Near copies around the threshold, in groups whose members link in part only."""
    draw, texts = random.Random(seed), []
    passage = [f"p{i}" for i in range(40)]
    for _ in range(6):
        base = [f"w{draw.randrange(5000)}" for _ in range(draw.choice([6, 9, 30, 120, 400]))]
        texts += [family(draw, base, draw.randrange(1 + len(base) // 25)) for _ in range(14)]
    texts += [" ".join(passage + [f"u{draw.randrange(10**6)}" for _ in range(draw.randrange(12))]) for _ in range(40)]
    texts += ["a b c", "A B  C", "a b", "a", "a", texts[0].upper(), texts[3] + "\n"]
    ids = draw.sample(range(10**6), len(texts))
    rows = list(zip(ids, texts))
    frame = make([(*r, "x", 1) for r in rows], SCHEMA)
    assert got(similar_sets(frame)) == brute(rows)


@pytest.mark.parametrize("rows_a_block", [4, 2_000])
def test_links_within_and_between_blocks_against_brute_force(make, monkeypatch, rows_a_block):
    """All are members of one leader's list, and none is known to be linked."""
    monkeypatch.setattr(setjoin, "BLOCK_ROWS", rows_a_block)
    draw, texts = random.Random(5), []
    base = [f"w{i}" for i in range(200)]
    for _ in range(12):
        near = family(draw, base, draw.randrange(4, 12)).split()
        texts += [family(draw, near, draw.randrange(3)) for _ in range(3)]
    rows = list(zip(draw.sample(range(1, 10**6), len(texts)), texts))
    frame = make(rows, "doc_id long, text string")
    members = frame.selectExpr("1L AS list", "0L AS leader", "doc_id")
    sizes = frame.selectExpr("doc_id", "200L AS least", "200L AS most", "0L AS sketch")
    unknown = make([], "node long, component long")
    links = setjoin.cross_links(setjoin.Join(frame, 4, 85), members, unknown, sizes, 85)
    labels = {r["node"]: r["component"] for r in setjoin.components(links).collect()}
    wanted = {int(d): int(c) for d, _, c in brute(rows)}
    assert len(set(wanted.values())) < len(rows) and {d: labels.get(d, d) for d in wanted} == wanted


def test_overlaps_derived_from_a_pivot():
    draw = np.random.default_rng(3)
    base = draw.choice(10**6, 300, replace=False)
    sets = [np.unique(np.concatenate((draw.choice(base, 270, replace=False), draw.choice(10**6, 20)))) for _ in range(30)]
    sets += [np.unique(draw.choice(10**6, 50)) for _ in range(5)]
    index = setjoin._Index(sets)
    for own in (*sets, np.array([-1]), *sets[:3]):
        assert index.overlaps(own).tolist() == [len(np.intersect1d(own, other)) for other in sets]


def test_small_table_against_brute_force(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(similar_sets(docs)) == brute(rows)


def test_edge_cases_have_defined_results(make):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "same text of words here"), (5, "Same text of words here"),
            (5, "Same text of words here"), (None, "same text of words here"), (6, long), (7, long + " end"),
            (8, "two texts one id now"), (8, "other words for this id"), (9, "other words for this id")]
    frame = make([(*r, None, None) for r in rows], SCHEMA)
    result = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in similar_sets(frame).collect()}
    assert result[(1, 0)] == 1 and result[(2, 0)] == 2 and result[(3, 0)] == 3
    assert result[(5, 2)] == 4 and result[(None, 2)] is None
    assert result[(7, 59_998)] == 6 and result[(9, 2)] == 8
    assert similar_sets(make([], SCHEMA)).count() == 0


def test_one_of_each_group_stays(make):
    rows = [(3, "one two three four five", "c", 1), (1, "one two three FOUR five", "a", 2),
            (1, "one two three FOUR five", "a", 2), (7, None, "d", 3), (8, "", "e", 4), (None, "x", "f", 5)]
    kept = one_of_each(make(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "leader", "n"]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "7", "8", "None"]


def test_columns_named_like_internal_ones_stay(make):
    names = ["__h", "__word", "__bits", "__id", "__component", "__rows", "__row", "h", "word", "bits", "id", "component", "rows", "given"]
    rows = [(i, "one two three four five", *names) for i in (3, 1, 1)] + [(7, "other words", *names)]
    kept = one_of_each(make(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 7]
    assert kept.columns == ["doc_id", "text", *names] and all(tuple(r)[2:] == tuple(names) for r in kept.collect())


@pytest.mark.parametrize("percent", [80, 85, 90])
def test_bands_and_bounds_lose_no_pair(percent):
    bands = Bands(percent)
    for small in range(1, 300):
        for large in range(small, small * 100 // percent + 1):
            assert bands.of(large) - bands.of(small) in (0, 1)
            most = max(
                small + large - 2 * both
                for both in range(small + 1)
                if 100 * both >= percent * (small + large - both)
            ) if 100 * small >= percent * large else 0
            assert most <= difference_bound(large, small, percent)
            count, slack, _ = bands.positions(bands.of(small))
            assert count - slack > most


@pytest.mark.parametrize("percent", [80, 85, 90])
def test_a_set_enters_one_list_more_than_it_can_differ_in_and_loses_no_link(percent):
    draw, bands = np.random.default_rng(percent), Bands(percent)
    for size in (1, 2, 3, 5, 8, 13, 40, 100, 333, 1000, *draw.integers(4, 600, 60)):
        base = draw.integers(0, 2**64, int(size), np.uint64)
        own, own_lists = bands.of(len(base)), bands.lists(np.sort(base))
        most = difference_bound(len(base) * 100 // percent, len(base), percent) + 1
        below = bands.first[own] - 1
        if own and 100 * below >= percent * len(base):
            most += difference_bound(len(base), below, percent) + 1
        assert len(own_lists) == most
        for _ in range(20):
            # As many elements fewer, more, or replaced as links allow.
            less, more = draw.integers(0, most + 1, 2)
            other = np.concatenate((base[less:], draw.integers(0, 2**64, more, np.uint64)))
            if 100 * (len(base) - less) >= percent * (len(base) + more):
                assert np.intersect1d(own_lists, bands.lists(np.sort(other))).size


def test_parities_rule_out_no_link_and_most_other_members():
    draw = np.random.default_rng(7)
    for size in (300, 1000, 1030, 9000):
        base = draw.integers(0, 2**64, size, np.uint64)
        near, far = (np.concatenate((base[n:], draw.integers(0, 2**64, n, np.uint64))) for n in (size // 20, size // 5))
        assert setjoin._changed(setjoin._sketch(base), setjoin._sketch(near)) <= 2 * (size // 20)
        sets = [base, near, near[size // 20 :], far]
        table = pa.table({
            "leader": [1] * 4, "low": [0] * 4, "high": [0] * 4, "doc_id": [2, 3, 4, 5], "component": [2, 3, 4, 5], "block": [0] * 4,
            "n_shingles": [len(s) for s in sets], "parities": [setjoin._sketch(s) for s in sets],
        })
        assert setjoin._possible(table, 85).column("doc_id").to_pylist() == [2, 3, 4]
        alone = setjoin._possible(table.set_column(4, "component", pa.array([9] * 4)), 85)
        assert alone.num_rows == 0


def test_texts_of_documents_that_go_are_ruled_out_before_the_shuffle(make, monkeypatch):
    """With a filter of one word nearly all ids are taken for others'; the result is the same."""
    draw, texts = random.Random(8), []
    for _ in range(30):
        base = [f"w{draw.randrange(5000)}" for _ in range(60)]
        texts += [" ".join(base), " ".join(base), family(draw, base, 1)]
    rows = list(zip(draw.sample(range(10**6), len(texts)), texts))
    frame = make([*rows, (None, texts[0]), (None, None)], "doc_id long, text string")
    wanted = sorted(d for d, _, c in brute(rows) if d == c)
    for words in (1, setjoin.FILTER_WORDS):
        monkeypatch.setattr(setjoin, "FILTER_WORDS", words)
        assert sorted(str(r["doc_id"]) for r in one_of_each(frame).collect()) == sorted([*wanted, "None", "None"])
