import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from starpipe.llm import oracles, phrases
from starpipe.llm.registry import op13_phrases

SCHEMA = "doc_id long, text string, lang string, grp int, gram string, n int, block int, words string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_python(rows, least, percent=100, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    found = []
    for lang, f in counts.items():
        frequent = {phrase: a for phrase, a in f.items() if a >= least}
        scored = []
        for phrase, a in frequent.items():
            size = len(phrase)
            inside = any(
                len(other) > size and 100 * b >= percent * a
                and any(other[i : i + size] == phrase for i in range(len(other) - size + 1))
                for other, b in frequent.items()
            )
            if size > 1 and not inside:
                score, _, left, right = min(
                    (1000 * a * totals[lang] // (f[phrase[:k]] * f[phrase[k:]]), k, f[phrase[:k]], f[phrase[k:]])
                    for k in range(1, size)
                )
                scored.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def texts(seed, count):
    pick = random.Random(seed)
    words = ["a", "b", "B", "c", "dé", "漢", "x-y", "long" * 9, "\x1c", " "]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " !? "]
    return ["".join(pick.choice(words) + pick.choice(gaps) for _ in range(pick.randrange(60))) for _ in range(count)]


def table(make, rows):
    return make([(i, text, lang, 1, "g", 2, 3, "w") for i, (lang, text) in enumerate(rows)], SCHEMA)


def result(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def small_blocks(monkeypatch):
    """Many small blocks and groups, counts handed on early; workers fork after the change."""
    for name, value in (("BLOCK", 200), ("GROUP", 500), ("HELD", 64)):
        monkeypatch.setattr(phrases, name, value)


@pytest.mark.parametrize(("least", "percent", "top"), [(5, 100, 2000), (2, 60, 7)])
def test_equals_plain_python(spark, make, least, percent, top):
    rows = [(pick, text) for pick, text in zip(["en", "de", None, ""] * 50, texts(1, 200))]
    rows += [("en", None), (None, ""), ("en", "one " * 400 + "two"), ("fr", "un deux " * 50), ("fr", "un deux " * 50)]
    mine = result(phrases.collocations(table(make, rows), least=least, percent=percent, top=top))
    assert mine == plain_python(rows, least, percent, top)
    assert len(mine) > 10


def test_blocks_and_groups_change_nothing(small_blocks):
    """The rounds' own functions, on blocks of 200 bytes whose counts are handed on at once."""
    import pyarrow as pa

    rows = [("en", text) for text in texts(2, 60)] + [("de", "x y z. " * 40)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], ["lang", "text"])
    blocks = [row for out in phrases._pack(iter([batch])) for row in out.to_pylist()]
    assert len(blocks) > 20
    f = Counter()
    for row in blocks:
        block = phrases.Block(row["lang"], row["words"], row["ids"])
        for size in range(1, 6):
            at = block.places(size)
            for phrase, count in block.texts(at, block.grams(at, size), size).items():
                f[row["lang"], phrase] += count
    expected = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    expected[lang, " ".join(words[i : i + size])] += 1
    assert f == expected


def test_frequent_fingerprints_go_back_once_to_each_group(monkeypatch):
    """Rows of a fingerprint lie in several batches; group 1 handed its counts on twice."""
    import pyarrow as pa

    monkeypatch.setattr(phrases, "HELD", 16)
    rows = [(-5, 3, 0), (2, 2, 1), (2, 2, 0), (2, 1, 1), (4, 4, 1), (7, 9, 2), (7, 1, 1), (9, 4, 0)]
    for size in (1, 2, 3, 8):
        batches = [
            pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*rows[i : i + size]), (pa.int64(), pa.int64(), pa.int32()))],
                ["gram", "n", "grp"],
            )
            for i in range(0, len(rows), size)
        ]
        back = defaultdict(list)
        for out in phrases._frequent(5)(iter(batches)):
            assert out.schema.field("grams").type == pa.list_(pa.int64())
            for row in out.to_pylist():
                back[row["grp"]] += row["grams"]
        assert back == {0: [2], 1: [2, 7], 2: [7]}
    assert list(phrases._frequent(5)(iter([]))) == []


def test_frequent_fingerprints_are_not_joined_to_their_rows(spark, make, monkeypatch):
    plans, rows = [], []

    def recorded(df, label, cut=phrases.cut):
        written = cut(df, label)
        if label.endswith("by-group"):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            rows.append([row["grams"] for row in written.collect()])
        return written

    monkeypatch.setattr(phrases, "cut", recorded)
    blocks = phrases.blocks_of(table(make, [("en", "a b c. ") for _ in range(120)]))
    found = result(phrases.frequent_phrases(blocks))
    assert found == [("en", p, len(p.split()), 120) for p in ("a", "a b", "a b c", "b", "b c", "c")]
    assert [{*map(len, r)} for r in rows] == [{3}, {2}, {1}, set(), set()]
    assert not any("Join" in plan for plan in plans)


def test_colliding_fingerprints_are_told_apart_by_text():
    n, words, ids = phrases._numbered([b"a b c a b"])
    block = phrases.Block("en", words, ids)
    at = block.places(2)
    assert n == 5
    assert block.texts(at, np.zeros(len(at), np.int64), 2) == {"a b": 2, "b c": 1, "c a": 1}


def test_polynomials_give_equal_hashes_to_equal_slices():
    numbers = np.array([7, 8, 9, 7, 8, 9, 8], np.uint64)
    hashes = phrases.Polynomial(numbers).of(np.array([0, 3, 1]), np.array([3, 6, 4]))
    assert hashes[0] == hashes[1] != hashes[2]


def test_products_may_pass_64_bits(spark, make):
    counts = make(
        [("en", "a b", 2, 3_000_000_000_000), ("en", "a", 1, 4_000_000_000_000), ("en", "b", 1, 5_000_000_000_000)],
        "lang string, phrase string, size int, a long",
    )
    total = 9_000_000_000_000_001
    row = phrases.scored(counts, make([("en", total)], "lang string, n long")).first()
    assert row["score"] == 1000 * 3_000_000_000_000 * total // (4_000_000_000_000 * 5_000_000_000_000)


def test_empty_and_wordless_tables(spark, make):
    assert result(phrases.collocations(table(make, []))) == []
    assert result(phrases.collocations(table(make, [("en", None), (None, " \n"), ("de", "rare words")]))) == []


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    mine = result(op13_phrases(spark, sf_dir))
    assert mine == sorted(con.execute(oracles.phrases()).fetchall())
    assert mine
