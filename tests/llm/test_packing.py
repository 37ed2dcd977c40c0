import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from starpipe.llm.common import read_table
from starpipe.llm.packing import Encoder, combinations, pack, plan
from starpipe.llm.registry import tokenizer_files

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_files()[0])


def test_encoder_gives_the_tokenizers_ids(tokenizer):
    draw, encode = random.Random(5), Encoder(*tokenizer_files())
    parts = [" ", "\n", "\t", "a", "b'", "'s", "é", "1", "<|endoftext|>", "!", "　", "\x1c", "\x85", "\r", "漢", "\0", " x"]
    texts = ["", " ", "\n", "a  b", " a\n\n b ", "it's <|endoftext|> ok <|endoftext|>"]
    texts += ["".join(draw.choices(parts, k=draw.randint(1, 15))) for _ in range(1500)]
    for text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert encode(text) == np.array(ids, "<u4").tobytes(), repr(text)


def test_combinations_fill_without_padding():
    found = combinations(64)
    assert set(found.sum(axis=1)) == {1, 2, 4, 8, 16, 32, 64}
    assert len(np.unique(found, axis=0)) == len(found)
    assert ((found == np.sort(found, axis=1)).all(axis=1)).all()


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_up_the_histogram(seed):
    draw = np.random.default_rng(seed)
    counts = np.zeros(129, np.int64)
    if seed:
        counts[1:] = draw.integers(0, 40, 128) * (draw.random(128) < 0.7)
    else:
        counts[100] = 10**12
    used = np.zeros_like(counts)
    for lengths, repeats in plan(counts, 128):
        assert sum(lengths) <= 128 and repeats > 0
        np.add.at(used, list(lengths), repeats)
    assert (used == counts).all()


def test_pieces_of_whole_table(spark, tokenizer):
    docs = read_table(spark, SF, "documents")
    pieces = pack(docs, *tokenizer_files()).toPandas()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for doc_id, some in pieces.sort_values("start").groupby("doc_id"):
        ids = np.array([*tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids, 0], "<u4")
        assert (some.doc_tokens == len(ids)).all() and some.length.sum() == len(ids)
        assert (some.start == some.length.cumsum() - some.length).all()
        for r in some.itertuples():
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    assert set(pieces.doc_id) == set(texts)
    ordered = pieces.sort_values(["sequence_id", "offset"])
    before = ordered.groupby("sequence_id").length.cumsum() - ordered.length
    assert (before == ordered.offset).all()
    size = pieces.groupby("sequence_id").length.sum().to_numpy()
    assert size.max() <= 1024
    padded = np.where((size & (size - 1)) == 0, 0, 1024 - size)
    assert padded.sum() < 0.02 * size.sum()


def test_edge_cases_have_defined_results(make):
    schema = "doc_id long, text string, length long, part string"
    rows = [(1, None, 1, "x"), (2, "", 1, "x"), (3, "a b", 1, "x"), (3, "a b", 1, "x"), (None, "a", 1, None),
            (4, "word " * 100_000, 1, "x")]
    got = pack(make(rows, schema), *tokenizer_files()).toPandas()
    assert got[got.doc_id == 1].doc_tokens.tolist() == [1] and got[got.doc_id == 2].length.tolist() == [1]
    assert got[got.doc_id == 3].doc_tokens.tolist() == [3, 3] and got.doc_id.isna().sum() == 1
    assert got[got.doc_id == 4].length.sum() == got[got.doc_id == 4].doc_tokens.iloc[0]
    assert pack(make([], schema), *tokenizer_files()).count() == 0
