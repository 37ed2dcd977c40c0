"""Packing token sequences by non-negative least squares over the length histogram.

Every document becomes its token ids and a closing id 0. Ids are cut at multiples of the window, so
a document gives full pieces and at most one remainder. The histogram of piece lengths (at most
``window`` numbers, whatever the corpus) goes to the driver, which

1. enumerates all combinations of up to three lengths that fill a sequence without padding,
2. solves min |A x - b|, x >= 0, where a column of A counts a combination's lengths and b is the
   histogram, by accelerated projected gradient steps,
3. rounds the repeat counts within what the histogram holds,
4. packs the residual histogram greedily, longest first.

The plan maps (length, rank within the length) to (sequence, offset). Ranks come from counters
inside the tasks plus offsets per task, so no length, however frequent, is sorted in one task, and
no token id is ever shuffled.
"""

from __future__ import annotations

import os
import re
import zlib
from base64 import b64decode
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starpipe.llm.common import columns, cut

WINDOW = 1024
#: Distinct words whose ids a task remembers; a full memory is emptied, results stay the same.
CACHED_WORDS = 1_000_000
#: Output rows of one Arrow batch.
BATCH_ROWS = 20_000
STEPS = 400

_ODD = re.compile(r"\s[ \n]|[ \n]\s|\0")
_SPACES = re.compile(r"(?<=\S)(?= \S)")
#: One word without what might belong to a special token.
_PLAIN = re.compile(r" ?(?!\S*<\|)\S+")
#: Fixed value: how byte-level vocabularies of this family cut a text before merging.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "part long, nth long"
)


class Encoder:
    """Token ids of a text as little-endian unsigned 32-bit numbers.

    The byte-level pre-tokenizer never joins what stands on two sides of a single space or line
    feed between two other characters: a space opens the next pre-token, a line feed is one of its
    own. Texts are cut there, and the ids of each part, which recurs often, are remembered. What is
    not known yet is encoded in one call, a part on each line, from ``ranks``, the same vocabulary
    in the form of the faster library. Parts with odd white space or a possible special token go to
    the tokenizer itself.
    """

    def __init__(self, path: str, ranks: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(ranks, "rb") as lines:
            merges = {b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={}
        )
        self.known: dict[str, bytes] = {}
        self.line_feed = self._ids("\n")[0]

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _learn(self, parts: set[str]) -> None:
        plain = [part for part in parts if _PLAIN.fullmatch(part)]
        for part in parts.difference(plain):
            self.known[part] = self._ids(part).tobytes()
        if plain:
            ids = np.array(self.fast.encode_ordinary("\n".join(plain)), dtype="<u4")
            ends = np.flatnonzero(ids == self.line_feed).tolist()
            data, start = ids.tobytes(), 0
            for part, end in zip(plain, [*ends, len(ids)], strict=True):
                self.known[part] = data[4 * start : 4 * end]
                start = end + 1

    def __call__(self, text: str) -> bytes:
        if _ODD.search(text):
            parts = _SPACES.split(text)
        else:
            parts = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        known = self.known
        ids = list(map(known.get, parts))
        if None in ids:
            if len(known) > CACHED_WORDS:
                known.clear()
                ids = [None] * len(parts)
            self._learn({part for part, found in zip(parts, ids) if found is None})
            ids = map(known.__getitem__, parts)
        return b"".join(ids)


@lru_cache(maxsize=1)
def _encoder(path: str, ranks: str) -> Encoder:
    """One for all tasks of a Python worker."""
    return Encoder(path, ranks)


def _pieces(
    batches: Iterator[pa.RecordBatch], path: str, ranks: str, window: int
) -> Iterator[pa.RecordBatch]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    encode = _encoder(path, ranks)
    part = TaskContext.get().partitionId()
    seen = [0] * (window + 1)
    rows: list[tuple] = []
    for ids, texts in columns(batches):
        for doc_id, text in zip(ids, texts):
            data = (encode(text) if text else b"") + b"\0\0\0\0"
            total = len(data) // 4
            for start in range(0, total, window):
                length = min(window, total - start)
                crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                rows.append((doc_id, start, length, crc, total, part, seen[length]))
                seen[length] += 1
            if len(rows) >= BATCH_ROWS:
                yield _batch(rows)
                rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [field.split()[0] for field in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, pa.int64()) for column in zip(*rows)], names=names
    )


def combinations(window: int) -> np.ndarray:
    """All ascending (a, b, c), zeros in front, that sum up to the window or to a power of two."""
    sums = sorted({window} | {1 << k for k in range(window.bit_length()) if 1 << k <= window})
    found = []
    for total in sums:
        found.append(np.array([[0, 0, total]]))
        a = np.arange(1, total // 2 + 1)
        found.append(np.stack([np.zeros_like(a), a, total - a], axis=1))
        for first in range(1, total // 3 + 1):
            b = np.arange(first, (total - first) // 2 + 1)
            found.append(np.stack([np.full_like(b, first), b, total - first - b], axis=1))
    return np.concatenate(found)


def solve(combos: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - b|^2 by accelerated projected gradient."""
    present = counts > 0
    present[0] = True
    usable = np.flatnonzero(present[combos].all(axis=1))
    result = np.zeros(len(combos))
    if not len(usable):
        return result
    some = combos[usable]
    scale = counts.max()
    b = counts / scale

    def forward(x: np.ndarray) -> np.ndarray:
        total = np.bincount(some.ravel(), np.repeat(x, 3), minlength=len(counts))
        total[0] = 0
        return total

    # Power iteration for the largest eigenvalue of A'A.
    v = np.ones(len(some))
    for _ in range(20):
        w = forward(v)[some].sum(axis=1)
        norm = np.linalg.norm(w)
        v = w / norm
    rate = 1 / (1.05 * norm)
    x = y = np.zeros(len(some))
    t = 1.0
    for _ in range(steps):
        gradient = (forward(y) - b)
        gradient[0] = 0
        new = np.maximum(y - rate * gradient[some].sum(axis=1), 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    result[usable] = x * scale
    return result


def plan(counts: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences) that use up counts[length] exactly."""
    left = counts.astype(np.int64).copy()
    chosen: list[tuple[tuple[int, ...], int]] = []

    def take(lengths: tuple[int, ...], repeats: int) -> int:
        need = np.bincount(lengths, minlength=len(left))
        at = np.flatnonzero(need)
        repeats = int(min(repeats, *(left[at] // need[at])))
        if repeats > 0:
            left[at] -= repeats * need[at]
            chosen.append((lengths, repeats))
        return repeats

    combos = combinations(window)
    x = solve(combos, left)
    for i in np.argsort(-x, kind="stable"):
        if x[i] < 1e-3:
            break
        take(tuple(int(n) for n in combos[i] if n), max(1, round(x[i])))
    while left.any():
        lengths: list[int] = []
        room, free = window, left.copy()
        while room and (fits := np.flatnonzero(free[: room + 1])).size:
            lengths.append(int(fits[-1]))
            free[lengths[-1]] -= 1
            room -= lengths[-1]
        take(tuple(lengths), int(left.max()))
    return chosen


class Slots(NamedTuple):
    """Runs of ranks of a length, ascending by ``key`` = length << 44 | first rank."""

    key: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


_RANK_BITS = 44


def slots(chosen: list[tuple[tuple[int, ...], int]]) -> Slots:
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, repeats in chosen:
        offset = 0
        for length in lengths:
            first = used.get(length, 0)
            rows.append((length << _RANK_BITS | first, sequence, offset))
            used[length] = first + repeats
            offset += length
        sequence += repeats
    rows.sort()
    return Slots(*(np.array(column, dtype=np.int64) for column in zip(*rows)))


def _place(batches: Iterator[pa.RecordBatch], where: Slots) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        length, rank = (batch.column(name).to_numpy() for name in ("length", "rank"))
        key = (length << _RANK_BITS) | rank
        at = np.searchsorted(where.key, key, side="right") - 1
        placed = [where.sequence[at] + key - where.key[at], where.offset[at]]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in names), *map(pa.array, placed)],
            names=[*names, "sequence_id", "offset"],
        )


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str,
    window: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` and ``ranks`` are files that every executor has. Null and empty texts give one
    piece, the closing id. Rows that repeat a doc_id, or have none, are documents of their own. An
    empty table gives no piece. Other columns are ignored. A text is encoded whole; the longest one
    must fit into a Python worker's memory.
    """
    source = docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`").cast("string"))
    pieces = cut(
        source.mapInArrow(lambda batches: _pieces(batches, tokenizer, ranks, window), PIECES), "pieces"
    )
    by_part = cut(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    histogram = by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(window + 1, dtype=np.int64)
    for row in histogram:
        counts[row["length"]] = row["n"]
    where = slots(plan(counts, window)) if histogram else Slots(*[np.zeros(1, np.int64)] * 3)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    offsets = by_part.select("part", "length", earlier)
    rank = F.col("nth") + F.col("before")
    ranked = pieces.join(offsets, ["part", "length"]).withColumn("rank", rank)
    return ranked.mapInArrow(
        lambda batches: _place(batches, where),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long",
    )
