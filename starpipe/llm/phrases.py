"""Collocations: frequent phrases of up to five words and how strongly their parts hang together.

Texts are cut once into blocks of one language: a dictionary of the block's words and the words as
numbers of it, and the blocks are dealt to groups. Then one round per phrase length:

* Rabin-Karp: prefix polynomials over the words' codes (themselves such polynomials over the words'
  bytes) give the fingerprint of every phrase of that length in a block by a subtraction; a group's
  are added up, and a shuffle aggregates them, with the groups they occur in as occurrence pointers.
* The fingerprints that are frequent go back to the groups that hold them, along the pointers that came
  with the counts: an array for each group and task, each fingerprint once. A phrase of the next length is fingerprinted only where both phrases one word shorter are frequent, which
  every frequent phrase satisfies. So what is shuffled shrinks from round to round.
* There, too, occurrences of a fingerprint are compared word by word, by the block's exact numbers, and
  only such phrases become text. They are counted again by text, so a collision of fingerprints
  can only let a rare phrase come that far, never change a count or lose a phrase.

Blocks are bucketed by group, so texts are shuffled once; a block's words fit in memory, its size
being bounded by ``BLOCK`` and the longest piece, and so do a group's counts, bounded by ``HELD``.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starpipe.llm.common import cut
from starpipe.workspace import new_path

#: What ends a piece, and what separates words inside one.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
SPACES = b" \t"
MOST_WORDS = 5
LEAST = 100
PERCENT = 100
TOP = 2000
NO_LANG = "und"
#: Bytes of text in a block, and in a group of blocks whose counts are added up before the shuffle.
BLOCK = 2 << 20
GROUP = 48 << 20
LEAST_GROUPS = 8
#: Distinct fingerprints that a group's counts may hold before they are handed on.
HELD = 5 << 20
#: Spark's own limit of buckets per table.
MOST_BUCKETS = 100_000
#: Parts in which a language's best phrases are looked for first.
PARTS = 64

#: Texts and blocks in an Arrow batch, and what keeps as few blocks in a reader's memory.
TEXTS = 1000
BATCH = 8
_SMALL_ROW_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "4"}

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_NORMAL = bytes.maketrans(BREAKS + SPACES + _UPPER, b"\n" * len(BREAKS) + b" " * len(SPACES) + _UPPER.lower())
_BASE = 0x9E3779B97F4A7C15
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

_BLOCKS = "lang string, bytes long, n long, words binary, ids binary"
_FOUND = "grp int, lang string, gram long, n long, phrase string"
_BACK = "grp int, grams array<long>"


class Polynomial:
    """Hashes of slices of a sequence of numbers, from one running sum (modulo 2 ** 64)."""

    def __init__(self, numbers: np.ndarray):
        size = len(numbers) + 1
        self.inverse = _powers(pow(_BASE, -1, 1 << 64), size)
        self.sums = np.zeros(size, np.uint64)
        np.cumsum(numbers * _powers(_BASE, size)[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[stops] - self.sums[starts]) * self.inverse[starts])


def _powers(base: int, size: int) -> np.ndarray:
    powers = np.full(size, base, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers)


def _mixed(x: np.ndarray) -> np.ndarray:
    for factor in _MIX:
        x = (x ^ (x >> np.uint64(30))) * factor
    return x ^ (x >> np.uint64(31))


def _slices(text: bytes) -> Iterator[bytes]:
    """A normalised text in slices of about a block, cut at ends of pieces only."""
    start = 0
    while len(text) - start > BLOCK:
        at = text.rfind(b"\n", start, start + BLOCK)
        at = text.find(b"\n", start + BLOCK) if at < 0 else at
        if at < 0:
            break
        yield text[start : at + 1]
        start = at + 1
    yield text[start:]


def _numbered(texts: list[bytes]) -> tuple[int, bytes, bytes]:
    """Words of normalised texts: how many, the distinct ones in order of their numbers from 1, and the
    sequence of numbers, 0 where a piece ends."""
    table = {b"\n": 0}
    number = table.setdefault
    joined = b"\n".join(texts).replace(b"\n", b" \n ")
    ids = np.array([number(word, len(table)) for word in joined.split(b" ") if word], np.uint32)
    ends = ids == 0
    if len(ids):
        ids = ids[~(ends & np.concatenate([[True], ends[:-1]]))]
    small = ids.astype(np.uint16) if len(table) <= 1 << 16 else ids
    return int(np.count_nonzero(ids)), b" ".join(list(table)[1:]), small.tobytes()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) in, blocks out."""
    held: dict[str, list[bytes]] = {}
    sizes: Counter = Counter()

    def block(lang: str) -> pa.RecordBatch:
        rows = [[lang], [sizes.pop(lang)], *([value] for value in _numbered(held.pop(lang)))]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(row, kind) for row, kind in zip(rows, kinds)], ["lang", "bytes", "n", "words", "ids"]
        )

    for batch in batches:
        langs, texts = batch.column(0), batch.column(1).cast(pa.binary())
        for lang, text in zip(langs.to_pylist(), texts):
            for part in _slices(text.as_py().translate(_NORMAL)):
                held.setdefault(lang, []).append(part)
                sizes[lang] += len(part) + 1
                if sizes[lang] >= BLOCK:
                    yield block(lang)
        while sizes.total() >= 4 * BLOCK:
            yield block(sizes.most_common(1)[0][0])
    for lang in list(held):
        yield block(lang)


class Block:
    """A block's words, and the fingerprints of its phrases."""

    def __init__(self, lang: str, words: bytes, ids: bytes):
        self.words = words.split(b" ") if words else []
        self.ids = np.frombuffer(ids, np.uint16 if len(self.words) < 1 << 16 else np.uint32)
        ends = np.cumsum([0, *(len(word) + 1 for word in self.words)])
        letters = Polynomial(np.frombuffer(words + b" ", np.uint8).astype(np.uint64) + np.uint64(1))
        codes = np.zeros(len(self.words) + 1, np.uint64)
        codes[1:] = letters.of(ends[:-1], ends[1:])
        seed = hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest()
        self.seed = np.frombuffer(seed, np.uint64)[0]
        self.sequence = Polynomial(codes[self.ids])
        self.piece = np.cumsum(self.ids == 0, dtype=np.int32)

    def places(self, size: int) -> np.ndarray:
        """Where phrases of that many words start: no end of a piece within."""
        count = max(len(self.ids) - size + 1, 0)
        inside = (self.piece[:count] == self.piece[size - 1 : size - 1 + count]) & (self.ids[:count] != 0)
        return np.flatnonzero(inside)

    def grams(self, places: np.ndarray, size: int) -> np.ndarray:
        salt = self.seed + np.uint64(size)
        return _mixed(self.sequence.of(places, places + size) ^ salt).view(np.int64)

    def texts(self, places: np.ndarray, grams: np.ndarray, size: int) -> Counter:
        """How often each phrase occurs at the places; equal fingerprints are compared word by word."""
        _, first, which, counts = np.unique(grams, return_index=True, return_inverse=True, return_counts=True)
        ids = [self.ids[places + j] for j in range(size)]
        found: Counter = Counter()
        if all((row == row[first][which]).all() for row in ids):
            keys, counts = [row[first].tolist() for row in ids], counts.tolist()
        else:
            tally = Counter(zip(*(row.tolist() for row in ids)))
            keys, counts = list(zip(*tally)), list(tally.values())
        for words, count in zip(zip(*keys), counts):
            found[b" ".join([self.words[word - 1] for word in words]).decode()] = count
        return found


class Tally:
    """Counts of one group of blocks: of fingerprints, and of phrases by language."""

    def __init__(self):
        self.group = None
        self._clear()

    def _clear(self) -> None:
        self.grams, self.counts, self.held = [], [], 0
        self.phrases: dict[str, Counter] = {}
        self.texts = 0

    def add_grams(self, grams: np.ndarray, counts: np.ndarray) -> None:
        self.grams.append(grams)
        self.counts.append(counts.astype(np.int32))
        self.held += len(grams)
        if self.held > HELD:
            self._merge()

    def add_phrases(self, lang: str, found: Counter) -> None:
        held = self.phrases.setdefault(lang, Counter())
        self.texts -= len(held)
        held.update(found)
        self.texts += len(held)

    def _merge(self) -> None:
        grams, counts = np.concatenate(self.grams), np.concatenate(self.counts)
        order = np.argsort(grams)
        grams, counts = grams[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        self.grams, self.counts = [grams[first]], [np.add.reduceat(counts, first)]
        self.held = len(first)

    def full(self) -> bool:
        return self.held > HELD * 3 // 4 or self.texts > HELD // 8

    def rows(self) -> Iterator[pa.RecordBatch]:
        """What was counted since the last time."""
        for lang, found in self.phrases.items():
            yield _rows(self.group, lang, None, list(found.values()), list(found))
        if self.grams:
            self._merge()
            for start in range(0, self.held, HELD // 8):
                some = slice(start, start + HELD // 8)
                yield _rows(self.group, None, self.grams[0][some], self.counts[0][some], None)
        self._clear()


def _round(size: int, most: int):
    """Rows of a round: texts of the frequent phrases one word shorter, then fingerprints of ``size`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, frequent = Tally(), np.zeros(0, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                group, lang, words, ids = (batch.column(c)[i].as_py() for c in range(4))
                if group != tally.group or tally.full():
                    yield from tally.rows()
                    if size > 1 and group != tally.group:
                        frequent = np.sort(batch.column(4)[i].values.to_numpy(zero_copy_only=False))
                    tally.group = group
                block = Block(lang, words, ids)
                places = block.places(size) if size <= most else np.zeros(0, np.int64)
                if size > 1:
                    shorter = block.places(size - 1)
                    grams = block.grams(shorter, size - 1)
                    hit = frequent[np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)] == grams
                    flags = np.zeros(len(block.ids) + 1, bool)
                    flags[shorter[hit]] = True
                    tally.add_phrases(lang, block.texts(shorter[hit], grams[hit], size - 1))
                    places = places[flags[places] & flags[places + 1]]
                if len(places):
                    tally.add_grams(*np.unique(block.grams(places, size), return_counts=True))
        yield from tally.rows()

    return run


def _frequent(least: int):
    """(gram, n, grp) ordered by gram in; out, for each group, those of its fingerprints that are frequent."""

    def back(grams: np.ndarray, counts: np.ndarray, groups: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        often = np.add.reduceat(counts, first) >= least
        hit = np.repeat(often, np.diff(np.append(first, len(grams))))
        grams, groups = grams[hit], groups[hit]
        if len(grams):
            order = np.argsort(groups, kind="stable")
            grams, groups = grams[order], groups[order]
            # A group that handed its counts on several times has a fingerprint as often.
            new = np.concatenate([[True], (grams[1:] != grams[:-1]) | (groups[1:] != groups[:-1])])
            grams, groups = grams[new], groups[new]
            first = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(grams)), pa.int32()), pa.array(grams))
            yield pa.RecordBatch.from_arrays([pa.array(groups[first], pa.int32()), lists], ["grp", "grams"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append([column.to_numpy() for column in batch.columns])
            size += batch.num_rows
            if size >= HELD // 8:
                columns = [np.concatenate(parts) for parts in zip(*held)]
                # The last fingerprint may have more rows.
                stop = int(np.searchsorted(columns[0], columns[0][-1]))
                if stop:
                    yield from back(*(column[:stop] for column in columns))
                held, size = [[column[stop:] for column in columns]], size - stop
        if size:
            yield from back(*(np.concatenate(parts) for parts in zip(*held)))

    return run


def _rows(group, lang, grams, counts, phrases) -> pa.RecordBatch:
    size = len(counts)
    arrays = [
        pa.repeat(pa.scalar(group, pa.int32()), size),
        pa.repeat(pa.scalar(lang, pa.string()), size),
        pa.nulls(size, pa.int64()) if grams is None else pa.array(grams, pa.int64()),
        pa.array(counts, pa.int64()),
        pa.nulls(size, pa.string()) if phrases is None else pa.array(phrases, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["grp", "lang", "gram", "n", "phrase"])


@contextmanager
def _few_rows_at_a_time(spark: SparkSession, rows: int):
    """Texts and blocks are large rows: fewer of them in a batch than of others."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def blocks_of(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The blocks in groups of about ``GROUP`` bytes, bucketed by group, so that rounds join them
    without an exchange."""
    spark = docs.sparkSession
    given = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    packed = given.mapInArrow(_pack, _BLOCKS).withColumn("block", F.monotonically_increasing_id())
    with _few_rows_at_a_time(spark, TEXTS):
        packed = cut(packed, "phrase-blocks")
    size = packed.agg(F.sum("bytes")).first()[0] or 0
    groups = min(max(-(-size // GROUP), LEAST_GROUPS), MOST_BUCKETS)
    dealt = packed.withColumn("grp", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
    name = f"phrase_blocks_{uuid.uuid4().hex}"
    writer = dealt.select("grp", "lang", "words", "ids", "n").repartition(groups, "grp").write
    writer = writer.options(path=new_path(spark, "phrase-groups"), **_SMALL_ROW_GROUPS)
    writer.bucketBy(groups, "grp").sortBy("grp").saveAsTable(name)
    return spark.table(name)


def frequent_phrases(blocks: DataFrame, least: int = LEAST, most: int = MOST_WORDS) -> DataFrame:
    """(lang, phrase, size, a): all phrases of 1 to ``most`` words that occur ``least`` times or more."""
    spark, given = blocks.sparkSession, ("grp", "lang", "words", "ids")
    source, texts = blocks.select(*given), []
    for size in range(1, most + 2):
        with _few_rows_at_a_time(spark, BATCH):
            path = new_path(spark, f"phrases-of-{size}")
            # Small row groups, so that counting them takes many small tasks.
            rows = source.mapInArrow(_round(size, most), _FOUND)
            rows.write.option("parquet.block.size", str(8 << 20)).parquet(path)
            found = spark.read.schema(rows.schema).parquet(path)
        if size > 1:
            texts.append(
                found.where("phrase IS NOT NULL").select("lang", "phrase", F.lit(size - 1).alias("size"), "n")
            )
        if size > most:
            break
        grams = found.where("gram IS NOT NULL").select("gram", "n", "grp")
        # Rows of a fingerprint meet once, with their groups: nothing is joined back to them.
        met = grams.repartition("gram").sortWithinPartitions("gram").mapInArrow(_frequent(least), _BACK)
        back = met.groupBy("grp").agg(F.flatten(F.collect_list("grams")).alias("grams"))
        source = blocks.select(*given).join(cut(back, f"frequent-of-{size}-by-group"), "grp")
    whole = texts[0]
    for more in texts[1:]:
        whole = whole.union(more)
    counted = whole.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("a"))
    return cut(counted.where(F.col("a") >= least), "frequent-phrases")


def _exact(column: Column) -> Column:
    return column.cast("decimal(18,0)")


def scored(phrases: DataFrame, totals: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases that no longer one accounts for.

    ``totals``: (lang, n). A longer phrase with 100 * f >= ``percent`` * a implies one that is just one
    word longer, since counts fall along the chain between the two, so only these are looked at. 1000 * a * n has at most 38 digits
    for counts below 10 ** 17, and a score is at most 1000 * n / ``least``.
    """
    many = phrases.where("size > 1").withColumn("words", F.split("phrase", " "))

    def part(start, length) -> Column:
        return F.array_join(F.slice("words", start, length), " ")

    longer = many.where("size > 2").select(
        "lang",
        F.explode(F.array(part(F.lit(1), F.col("size") - 1), part(F.lit(2), F.col("size") - 1))).alias("phrase"),
        "a",
    )
    longest = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    lone = many.join(longest, ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.col("longer") < percent * F.col("a"), F.lit(True))
    )
    cuts = lone.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        part(F.lit(1), F.col("k")).alias("first"),
        part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
    )
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    above = F.lit(1000).cast("decimal(4,0)") * _exact(F.col("a")) * F.col("n").cast("decimal(16,0)")
    score = F.call_function("div", above, _exact(F.col("l")) * _exact(F.col("r")))
    lowest = both.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    )
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def top_phrases(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language with their rank.

    The best of each of ``PARTS`` parts of a language come first, so no task sorts a whole language.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    best = found.withColumn("part", part)
    best = best.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    ranked = best.where(F.col("place") <= top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    )
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    percent: int = PERCENT,
    most: int = MOST_WORDS,
    top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``most`` words.

    A null language is ``und``. Null and empty texts have no words. Repeated rows count as often as
    they occur, ties go to the larger count, then to the smaller phrase in UTF-8 byte order. Other
    columns are ignored, whatever their names; an empty table gives an empty result.
    """
    blocks = blocks_of(docs, text, lang)
    totals = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    phrases = frequent_phrases(blocks, least, most)
    return top_phrases(scored(phrases, totals, percent), top)
