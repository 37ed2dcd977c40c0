"""Exact Jaccard self-join of word n-gram sets by set-relation skipping.

**Index lists by position.** Sets are banded by size. For a band with largest size U, two sets that
reach the threshold differ in at most H(U) elements, so if the hash range is divided into more than
H(U) positions, they agree in at least one of them. Every set enters one list for each position of
its own band and of the band below: the list is named by band, position and the content of the set
there. Sets that differ at a position are in different lists, so whole blocks of the position's
index are skipped without being read, and passages that many documents share do not bring these
together: a list holds only sets that agree in all elements of a position.

A set with at most H differences from any partner enters H + 1 lists only, those of its fullest
positions (of equally full ones, of the smallest names), since positions with few elements agree too
easily. No link is lost: two linked sets agree in all positions but H of the one that enters up to the
fuller position, so in one that it enters, and the other enters all that come before its own last one.
So a band may be wide, and only sets near its lower end enter the band below, too.

**Answers from answers.** Equal sets are one class. In each list only the smallest member, its
leader, is compared with the others. Sets linked with the same leader are in one component, and
nothing more is asked of them.

Where the members of a leader's lists still lie in several components, they are dealt into blocks of
bounded size, and each pair of blocks is one group of rows (``cross_links``). A group keeps an index
from elements to the sets of one block. The answers of a pivot set, its overlaps with all sets of the
block, are counted from the index; those of a set that is highly similar to the pivot are derived from
them, by adding the lists of the elements it has beside the pivot's and subtracting the lists of those
it lacks. Only links leave the group, at most one for each two components it joins, so that the rows
grow with the sets and not with the square of a group.

A set also has the parities of its elements in 64 parts of the hash range. A difference of k elements
changes at most k of them, so pairs whose parities differ in more than linked sets can are skipped
before any element is looked at, in all of these steps. Larger linked sets may differ in as many of 64
parities as any two do; therefore the sets of the remaining pairs and blocks first meet with the
parities of a number of parts that grows with their size, 32 elements to a word at most, and only those
that these don't rule out with their elements.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starpipe.llm.common import columns, cut
from starpipe.llm.graph import components

WORDS = 4
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Words whose hashes a task remembers; a full memory is emptied.
CACHED_WORDS = 100_000
BATCH_ROWS = 100_000
#: Comparisons with one leader that one task makes at most, on average.
LEADER_ROWS = 2_000
#: Sets, and elements of them, that a block of a leader's members holds, on average.
BLOCK_ROWS, BLOCK_ELEMENTS = 2_000, 500_000
#: 64-bit words of parities that are compared before sets are, at least.
PARITY_WORDS = 32
#: A band's largest size, in hundredths of its smallest.
BAND_PERCENT = 200
#: 64-bit words of the filter of document ids (1 MB, whatever the corpus).
FILTER_WORDS = 1 << 17

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33, _S32 = np.uint64(33), np.uint64(32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S33)) * _M1
    x = (x ^ (x >> _S33)) * _M2
    return x ^ (x >> _S33)


class Shingles:
    """The sorted distinct 64-bit hashes of a text's word n-grams."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        # bytes.lower() and bytes.split() know ASCII letters and the six white-space characters only.
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        try:
            hashes = [known[word] for word in words]
        except KeyError:
            for word in set(words):
                if word not in known:
                    known[word] = xxhash.xxh64_intdigest(word)
            hashes = [known[word] for word in words]
        h = np.array(hashes, np.uint64)
        size = min(self.words, len(words))
        rows = len(h) - size + 1
        total = np.full(rows, size, np.uint64)
        for k in range(size):
            total = _mix(total * _M2 + h[k : k + rows])
        return np.unique(total)


def difference_bound(larger: int, smaller: int, percent: int) -> int:
    """Most elements in which linked sets of these sizes can differ."""
    return (100 - percent) * (larger + smaller) // (100 + percent)


class Bands:
    """Bands of set sizes: a set's partners are in its own band or a neighbouring one."""

    def __init__(self, percent: int):
        self.percent = percent
        self.first = [1]

    def of(self, size: int) -> int:
        while self.first[-1] <= size:
            low = self.first[-1]
            self.first.append(max(low * 100 // self.percent, low * BAND_PERCENT // 100) + 1)
        return int(np.searchsorted(self.first, size, side="right")) - 1

    @lru_cache(maxsize=None)  # noqa: B019  one object a task, some hundred bands
    def positions(self, band: int) -> tuple[int, int, int]:
        """Number of positions, how many need no list at least, most elements that differ."""
        last = self.first[band + 1] - 1
        bound = difference_bound(last * 100 // self.percent, last, self.percent)
        slack = bound * 15 // 100 + 3 if bound else 0
        return bound + 1 + slack, slack, bound

    def lists(self, hashes: np.ndarray) -> np.ndarray:
        """The names of the lists that a set enters."""
        size = len(hashes)
        own = self.of(size)
        names = [self._names(hashes, own, difference_bound(size * 100 // self.percent, size, self.percent))]
        below = self.first[own] - 1
        if own and 100 * below >= self.percent * size:
            names.append(self._names(hashes, own - 1, difference_bound(size, below, self.percent)))
        return np.concatenate(names)

    def _names(self, hashes: np.ndarray, band: int, bound: int) -> np.ndarray:
        """The fullest positions' names, one more than elements that can differ."""
        count = self.positions(band)[0]
        at = ((hashes >> _S32) * np.uint64(count)) >> _S32
        starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        content = np.add.reduceat(_mix(hashes + _M1), starts)
        position, size = at[starts], np.diff(starts, append=len(hashes))
        if len(position) <= bound:
            empty = np.setdiff1d(np.arange(count, dtype=np.uint64), position)
            position = np.concatenate((position, empty))
            content = np.concatenate((content, np.zeros(len(empty), np.uint64)))
            size = np.concatenate((size, np.zeros(len(empty), size.dtype)))
        names = _mix(content + _mix(position + (np.uint64(band) << _S32)))
        return names[np.lexsort((names, -size))[: bound + 1]]


def _heads(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    shingles = Shingles(words)
    for ids, texts in columns(batches):
        size, one, two, sketch = [], [], [], []
        for text in texts:
            hashes = shingles(text)
            size.append(len(hashes))
            one.append(int(_mix(hashes + _M1).sum(dtype=np.uint64).astype(np.int64)))
            two.append(int(_mix(hashes ^ _M2).sum(dtype=np.uint64).astype(np.int64)))
            sketch.append(int(_parities(hashes)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (ids, size, one, two, sketch)],
            names=["doc_id", "n_shingles", "one", "two", "sketch"],
        )


def _lists(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    shingles, bands = Shingles(words), Bands(percent)
    held: list[tuple[np.ndarray, ...]] = []
    rows = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(column)) for column in zip(*held)], names=["list", "doc_id"]
        )

    for doc_ids, texts in columns(batches):
        for doc_id, text in zip(doc_ids, texts):
            hashes = shingles(text)
            if not len(hashes):
                continue
            names = bands.lists(hashes)
            held.append((names.view(np.int64), np.full(len(names), doc_id, np.int64)))
            rows += len(names)
            if rows >= BATCH_ROWS:
                yield batch()
                held, rows = [], 0
    if rows:
        yield batch()


def _parities(hashes: np.ndarray) -> np.int64:
    """A bit for each 64th of the hash range: whether it has an odd number of elements."""
    odd = np.bincount((hashes >> np.uint64(58)).astype(np.int64), minlength=64) & 1
    return (odd.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64).astype(np.int64)


def _sketch(hashes: np.ndarray) -> np.ndarray:
    """Whether each part, named by the last bits of the hashes, has an odd number of elements."""
    words = PARITY_WORDS
    while 32 * words < len(hashes):
        words *= 2
    part = hashes & np.uint64(64 * words - 1)
    odd = np.bincount(part.astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _fold(parities: np.ndarray, words: int) -> np.ndarray:
    """The parities of fewer parts."""
    while parities.shape[-1] > words:
        half = parities.shape[-1] // 2
        parities = parities[..., :half] ^ parities[..., half:]
    return parities


def _changed(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """In how many parities sets differ, at most as many as elements."""
    words = min(one.shape[-1], other.shape[-1])
    return np.bitwise_count((_fold(one, words) ^ _fold(other, words)).view(np.uint64)).sum(axis=-1, dtype=np.int64)


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    shingles = Shingles(words)
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [shingles(text) for text in batch.column("text").to_pylist()]
        sketches = [_sketch(value) for value in values]
        lists = [
            pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *map(len, some)]), pa.int32()),
                pa.array(np.concatenate(some).view(np.int64), pa.int64()),
            )
            for some in (sketches, values)
        ]
        size = pa.array([len(value) for value in values], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), size, *lists], names=["doc_id", "n_shingles", "parities", "hashes"]
        )


class _Index:
    """From elements to the sets of a block that have them, and the overlaps of any set with these."""

    def __init__(self, sets: list[np.ndarray]):
        self.count = len(sets)
        elements = np.concatenate(sets)
        order = np.argsort(elements, kind="stable")
        self.elements = elements[order]
        self.owners = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])[order]
        self.pivot: np.ndarray | None = None
        self.answers = np.zeros(0, np.int64)

    def counts(self, elements: np.ndarray) -> np.ndarray:
        """How many of these elements each set has; lists of other elements aren't read."""
        first = np.searchsorted(self.elements, elements, side="left")
        sizes = np.searchsorted(self.elements, elements, side="right") - first
        ends = np.cumsum(sizes)
        rows = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + sizes, sizes)
        return np.bincount(self.owners[rows], minlength=self.count)

    def overlaps(self, own: np.ndarray) -> np.ndarray:
        """The overlaps of a set: derived from the pivot's, if these two differ in less than the half."""
        if self.pivot is not None:
            more = np.setdiff1d(own, self.pivot, assume_unique=True)
            less = np.setdiff1d(self.pivot, own, assume_unique=True)
            if 2 * (len(more) + len(less)) < len(own):
                return self.answers + self.counts(more) - self.counts(less)
        self.pivot, self.answers = own, self.counts(own)
        return self.answers


def _possible(table: pa.Table, percent: int) -> pa.Table:
    """The members of two blocks that sizes and parities allow a link with one of another component."""
    component, block, low, high, size = (
        table.column(name).to_numpy() for name in ("component", "block", "low", "high", "n_shingles")
    )
    parities = [x.values.to_numpy() for x in table.column("parities")]
    words = np.array([len(x) for x in parities])
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    alike = {}
    for n in np.unique(words[right]):
        rows = right[words[right] == n]
        alike[n] = rows, np.stack([parities[k] for k in rows])
    found = np.zeros(table.num_rows, bool)
    for k in left:
        for rows, theirs in alike.values():
            both = size[k] + size[rows]
            most = (100 - percent) * both // (100 + percent)
            near = np.flatnonzero((component[rows] != component[k]) & (np.abs(size[rows] - size[k]) <= most))
            near = near[_changed(theirs[near], parities[k]) <= most[near]]
            found[rows[near]] = True
            found[k] |= len(near) > 0
    return table.filter(pa.array(found)).drop_columns(["n_shingles", "parities"])


def _links(table: pa.Table, percent: int) -> pa.Table:
    """(a, b): links that join the components of two blocks' members, one for each two joined."""
    ids, component, block, low, high = (
        table.column(name).to_numpy() for name in ("doc_id", "component", "block", "low", "high")
    )
    sets = [x.values.to_numpy() for x in table.column("hashes")]
    # Sets that share their smallest hash follow each other: these are often highly similar.
    order = sorted(range(len(sets)), key=lambda k: (sets[k][0], len(sets[k]), ids[k]))
    left = np.array([k for k in order if block[k] == low[k]], np.int64)
    right = left if low[0] == high[0] else np.array([k for k in order if block[k] == high[k]], np.int64)
    a, b = [], []
    if len(left) and len(right):
        size = np.array([len(x) for x in sets], np.int64)
        parity = np.array([_parities(x.view(np.uint64)) for x in sets])
        index = _Index([sets[k] for k in right])
        label = component.copy()
        for k in left:
            both = size[k] + size[right]
            most = (100 - percent) * both // (100 + percent)
            open_ = (label[right] != label[k]) & (np.abs(size[right] - size[k]) <= most)
            open_ &= np.bitwise_count((parity[right] ^ parity[k]).view(np.uint64)) <= most
            if not open_.any():
                continue
            shared = index.overlaps(sets[k])
            linked = right[open_ & (100 * shared >= percent * (both - shared))]
            for other in linked:
                if label[other] != label[k]:
                    a.append(ids[k])
                    b.append(ids[other])
                    label[label == label[other]] = label[k]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _allowed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, parities = (
            [batch.column(side).field(name) for side in ("left", "right")] for name in ("n_shingles", "parities")
        )
        both = size[0].to_numpy() + size[1].to_numpy()
        changed = [_changed(*(side[i].values.to_numpy() for side in parities)) for i in range(batch.num_rows)]
        near = np.array(changed, np.int64) <= (100 - percent) * both // (100 + percent)
        yield batch.select(["a", "b", "lists"]).filter(pa.array(near))


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = (batch.column(name) for name in ("left", "right"))
        shared = [
            len(np.intersect1d(left[i].values.to_numpy(), right[i].values.to_numpy(), assume_unique=True))
            for i in range(batch.num_rows)
        ]
        union = [len(left[i]) + len(right[i]) - n for i, n in enumerate(shared)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(shared, pa.int64()), pa.array(union, pa.int64())],
            names=["a", "b", "shared", "union"],
        )


def _split(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents that are none of ``ids``, and those that may be.

    Each id sets a bit of ``FILTER_WORDS`` words, a broadcast of fixed size whatever the corpus. The
    first part needs no join with the ids, so its texts are not shuffled; the second is small as long
    as the ids are, and is to be joined exactly.
    """

    def word(h: Column) -> Column:
        return F.pmod(F.shiftrightunsigned(h, 6), F.lit(FILTER_WORDS)).cast("int")

    def bit(h: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(63).cast("int"))

    h = F.xxhash64("doc_id")
    bits = ids.groupBy(word(h).alias("word")).agg(F.bit_or(bit(h)).alias("bits"))
    # The rows travel as one struct, so that no column of theirs meets one of this function's.
    rows = docs.select(F.xxhash64(F.col("doc_id").cast("long")).alias("h"), F.struct("*").alias("given"))
    joined = rows.withColumn("word", word(F.col("h"))).join(F.broadcast(bits), "word", "left")
    marked = F.coalesce(F.col("bits").bitwiseAND(bit(F.col("h"))) != 0, F.lit(False))
    return joined.where(~marked).select("given.*"), joined.where(marked).select("given.*")


class Join:
    """The steps of the join over one table of documents (doc_id, text)."""

    def __init__(self, docs: DataFrame, words: int, percent: int):
        self.all, self.words, self.percent = docs, words, percent
        self.docs = docs.where("doc_id IS NOT NULL")

    def heads(self) -> DataFrame:
        """(doc_id, n_shingles, rep, sketch) for each row: rep is the smallest doc_id with an equal set."""
        words = self.words
        heads = cut(
            self.all.mapInArrow(
                lambda batches: _heads(batches, words),
                "doc_id long, n_shingles long, one long, two long, sketch long",
            ),
            "heads",
        )
        content = ["one", "two", "n_shingles"]
        full = heads.where("doc_id IS NOT NULL AND n_shingles > 0")
        classes = full.groupBy(*content).agg(F.min("doc_id").alias("rep"))
        alone = heads.where("doc_id IS NULL OR n_shingles = 0")
        return cut(
            full.join(classes, content)
            .select("doc_id", "n_shingles", "rep", "sketch")
            .union(alone.select("doc_id", "n_shingles", "doc_id", "sketch")),
            "classes",
        )

    def lists(self, heads: DataFrame) -> DataFrame:
        """A row for every representative in a list but its leader, the smallest: list, doc_id,
        leader, and n, for lists with the same members are one."""
        words, percent = self.words, self.percent
        full = heads.where("doc_id IS NOT NULL AND n_shingles > 0")
        copies = full.where("doc_id <> rep").select("doc_id")
        reps = full.where("doc_id = rep").select("doc_id").distinct()
        own, others = _split(self.docs, copies)
        # Of the texts that the filter takes for copies', only possible representatives' are shuffled.
        _, others = _split(others, _split(reps, copies)[1])
        chosen = own.union(others.join(reps, "doc_id", "left_semi").select("doc_id", "text"))
        entries = chosen.mapInArrow(
            lambda batches: _lists(batches, words, percent),
            "list long, doc_id long",
        )
        members = "OVER (PARTITION BY list)"
        led = entries.select(
            "doc_id",
            F.expr(f"min(doc_id) {members}").alias("leader"),
            F.expr(f"bit_xor(xxhash64(doc_id)) {members}").alias("list"),
        )
        rest = led.where("doc_id <> leader")
        return cut(rest.groupBy("list", "doc_id", "leader").agg(F.count("*").alias("n")), "lists")

    def sets(self, ids: DataFrame) -> DataFrame:
        """(doc_id, n_shingles, parities, hashes) of these documents and perhaps others, read once more;
        nothing is shuffled."""
        words = self.words
        _, some = _split(self.docs, ids)
        return some.mapInArrow(
            lambda batches: _sets(batches, words),
            "doc_id long, n_shingles long, parities array<long>, hashes array<long>",
        )


def _beside(pairs: DataFrame, sets: DataFrame, content: str) -> DataFrame:
    """The pairs (a, b) with what the sets hold as left and right; a may lead very many of them."""
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / LEADER_ROWS).cast("int").alias("salts"))
    salted = pairs.join(salts, "a").withColumn("salt", F.expr("cast(pmod(xxhash64(b), salts) as int)"))
    # Sets that are of no pair aren't shuffled, but for the few that the filter lets through.
    held = sets.select("doc_id", F.expr(content).alias("held"))
    leaders = (
        _split(held, _named(pairs, "a"))[1]
        .withColumnsRenamed({"doc_id": "a", "held": "left"})
        .join(salts, "a")
        .withColumn("salt", F.explode(F.expr("sequence(0, salts - 1)")))
        .drop("salts")
    )
    members = _split(held, _named(pairs, "b"))[1].withColumnsRenamed({"doc_id": "b", "held": "right"})
    return salted.drop("salts").join(members, "b").join(leaders, ["a", "salt"]).drop("salt")


def _near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes and parities allow a link."""
    met = _beside(pairs, sets, "struct(n_shingles, parities)")
    near = met.mapInArrow(lambda batches: _allowed(batches, percent), "a long, b long, lists long")
    # A doc_id that occurs with several texts has several sets; one that may be linked is enough.
    return near.dropDuplicates(["a", "b"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, shared, union) for pairs (a, b)."""
    joined = _beside(pairs.select("a", "b"), sets, "hashes")
    measured = joined.select("a", "b", "left", "right").mapInArrow(
        _common, "a long, b long, shared long, union long"
    )
    # A doc_id that occurs with several texts has several sets: the most similar ones count.
    best = F.max_by(F.struct("shared", "union"), F.col("shared") / F.col("union")).alias("best")
    return cut(measured.groupBy("a", "b").agg(best).select("a", "b", "best.*"), "verified")


def similar_sets(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """doc_id, n_shingles, component_id: a row for each row of ``docs``.

    A set holds the distinct n-grams of the text's words, A-Z lower-cased; with fewer words, the
    whole sequence is its only element. Null texts and texts without words have empty sets, which
    are linked with nothing; their component is their own doc_id. A null doc_id is linked with
    nothing and has a null component. Rows that repeat a doc_id are one document with several
    texts: what any of them links with belongs to its component. Other columns are ignored. An
    empty table gives an empty result.
    """
    join = Join(
        docs.select(
            F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
            F.col(f"`{text}`").cast("string").alias("text"),
        ),
        words,
        percent,
    )
    heads = join.heads()
    full = heads.where("doc_id IS NOT NULL AND n_shingles > 0")
    labels = _labels(join, full, join.lists(heads), percent)
    found = heads.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    return found.select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )


def _labels(join: Join, full: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the representatives that are linked with others."""
    same_id = full.groupBy("doc_id").agg(F.min("rep").alias("a"))
    repeated = full.join(same_id, "doc_id").where("rep <> a").select("a", F.col("rep").alias("b"))
    one_sketch = F.when(F.min("sketch") == F.max("sketch"), F.min("sketch"))
    sizes = full.where("doc_id = rep").groupBy("doc_id").agg(
        F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"), one_sketch.alias("sketch")
    )
    sizes = cut(sizes, "sizes")
    pairs = cut(_leader_pairs(lists, sizes, percent), "pairs")
    sets = cut(join.sets(_named(pairs, "a").union(_named(pairs, "b")).distinct()), "sets")
    pairs = cut(_near(pairs, sets, percent), "near")

    link = F.expr(f"100 * shared >= {percent} * union")
    # Each set is compared with the leader it shares most lists with; then with the other leaders,
    # unless these answers connect them already.
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("lists", -F.col("a"))).alias("a"))
    first = _verified(best, sets)
    links = repeated.union(first.where(link).select("a", "b"))
    labels = components(links)
    rest = cut(_apart(pairs.join(first, ["a", "b"], "left_anti").select("a", "b"), labels), "rest")
    if not rest.isEmpty():
        second = _verified(rest, sets)
        links = links.union(second.where(link).select("a", "b"))
        labels = components(links)
    crossing = cut(cross_links(join, lists, labels, sizes, percent), "cross")
    if crossing.isEmpty():
        return labels
    return components(links.union(crossing))


def _named(pairs: DataFrame, side: str) -> DataFrame:
    return pairs.select(F.col(side).alias("doc_id")).distinct()


def _leader_pairs(lists: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(a, b, lists): leaders and members whose sizes and sketches allow a link, and how many lists they share."""
    shared = lists.groupBy(F.col("leader").alias("a"), F.col("doc_id").alias("b")).agg(F.sum("n").alias("lists"))
    leader = sizes.select(*(F.col(name).alias(f"a_{name}") for name in sizes.columns))
    member = sizes.select(*(F.col(name).alias(f"b_{name}") for name in sizes.columns))
    bound = f"{100 - percent} * (a_most + b_most) div {100 + percent}"
    # A document with several texts has no sketch of its own.
    near = F.expr(
        f"100 * b_most >= {percent} * a_least AND 100 * a_most >= {percent} * b_least"
        f" AND coalesce(bit_count(a_sketch ^ b_sketch) <= {bound}, true)"
    )
    joined = shared.join(member, F.col("b") == F.col("b_doc_id")).join(leader, F.col("a") == F.col("a_doc_id"))
    return joined.where(near).select("a", "b", "lists")


def _labelled(df: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    joined = df.join(labels.withColumnsRenamed({"node": node, "component": name}), node, "left")
    return joined.withColumn(name, F.coalesce(name, node))


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    both = _labelled(_labelled(pairs, labels, "a", "ca"), labels, "b", "cb")
    return both.where("ca <> cb").select("a", "b")


def cross_links(join: Join, lists: DataFrame, labels: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(a, b): links of members of a leader's lists, other than with the leader, across components.

    Members of a leader are dealt into blocks, so that no group of rows grows with their number; a
    member goes with each block once.
    """
    entries = _labelled(lists.select("list", "leader", "doc_id"), labels, "doc_id", "component")
    # Lists whose members besides the leader lie in several components.
    several = (
        entries.groupBy("list")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("list")
    )
    members = cut(
        entries.join(several, "list", "left_semi")
        .groupBy("leader", "doc_id")
        .agg(F.min("component").alias("component"))
        .join(sizes.select("doc_id", "most"), "doc_id"),
        "members",
    )
    blocks = members.groupBy("leader").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("most") / BLOCK_ELEMENTS)).cast("int").alias("blocks")
    )
    keys = ["leader", "low", "high"]
    dealt = (
        members.drop("most")
        .join(blocks, "leader")
        .withColumn("block", F.expr("cast(pmod(xxhash64(doc_id, leader), blocks) as int)"))
        .join(join.sets(members.select("doc_id").distinct()).drop("hashes"), "doc_id")
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .select(*keys, "doc_id", "component", "block", "n_shingles", "parities")
    )
    possible = dealt.groupBy(*keys).applyInArrow(
        lambda table: _possible(table, percent),
        "leader long, low int, high int, doc_id long, component long, block int",
    )
    possible = cut(possible.distinct(), "possible")
    sets = join.sets(possible.select("doc_id").distinct()).select("doc_id", "hashes")
    return possible.join(sets, "doc_id").groupBy(*keys).applyInArrow(
        lambda table: _links(table, percent), "a long, b long"
    )


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others) whose doc_id is its component's smallest.

    Of rows that repeat a doc_id the one with the smallest text stays. Rows without a doc_id, and
    documents without words, stay. Texts are shuffled only for documents that go or are repeated.
    """
    found = cut(similar_sets(docs, words=words, percent=percent), "components")
    counted = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("component_id").alias("component"), F.count("*").alias("rows")
    )
    special = counted.where("component <> doc_id OR rows > 1")
    clear, rest = _split(docs, special.select("doc_id"))
    # Of the texts that the filter takes for special ones, those of documents that surely go aren't shuffled.
    staying = found.where("doc_id IS NULL OR component_id = doc_id").select("doc_id").distinct()
    _, rest = _split(rest, _split(staying, special.select("doc_id"))[1])
    rows = rest.select(F.col("doc_id").cast("long").alias("id"), F.struct("*").alias("given"))
    decided = rows.join(special.withColumnRenamed("doc_id", "id"), "id", "left")
    single = decided.where("component IS NULL").select("given.*")
    repeated = (
        decided.where("component = id")
        .groupBy("id")
        .agg(F.min_by("given", F.coalesce(F.col("given.text").cast("string"), F.lit(""))).alias("given"))
        .select("given.*")
    )
    return clear.union(single).union(repeated)
