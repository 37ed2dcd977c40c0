"""Near-duplicate vectors by product quantisation over coarse inverted lists.

1. Equal vectors of a label are one class; the rest works on classes.
2. A bounded sample trains coarse centroids and, on the residuals, a codebook for each subspace.
3. Every vector is at home in the list of its nearest centroid and visits the lists that can hold a
   vector within the threshold's distance. That is decided exactly: lists are Voronoi cells, so a
   vector that is farther from the hyperplane between two centroids than the distance has no partner
   behind it. Of two lists only the vectors of the one visit the other.
4. Lists are dealt out by label, list and, where long, by blocks. A task holds one block's codes;
   asymmetric distances from tables of (subspace, code) leave the candidates, and since each code
   comes with its error, none is lost. The exact cosine decides.
5. Tasks report how many links each vector has, and of the links only as many as connect what is
   connected, so a large group of near copies costs its size and not its square in rows.

Probes are sufficient by construction: recall against brute force is 1, which the tests measure.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starpipe.llm.common import cut
from starpipe.llm.graph import components

COSINE = 0.98
#: Vectors that train centroids and codebooks: those with the smallest hashes.
SAMPLE = 20_000
#: A list for so many vectors, and at most so many lists.
PER_LIST = 800
MOST_LISTS = 256
SUBSPACES = 16
CODES = 16
#: Vectors of a block of a list, on average.
BLOCK = 1_024
#: Visitors compared at a time.
STRIP = 64
#: Slack for rounding in distances; candidates are decided exactly.
SLACK = 1e-6

_ASSIGNED = "rep long, label string, dims int, n long, embedding array<double>, cell int, visits array<int>"
_FOUND = "a long, b long, links long"


@dataclass(frozen=True)
class Index:
    """Centroids, and a codebook for each subspace (a range of dimensions)."""

    centroids: np.ndarray
    ranges: list[slice]
    codebooks: list[np.ndarray]

    @staticmethod
    def plain(dims: int) -> Index:
        """One list and one code: for dimensions that the sample doesn't have."""
        return Index(np.zeros((1, dims)), [slice(0, dims)], [np.zeros((1, dims))])

    def cells(self, x: np.ndarray, distance: float) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's list, and a table of the lists it must visit, its own included."""
        square = _squares(x, self.centroids)
        home = square.argmin(axis=1)
        own = square[np.arange(len(x)), home][:, None]
        between = np.sqrt(np.maximum(_squares(self.centroids, self.centroids), 0))[home]
        near = square - own <= 2 * (distance + SLACK) * between + SLACK
        visits = near & (np.arange(len(self.centroids)) <= home[:, None])
        return home, visits

    def encode(self, x: np.ndarray, cell: int) -> tuple[np.ndarray, np.ndarray]:
        """A code for each subspace, and how far the coded vector is from the vector."""
        residual = x - self.centroids[cell]
        codes = np.empty((len(x), len(self.ranges)), np.int64)
        error = np.zeros(len(x))
        for m, (at, book) in enumerate(zip(self.ranges, self.codebooks)):
            part = residual[:, at]
            codes[:, m] = _squares(part, book).argmin(axis=1)
            error += ((part - book[codes[:, m]]) ** 2).sum(axis=1)
        return codes, np.sqrt(error)

    def distances(self, x: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """From each vector to each coded one, by looking up the distances to the codes."""
        residual = x - self.centroids[cell]
        total = np.zeros((len(x), len(codes)))
        for m, (at, book) in enumerate(zip(self.ranges, self.codebooks)):
            total += _squares(residual[:, at], book)[:, codes[:, m]]
        return np.sqrt(np.maximum(total, 0))


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)


def _means(x: np.ndarray, count: int, rounds: int = 15) -> np.ndarray:
    """Centroids by Lloyd's rounds from evenly spaced rows."""
    count = min(count, len(x))
    centres = x[np.linspace(0, len(x) - 1, count).astype(int)].copy()
    for _ in range(rounds):
        nearest = _squares(x, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        size = np.bincount(nearest, minlength=count)
        full = size > 0
        centres[full] = sums[full] / size[full, None]
    return centres


def train(sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, codes: int = CODES) -> Index:
    """From unit vectors, one a row."""
    centroids = _means(sample, lists)
    residual = sample - centroids[_squares(sample, centroids).argmin(axis=1)]
    edges = np.linspace(0, sample.shape[1], min(subspaces, sample.shape[1]) + 1).astype(int)
    ranges = [slice(int(a), int(b)) for a, b in zip(edges, edges[1:])]
    return Index(centroids, ranges, [_means(residual[:, at], codes) for at in ranges])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1)[:, None]


def _matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _assign(
    batches: Iterator[pa.RecordBatch], indexes: dict[int, Index], distance: float
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims = batch.column("dims").to_numpy()
        for size in np.unique(dims):
            some = batch.filter(pa.array(dims == size))
            index = indexes.get(int(size)) or Index.plain(int(size))
            home, visits = index.cells(_unit(_matrix(some.column("embedding"), int(size))), distance)
            ends = np.concatenate(([0], np.cumsum(visits.sum(axis=1))))
            lists = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.nonzero(visits)[1], pa.int32())
            )
            yield pa.RecordBatch.from_arrays(
                [*some.columns, pa.array(home, pa.int32()), lists],
                names=[*some.schema.names, "cell", "visits"],
            )


class _Block:
    """The vectors at home in one block of a list, and what is known to connect them."""

    def __init__(self, index: Index, cell: int, dims: int):
        self.index, self.cell, self.dims = index, cell, dims
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, rep: np.ndarray, n: np.ndarray, x: np.ndarray) -> None:
        self.parts.append((rep, n, x))

    def close(self) -> None:
        self.rep, self.n, self.x = map(np.concatenate, zip(*self.parts))
        self.unit = _unit(self.x)
        self.codes, self.error = self.index.encode(self.unit, self.cell)
        self.root = np.arange(len(self.rep))
        self.links = np.zeros(len(self.rep), np.int64)

    def visit(
        self, rep: np.ndarray, n: np.ndarray, x: np.ndarray, own: np.ndarray, cosine: float, distance: float
    ) -> list[tuple[int, int | None, int]]:
        """Rows of (vector, connected with, links) from these visitors; those of the home later."""
        near = self.index.distances(_unit(x), self.cell, self.codes) <= distance + self.error + SLACK
        near &= ~own[:, None] | (self.rep[None, :] < rep[:, None])
        i, j = np.nonzero(near)
        dot = np.einsum("ij,ij->i", x[i], self.x[j])
        norms = np.linalg.norm(x, axis=1)[i] * np.linalg.norm(self.x, axis=1)[j]
        linked = dot / norms >= cosine
        i, j = i[linked], j[linked]
        np.add.at(self.links, j, n[i])
        rows: list[tuple[int, int | None, int]] = []
        for at, homes in zip(*_runs(i, j)):
            rows.append((int(rep[at]), int(self.rep[homes[0]]), int(self.n[homes].sum())))
            first, *others = np.unique(self.root[homes])
            for other in others:
                rows.append((int(self.rep[other]), int(self.rep[first]), 0))
                self.root[self.root == other] = first
        return rows

    def counts(self) -> list[tuple[int, int | None, int]]:
        some = np.flatnonzero(self.links)
        return [(int(r), None, int(k)) for r, k in zip(self.rep[some], self.links[some])]


def _runs(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct values of the ascending ``i``, and the ``j`` of each."""
    values, starts = np.unique(i, return_index=True)
    return values, np.split(j, starts[1:]) if len(values) else []


def _search(
    batches: Iterator[pa.RecordBatch], indexes: dict[int, Index], cosine: float, distance: float
) -> Iterator[pa.RecordBatch]:
    """Blocks come one after the other, each with its home first."""
    block, key, closed = None, None, False
    for batch in batches:
        rows: list[tuple[int, int | None, int]] = []
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("label", "dims", "cell", "salt", "visitor"))))
        cuts = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            *place, visitor = keys[start]
            if place != key:
                if closed:
                    rows += block.counts()
                key, closed = place, False
                dims = place[1]
                block = _Block(indexes.get(dims) or Index.plain(dims), place[2], dims)
            part = batch.slice(start, end - start)
            rep, n = part.column("rep").to_numpy(), part.column("n").to_numpy()
            x = _matrix(part.column("embedding"), block.dims)
            if not visitor:
                block.add(rep, n, x)
                continue
            if not closed:
                block.close()
                closed = True
            own = part.column("home").to_numpy() == block.cell
            for at in range(0, len(rep), STRIP):
                strip = slice(at, at + STRIP)
                rows += block.visit(rep[strip], n[strip], x[strip], own[strip], cosine, distance)
        yield _found(rows)
    if closed:
        yield _found(block.counts())


def _found(rows: list[tuple[int, int | None, int]]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays(
        [pa.array(column, pa.int64()) for column in columns], names=["a", "b", "links"]
    )


def _trained(classes: DataFrame, sample: int, per_list: int) -> dict[int, Index]:
    sizes = {row["dims"]: row["count"] for row in classes.groupBy("dims").count().collect()}
    rows = classes.select("rep", "dims", "embedding").orderBy(F.xxhash64("rep"), "rep").limit(sample)
    found = rows.select("dims", "embedding").toArrow()
    dims = found.column("dims").to_numpy()
    indexes = {}
    for size in np.unique(dims):
        some = found.filter(pa.array(dims == size)).column("embedding").combine_chunks()
        lists = max(1, min(MOST_LISTS, sizes[int(size)] // per_list))
        indexes[int(size)] = train(_unit(_matrix(some, int(size))), lists)
    return indexes


def near_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    sample: int = SAMPLE,
    per_list: int = PER_LIST,
) -> DataFrame:
    """vec_id, n_links, component_id, kept: a row for each row of ``vectors``.

    Vectors are compared if their labels are equal and not null and they have as many components.
    Null, empty and zero vectors, those with null or non-finite components and those without a
    vec_id link with nothing; their component is their own vec_id. Rows that repeat a vec_id are
    vectors of their own, linked like any two, in the component of that vec_id. Other columns are
    ignored; an empty table gives an empty result.
    """
    given = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
        F.col(f"`{label}`").cast("string").alias("label"),
        F.col(f"`{embedding}`").cast("array<double>").alias("embedding"),
    )
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    usable = F.coalesce(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & finite
        & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    valid = given.where(usable)
    classes = cut(
        valid.groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
        .withColumn("dims", F.size("embedding")),
        "vectors",
    )
    distance = float(np.sqrt(2 - 2 * cosine))
    indexes = _trained(classes, sample, per_list)
    assigned = cut(
        classes.select("rep", "label", "dims", "n", "embedding").mapInArrow(
            lambda batches: _assign(batches, indexes, distance), _ASSIGNED
        ),
        "lists",
    )
    place = ["label", "dims", "cell"]
    blocks = assigned.groupBy(*place).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocks = cut(blocks, "blocks")
    payload = ["rep", "n", "embedding"]
    home = assigned.join(blocks, place).select(
        *place,
        F.expr("cast(pmod(xxhash64(rep), blocks) as int)").alias("salt"),
        F.lit(False).alias("visitor"),
        F.col("cell").alias("home"),
        *payload,
    )
    visitors = (
        assigned.select("label", "dims", F.explode("visits").alias("at"), F.col("cell").alias("home"), *payload)
        .withColumnRenamed("at", "cell")
        .join(blocks, place)
        .select(
            *place,
            F.explode(F.expr("sequence(0, blocks - 1)")).alias("salt"),
            F.lit(True).alias("visitor"),
            "home",
            *payload,
        )
    )
    key = [*place, "salt"]
    found = cut(
        home.union(visitors)
        .repartition(*key)
        .sortWithinPartitions(*key, "visitor")
        .mapInArrow(lambda batches: _search(batches, indexes, cosine, distance), _FOUND),
        "vector-links",
    )
    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    members = valid.join(classes, ["label", "embedding"]).select("vec_id", "rep", "n")
    # A vec_id that several rows have connects their classes.
    shared = members.groupBy("vec_id").agg(F.min("rep").alias("first"))
    same = members.join(shared, "vec_id").where("rep <> first").select(F.col("rep").alias("a"), F.col("first").alias("b"))
    labels = components(found.where("b IS NOT NULL").select("a", "b").union(same))
    answered = (
        members.join(links, "rep", "left")
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "vec_id",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    alone = given.where(~usable).select("vec_id", F.lit(0).cast("long"), "vec_id")
    return answered.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
