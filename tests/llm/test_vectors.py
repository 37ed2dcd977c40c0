import numpy as np
import pytest

from starpipe.llm.vectors import near_vectors, train

SCHEMA = "vec_id long, label int, embedding array<float>, component_id string"


def brute(rows):
    parent = {i: i for i, _, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def fits(row):
        i, label, e = row
        return None not in (i, label, e) and all(x is not None and np.isfinite(x) for x in e) and any(e)

    links, groups = [0] * len(rows), {}
    for k, row in enumerate(rows):
        if fits(row):
            groups.setdefault((row[1], len(row[2])), []).append(k)
    for group in groups.values():
        x = np.array([rows[k][2] for k in group], np.float32).astype(float)
        norm = np.linalg.norm(x, axis=1)
        close = x @ x.T / np.outer(norm, norm) >= 0.98
        for i, j in zip(*np.nonzero(np.triu(close, 1))):
            a, b = group[i], group[j]
            links[a] += 1
            links[b] += 1
            one, other = root(rows[a][0]), root(rows[b][0])
            parent[max(one, other)] = min(one, other)
    return sorted((str(i), n, str(None if i is None else root(i))) for (i, _, _), n in zip(rows, links))


def got(frame):
    return sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in frame.collect())


@pytest.mark.parametrize("per_list", [30, 10_000])
def test_every_link_is_found(make, per_list):
    draw, rows = np.random.default_rng(3), []
    for _ in range(40):
        centre = draw.normal(size=24)
        for _ in range(draw.integers(1, 25)):
            rows.append((centre + draw.normal(size=24) * draw.choice([0.0, 0.1, 0.15, 0.2])) * draw.choice([1, 3]))
    rows = [(int(i), int(i % 3), [float(v) for v in np.float32(x)]) for i, x in zip(draw.permutation(len(rows)), rows)]
    rows = [(i, label % 2, x) for i, label, x in rows]
    assert sum(n for _, n, _ in brute(rows)) > 100
    assert got(near_vectors(make([(*r, "x") for r in rows], SCHEMA), per_list=per_list)) == brute(rows)


def test_edge_cases_have_defined_results(make):
    inf, nan = float("inf"), float("nan")
    rows = [(1, 1, [1.0, 0.0]), (2, 1, [2.0, 0.0]), (3, 1, [1.0, 0.0]), (3, 1, [0.0, 1.0]), (4, 2, [1.0, 0.0]),
            (5, None, [1.0, 0.0]), (6, 1, None), (7, 1, [0.0, 0.0]), (8, 1, [1.0, None]), (9, 1, [inf, 0.0]),
            (10, 1, [nan, 1.0]), (None, 1, [1.0, 0.0]), (11, 1, []), (12, 1, [1.0, 0.0, 0.0]), (13, 1, [0.0, 1.0]),
            (13, 1, [0.0, 1.0])]
    frame = make([(*r, "x") for r in rows], SCHEMA)
    assert got(near_vectors(frame)) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in near_vectors(frame).collect())
    assert near_vectors(make([], SCHEMA)).count() == 0


def test_codes_come_with_their_error():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(500, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = train(x, 8)
    home, visits = index.cells(x, 0.2)
    assert visits[np.arange(len(x)), home].all()
    for cell in range(8):
        own = x[home == cell]
        codes, error = index.encode(own, cell)
        rough = index.distances(x, cell, codes)
        exact = np.linalg.norm(x[:, None] - own[None], axis=2)
        assert (np.abs(rough - exact) <= error + 1e-9).all()
