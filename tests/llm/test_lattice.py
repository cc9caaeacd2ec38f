import itertools

import numpy as np
import pytest

from tidemark.llm import lattice


def brute_e8(y):
    """Nearest of all lattice points near ``y``: whole or half coordinates with an even sum."""
    best = None
    for half in (0.0, 0.5):
        low = np.floor(y - half)
        for up in itertools.product((0, 1), repeat=8):
            p = low + np.array(up)
            if p.sum() % 2 == 0:
                d = ((y - p - half) ** 2).sum()
                if best is None or d < best:
                    best = d
    return best


def test_decoder_finds_the_nearest_point():
    y = np.random.default_rng(2).normal(size=(60, 8)) * 1.7
    found = lattice.nearest_e8(y)
    for v, p in zip(y, found):
        whole = np.abs(p - np.rint(p)).max() < 1e-9
        q = p if whole else p - 0.5
        assert q.sum() % 2 == 0 and np.abs(q - np.rint(q)).max() < 1e-9
        assert abs(((v - p) ** 2).sum() - brute_e8(v)) < 1e-9


def test_neighbours_are_the_240_shortest_points():
    near = lattice.e8_neighbours()
    assert near.shape == (240, 8) and np.allclose((near ** 2).sum(axis=1), 2)
    assert np.allclose(lattice.nearest_e8(near), near)


def near(rng, x, low, high):
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    c = rng.uniform(low, high, size=(len(x), 1))
    return c * x + np.sqrt(1 - c * c) * z


@pytest.mark.parametrize("classes", [4_000, 10 ** 6])
def test_recall_at_the_border(spark, classes):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = near(rng, x, 0.9005, 0.91)
    rows = [(i, v) for i, v in enumerate(np.concatenate([x, y]).tolist())]
    frame = lattice.classes_of(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    plan = lattice.plan_for(classes)
    assert lattice.cosine_links(frame, plan, 0.9).count() >= 0.97 * 1500 and plan.parts == (1 if classes == 4_000 else 2)


def test_operator_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(80, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    family = near(rng, np.repeat(x[:4], 30, axis=0), 0.93, 0.999)
    data = np.concatenate([x, family, family[:5], 3.0 * x[10:13]]).astype(np.float32).astype(float)
    rows = [(1000 - i, v, 0) for i, v in enumerate(data.tolist())]
    odd = [(2000, None, 1), (2001, [0.0] * 32, 1), (2002, [1.0] * 31 + [None], 1), (2003, [float("nan")] * 32, 1),
           (2004, [float("inf")] + [1.0] * 31, 1), (2005, data[0][:16].tolist(), 1), (2006, [], 1), (None, data[1].tolist(), 1)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, component_id int")
    got = {r["vec_id"]: tuple(r)[1:] for r in lattice.near_duplicates(frame).collect()}
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    part = np.array([r[0] for r in rows])
    for _ in range(len(rows)):
        nearest = np.minimum(part, np.where(linked, part[None], 10 ** 9).min(axis=1))
        if (nearest == part).all():
            break
        part = nearest
    want = {r[0]: (int(n), int(c), bool(c == r[0])) for r, n, c in zip(rows, linked.sum(axis=1), part)}
    assert {k: v for k, v in got.items() if k in want} == want
    for r in odd[:-1]:
        assert got[r[0]] == (0, r[0], True)
    assert got[None] == (0, None, False) and len(got) == len(rows) + len(odd)
    assert lattice.near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("classes", [300, 50_000, 10 ** 6, 10 ** 8, 10 ** 10])
def test_recall_of_the_plan_of_every_size(classes):
    """Pairs of cosine 0.9005 that share a cell of some table, in either direction."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1200, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = near(rng, x, 0.9005, 0.9005)
    plan = lattice.plan_for(classes)
    (own_x, look_x), (own_y, look_y) = lattice.cells_of(x, plan), lattice.cells_of(y, plan)
    met = (own_x == own_y) | (look_x == own_y[:, :, None]).any(axis=2) | (look_y == own_x[:, :, None]).any(axis=2)
    assert met.any(axis=1).mean() >= 0.98


def test_rows_of_a_vector_grow_slowly():
    rows = {10 ** e: lattice.plan_for(10 ** e).rows for e in range(2, 11)}
    assert rows[10 ** 6] < 100 and rows[10 ** 8] < 500 and rows[10 ** 10] < 1000
    assert all(rows[10 ** e] <= 3 * max(rows[10 ** (e - 1)], 10) for e in range(3, 11))


def test_looks_are_the_closest_neighbours():
    dots = np.random.default_rng(9).normal(size=(50, 240))
    assert (lattice._closest(dots, 5) == np.argsort(-dots, axis=1)[:, :5]).all() and lattice._closest(dots, 0).shape == (50, 0)


def test_a_dense_family_is_counted_without_its_pairs(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(60, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tight = near(rng, np.repeat(x[:1], 300, axis=0), 0.993, 0.997)
    border = near(rng, np.repeat(x[:1], 40, axis=0), 0.90, 0.93)  # linked to some members only
    data = np.concatenate([x, tight, border, tight[:20]])
    rows = [(i, v) for i, v in enumerate(data.tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    classes = lattice.with_balls(lattice.classes_of(frame), 0.9).cache()
    linked = data @ data.T / np.outer(*[np.linalg.norm(data, axis=1)] * 2) >= 0.9
    balls: dict[int, list[int]] = {}
    for rep, ball in classes.where("ball is not null").select("rep", "ball").collect():
        balls.setdefault(ball, []).append(rep)
    assert all(linked[np.ix_(m, m)].all() and len(m) > 1 for m in balls.values()) and max(map(len, balls.values())) >= 200
    np.fill_diagonal(linked, False)
    pairs = lattice.candidate_pairs(classes, lattice.plan_for(400), 0.9)
    assert pairs.count() < linked.sum() / 4
    got = {r["vec_id"]: r["n_links"] for r in lattice.near_duplicates(frame).collect()}
    want = linked.sum(axis=1)
    assert sum(got.values()) >= 0.995 * want.sum() and all(got[i] <= n for i, n in enumerate(want.tolist()))
