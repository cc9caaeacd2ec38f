"""Embedding near-duplicates by E8 lattice hashing.

A vector of unit length is projected at random to eight dimensions, and the
nearest point of the lattice E8 names its cell. ``parts`` such points make the key
of one table; a vector is kept under its own cell and looked up in it and in the
cells of the neighbouring lattice points closest to it. Vectors that meet
are verified by cosine in double precision. Before that, 128 random signs that
each row carries rule out pairs far apart, inside the join.

Equal vectors are one class throughout. Of many designs (parts, scale, cells
looked up) `plan_for` takes the one that makes the fewest rows, stored and met by
chance, at the recall asked for; rows per vector grow slowly and without steps.

Dense families are counted, not paired: classes within half the angle of one
leader are a ball, in which any two are linked. Pairs are formed only across balls.
"""

from __future__ import annotations

import functools
import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle
from tidemark.llm.components import components

SIGNS = 128


def nearest_d8(y: np.ndarray) -> np.ndarray:
    """Nearest points of D8: whole numbers with an even sum."""
    whole = np.rint(y)
    rest = y - whole
    worst = np.abs(rest).argmax(axis=1)
    rows = np.arange(len(y))
    step = np.where(rest[rows, worst] >= 0, 1.0, -1.0)
    odd = whole.sum(axis=1) % 2 != 0
    whole[rows, worst] += np.where(odd, step, 0.0)
    return whole


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """Nearest points of E8: D8 and D8 moved by one half in every coordinate."""
    a, b = nearest_d8(y), nearest_d8(y - 0.5) + 0.5
    closer = ((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


def e8_neighbours() -> np.ndarray:
    """The 240 shortest points of E8."""
    whole = [v for v in itertools.product((-1, 0, 1), repeat=8) if sum(map(abs, v)) == 2]
    half = [v for v in itertools.product((-0.5, 0.5), repeat=8) if sum(v) % 2 == 0]
    return np.array(whole + half, dtype=np.float64)


@dataclass(frozen=True)
class Plan:
    """``parts`` lattice points in a key, ``tables``, ``scale`` of the projections, and the cells looked up.

    A look names for each part the own point (0) or its k-th closest neighbour.
    """

    parts: int
    tables: int
    scale: float
    looks: tuple[tuple[int, ...], ...] = ()

    @property
    def rows(self) -> int:
        """Rows of a vector in all tables: kept once, looked up in its own cell and the looks."""
        return self.tables * (2 + len(self.looks))


PAIRS, RANKS = 4000, 6  # pairs a design is tried with; neighbours of a part that may be looked up
SCALES = (0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.7, 0.8, 0.9)
MOST_PARTS = 5
SPREAD = 929 / 12960  # mean square of a coordinate within a cell of E8
#: Cost of a row met by chance, which is compared where it is, against a row that is shuffled.
COMPARED = 0.02


def _ranks(y: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of the cell of ``other`` among the neighbours of each row (0: the same, 99: none), and the mean mass of each rank."""
    near = e8_neighbours()
    point = nearest_e8(y)
    step = nearest_e8(other) - point
    dots = (y - point) @ near.T
    own = ((y - point) * step).sum(axis=1)
    rank = np.where((step ** 2).sum(axis=1) > 2.5, 99, 1 + (dots > own[:, None] + 1e-9).sum(axis=1))
    rank[(step ** 2).sum(axis=1) < 0.5] = 0
    some = dots[:500].argsort(axis=1)[:, ::-1][:, :RANKS]
    return rank, np.concatenate([point[:500, None], point[:500, None] + near[some]], axis=1)


@functools.lru_cache
def designs(cosine: float) -> tuple[tuple[int, float, tuple, float, float], ...]:
    """``parts, scale, looks, meet, chance`` of every design, tried with random pairs of exactly ``cosine``.

    ``meet``: share of pairs that meet in a table, less two standard deviations; ``chance``: that of unrelated vectors.
    Projections of unit vectors are normal variables with that correlation, whatever the dimensions.
    """
    draw = np.random.default_rng(23)
    out = []
    for scale in SCALES:
        ranks, masses = [], []
        width = scale ** 2 + SPREAD
        for _ in range(MOST_PARTS):
            a = draw.normal(size=(PAIRS, 8)) * scale
            b = cosine * a + math.sqrt(1 - cosine ** 2) * scale * draw.normal(size=(PAIRS, 8))
            (ab, points), (ba, _) = _ranks(a, b), _ranks(b, a)
            ranks.append((ab, ba))
            masses.append((np.exp(-(points ** 2).sum(axis=2) / (2 * width)) / (2 * math.pi * width) ** 4).mean(axis=0))
        rate = np.array([np.mean([ab == k for ab, _ in ranks]) for k in range(RANKS + 1)])
        mass = np.mean(masses, axis=0)
        for parts in range(1, MOST_PARTS + 1):
            every = [o for o in itertools.product(range(RANKS + 1), repeat=parts) if 0 < sum(v > 0 for v in o) <= 2]
            every.sort(key=lambda o: -math.prod(rate[v] for v in o))
            met = np.logical_and.reduce([ab == 0 for ab, _ in ranks[:parts]])
            found = 0
            for looks in (0, 2, 4, 6, 12):
                if looks > len(every):
                    break
                for o in every[found:looks]:
                    for side in (0, 1):
                        met |= np.logical_and.reduce([ranks[j][side] == v for j, v in enumerate(o)])
                found = looks
                share = float(met.mean())
                low = share - 2 * math.sqrt(share * (1 - share) / PAIRS)
                chance = sum(math.prod(mass[v] for v in o) for o in [(0,) * parts, *every[:looks]])
                if low > 0:
                    out.append((parts, scale, tuple(every[:looks]), low, float(chance)))
    return tuple(out)


def plan_for(classes: int, recall: float = 0.995, cosine: float = 0.9) -> Plan:
    """The design of fewest rows (stored, looked up and met by chance) with so many tables that ``recall`` is reached at ``cosine``."""
    best = None
    for parts, scale, looks, meet, chance in designs(cosine):
        plan = Plan(parts, max(1, math.ceil(math.log(1 - recall) / math.log1p(-min(meet, 1 - 1e-9)))), scale, looks)
        cost = plan.rows + COMPARED * classes * chance * plan.tables
        if best is None or cost < best[0]:
            best = cost, plan
    return best[1]


#: Cells in which the leaders of balls are sought: so small that unrelated vectors do not share one, whatever their number.
LEADERS = Plan(parts=3, tables=6, scale=0.8)


def _closest(dots: np.ndarray, ranks: int) -> np.ndarray:
    """The columns of the ``ranks`` largest numbers of each row, largest first."""
    if not ranks:
        return np.empty((len(dots), 0), dtype=np.int64)
    some = np.argpartition(-dots, ranks, axis=1)[:, :ranks]
    order = np.argsort(-np.take_along_axis(dots, some, axis=1), axis=1, kind="stable")
    return np.take_along_axis(some, order, axis=1)


def cells_of(x: np.ndarray, plan: Plan, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Cell keys of unit rows: own ones (rows x tables) and the neighbours to look up (rows x tables x looks)."""
    n, dims = x.shape
    near = e8_neighbours()
    draw = np.random.default_rng([seed, dims])
    odd = (draw.integers(1, 1 << 62, size=(plan.parts, 8), dtype=np.int64) * 2 + 1).astype(np.uint64)
    own = np.empty((n, plan.tables), dtype=np.uint64)
    ranks = max((v for o in plan.looks for v in o), default=0)
    looks = np.empty((n, plan.tables, len(plan.looks)), dtype=np.uint64)
    for t in range(plan.tables):
        hashes = []
        for part in range(plan.parts):
            y = x @ draw.normal(size=(dims, 8)) * plan.scale
            point = nearest_e8(y)
            points = np.concatenate([point[:, None], point[:, None] + near[_closest((y - point) @ near.T, ranks)]], axis=1)
            hashes.append(((points * 2).astype(np.int64).astype(np.uint64) * odd[part]).sum(axis=2, dtype=np.uint64))
        salt = np.uint64((t * 0x9E3779B97F4A7C15 + dims) & (2 ** 64 - 1))
        own[:, t] = sum(h[:, 0] for h in hashes) + salt
        for j, o in enumerate(plan.looks):
            looks[:, t, j] = sum(h[:, k] for h, k in zip(hashes, o)) + salt
    return own, looks


def classes_of(vectors: DataFrame) -> DataFrame:
    """``embedding, rep, n``: equal usable vectors, their smallest id and their number.

    Usable: has an id, has only finite components, and not only zeros.
    """
    def finite(v):
        d = v.cast("double")
        return d.isNotNull() & ~F.isnan(d) & (F.abs(d) != float("inf"))

    usable = vectors.where(F.col("vec_id").isNotNull() & F.forall("embedding", finite) & F.exists("embedding", lambda v: v != 0))
    return usable.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").cast("long").alias("n"))


def _rows(classes: DataFrame, plan: Plan, look: bool) -> DataFrame:
    """``cell, rep, s1, s2, ball`` and whether the cell is the ``own`` one, of every class: one row for each key.

    Columns begin with ``a`` for lookups, else with ``b``.
    """
    name = "a" if look else "b"
    names = ["cell", name, f"{name}1", f"{name}2", f"{name}_own", f"{name}_ball"]

    def run(batches):
        signs: dict[int, np.ndarray] = {}
        for batch in batches:
            reps = batch.column("rep").to_numpy()
            lists = batch.column("embedding")
            lengths = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.cumsum(lengths) - lengths
            for dims in np.unique(lengths).tolist():
                every = np.flatnonzero(lengths == dims)
                for some in np.array_split(every, max(1, len(every) // 512)):
                    x = flat[starts[some][:, None] + np.arange(dims)]
                    x = x / np.abs(x).max(axis=1, keepdims=True)
                    x = x / np.linalg.norm(x, axis=1, keepdims=True)
                    if dims not in signs:
                        signs[dims] = np.random.default_rng([17, dims]).normal(size=(dims, SIGNS))
                    packed = np.packbits(x @ signs[dims] > 0, axis=1).view(np.int64)
                    own, looks = cells_of(x, plan)
                    keys = np.concatenate([own[:, :, None], looks], axis=2) if look else own[:, :, None]
                    many = keys[0].size
                    first = np.zeros(keys.shape, dtype=bool)
                    first[:, :, 0] = True
                    columns = [keys.reshape(-1).view(np.int64), np.repeat(reps[some], many),
                               np.repeat(packed[:, 0], many), np.repeat(packed[:, 1], many), first.reshape(-1)]
                    ball = batch.column("ball").take(pa.array(np.repeat(some, many)))
                    yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), ball], names=names)

    return classes.select("rep", "embedding", "ball").mapInArrow(
        run, f"cell long, {name} long, {name}1 long, {name}2 long, {name}_own boolean, {name}_ball long")


def _near(a1: str, a2: str, b1: str, b2: str, cosine: float):
    """The signs of two vectors allow ``cosine``: passes all but 1 in 10^9 of true pairs (six deviations)."""
    p = math.acos(cosine) / math.pi
    apart = F.bit_count(F.col(a1).bitwiseXOR(F.col(b1))) + F.bit_count(F.col(a2).bitwiseXOR(F.col(b2)))
    return apart <= int(SIGNS * p + 6 * math.sqrt(SIGNS * p * (1 - p)))


def candidate_pairs(classes: DataFrame, plan: Plan, cosine: float) -> DataFrame:
    """``a, b`` (a < b): classes that meet in a cell, are not in one ball, and whose signs allow ``cosine``; every pair once.

    Members of balls meet each other only in cells that hold several balls, so
    that a family with a third of all rows makes no pairs of its own.
    """
    alone, dense = classes.where(F.col("ball").isNull()), classes.where(F.col("ball").isNotNull())
    both = (F.col("a") != F.col("b")) & (~F.col("a_own") | (F.col("a") < F.col("b"))) & _near("a1", "a2", "b1", "b2", cosine)
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    single = _rows(alone, plan, True).join(_rows(classes, plan, False).drop("b_own"), "cell").where(both).select(*ordered)
    border = _rows(dense, plan, True).join(_rows(alone, plan, False).drop("b_own"), "cell").where(both).select(*ordered)
    looked, kept = _rows(dense, plan, True), _rows(dense, plan, False).drop("b_own")
    meeting = looked.select("cell", "a_ball").distinct().join(kept.select("cell", "b_ball").distinct(), "cell").where(
        F.col("a_ball") != F.col("b_ball"))
    across = looked.join(meeting, ["cell", "a_ball"]).join(kept, ["cell", "b_ball"]).where(both).select(*ordered)
    return single.union(border).union(across).distinct()


def verified(pairs: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """The ``a, b`` of at least ``cosine``, computed in double precision."""
    left = classes.select(F.col("rep").alias("a"), F.col("embedding").alias("va"))
    right = classes.select(F.col("rep").alias("b"), F.col("embedding").alias("vb"))

    def verify(batches):
        def unit(column, lengths):
            x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lengths), -1)
            x = x / np.abs(x).max(axis=1, keepdims=True)
            return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]

        for batch in batches:
            size = [np.diff(batch.column(c).offsets.to_numpy()) for c in ("va", "vb")]
            good = np.zeros(batch.num_rows, dtype=bool)
            for dims in np.unique(size[0]).tolist():
                some = np.flatnonzero((size[0] == dims) & (size[1] == dims))
                if len(some):
                    part = batch.take(pa.array(some))
                    dots = np.einsum("ij,ij->i", unit(part.column("va"), some), unit(part.column("vb"), some))
                    good[some] = dots >= cosine
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "va", "vb").mapInArrow(verify, "a long, b long")


def with_balls(classes: DataFrame, cosine: float) -> DataFrame:
    """``classes`` with ``ball``: the smallest class found within half the angle of ``cosine``, null where no other class has the same.

    Any two classes of one ball are linked, as their angles to the leader add up
    to no more than that of ``cosine``. Leaders are smallest ids of small cells, passed
    on once within the cells, then verified. A family may be several balls.
    """
    half = math.cos(math.acos(cosine) / 2) + 1e-9
    rows = _rows(classes.withColumn("ball", F.lit(None).cast("long")), LEADERS, False).select("cell", "b", "b1", "b2")
    # a cell is dealt out in so many parts that each has some hundred rows
    shared = rows.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1").select("cell", F.expr("n div 256").alias("last"))
    rows = settle(rows.join(shared, "cell").withColumn("part", F.pmod(F.xxhash64("b"), F.col("last") + 1)), "leader-cells")
    label, found = rows, []
    for _ in range(2):  # the smallest label in a cell, then the smallest of the cells of a class
        labelled = rows.join(label.select("b", "label"), "b") if found else rows.withColumn("label", F.col("b"))
        low = labelled.groupBy("cell", "last").agg(F.min("label").alias("label"))
        low = low.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("part"), "label")
        label = settle(rows.join(low, ["cell", "part"]).groupBy("b").agg(
            F.first("b1").alias("b1"), F.first("b2").alias("b2"), F.min("label").alias("label")), "leaders")
        found.append(label)
    signs = rows.select(F.col("b").alias("a"), F.col("b1").alias("a1"), F.col("b2").alias("a2")).distinct()
    tried = found[0].union(found[1]).distinct().withColumnRenamed("label", "a").where(F.col("a") != F.col("b"))
    likely = tried.join(signs, "a").where(_near("a1", "a2", "b1", "b2", half)).select("a", "b")
    led = verified(likely, classes, half).select("b", F.col("a").alias("ball")).union(rows.select("b", "b").distinct())
    balls = settle(led.groupBy("b").agg(F.min("ball").alias("ball")), "balls")
    several = balls.groupBy("ball").agg(F.count("*").alias("members")).where("members > 1").select("ball")
    return classes.join(balls.join(several, "ball").select(F.col("b").alias("rep"), "ball"), "rep", "left")


def cosine_links(classes: DataFrame, plan: Plan, cosine: float) -> DataFrame:
    """``a, b`` (a < b): the candidate pairs of at least ``cosine``; within a ball (if ``classes`` has them) there are none."""
    if "ball" not in classes.columns:
        classes = classes.withColumn("ball", F.lit(None).cast("long"))
    return verified(candidate_pairs(classes, plan, cosine), classes, cosine)


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, recall: float = 0.995) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id, embedding``).

    ``n_links`` counts the other vectors linked directly, equal ones included;
    ``component_id`` is the smallest id reachable. Null and zero vectors, vectors
    with null or non-finite components and rows without an id link with
    nothing: no links, their own id. Vectors of different lengths do not link.
    Repeated rows are vectors that equal each other. An empty table gives no
    rows; other columns are not read.
    """
    classes = settle(classes_of(vectors.select("vec_id", "embedding")), "classes")
    classes = settle(with_balls(classes, cosine), "ball-classes")
    dense = classes.where(F.col("ball").isNotNull())
    spokes = dense.where(F.col("ball") != F.col("rep")).select(F.col("ball").alias("a"), F.col("rep").alias("b"))
    # a leader may be in another ball itself: then its spokes are links across balls
    homes = classes.select(F.col("rep").alias("a"), F.col("ball").alias("home"))
    strays = spokes.join(homes, "a").where(F.coalesce(F.col("home") != F.col("a"), F.lit(True))).select("a", "b")
    pairs = cosine_links(classes, plan_for(classes.count(), recall, cosine), cosine)
    links = settle(pairs.union(strays).distinct(), "cosine-links")
    both = links.union(links.select("b", "a"))
    outside = both.join(classes.select(F.col("rep").alias("b"), "n"), "b").groupBy("a").agg(F.sum("n").alias("outside"))
    inside = dense.groupBy("ball").agg(F.sum("n").alias("inside")).withColumnRenamed("ball", "of")
    pieces = components(links.union(spokes), "a", "b")
    facts = classes.join(outside, F.col("rep") == F.col("a"), "left").join(
        inside, F.col("ball") == F.col("of"), "left").join(pieces, F.col("rep") == F.col("node"), "left").select(
        F.col("embedding").alias("vector"), (F.coalesce("inside", "n") - 1 + F.coalesce("outside", F.lit(0))).alias("links"),
        F.coalesce("component", "rep").alias("piece"))
    usable = vectors.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("embedding")).alias("embedding"))
    rows = usable.join(facts, F.col("embedding") == F.col("vector"), "left")
    piece = F.coalesce("piece", "vec_id")
    return rows.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), piece.alias("component_id"),
                       F.coalesce(piece == F.col("vec_id"), F.lit(False)).alias("kept"))
