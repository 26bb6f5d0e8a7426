"""Clusters of similar vectors: a Gaussian mixture divides the space, links within its cells join clusters."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import isqrt
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .components import connected_components
from .vectors import Vectors, matrix


@dataclass
class Cells:
    """A second, finer mixture, started in the components of the first: unit means, log weights, one variance for all."""

    centre: np.ndarray
    weight: np.ndarray
    variance: float

    def densities(self, x: np.ndarray) -> np.ndarray:
        """Log of weight times density of each row in each cell, up to a constant."""
        return x.astype(np.float32) @ (self.centre.T / self.variance).astype(np.float32) + self.weight.astype(np.float32)

    def statistics(self, x: np.ndarray) -> np.ndarray:
        """Of each cell the weight and sum of its rows."""
        p = self.densities(x)
        p -= p.max(1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(1, keepdims=True)
        return np.concatenate([p.sum(0, dtype=np.float64), (p.T @ x.astype(np.float32)).ravel()])

    def moved(self, s: np.ndarray) -> Cells:
        c, d = self.centre.shape
        mass, total = s[:c], s[c:].reshape(c, d)
        far = 2 * (mass.sum() - (total * self.centre).sum())  # of unit vectors, half the squared distance is 1 less their product
        long = np.linalg.norm(total, axis=1, keepdims=True)
        centre = np.where(long > 1e-9, total / long.clip(1e-9), self.centre)
        return Cells(centre, np.log((mass + 1) / (mass + 1).sum()), max(far / mass.sum() / d, 1e-3 / d))


@dataclass
class Mixture:
    """A Gaussian mixture on standardised features reduced to their principal directions."""

    mean: np.ndarray
    project: np.ndarray
    weight: np.ndarray
    centre: np.ndarray
    cov: np.ndarray
    ridge: float
    covers: tuple[Cells, ...] = ()

    def features(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.project

    def densities(self, z: np.ndarray) -> np.ndarray:
        """Log of weight times density, for each component."""
        k, r = self.centre.shape
        out = np.empty((len(z), k))
        for i in range(k):
            low = np.linalg.cholesky(self.cov[i] + self.ridge * np.eye(r))
            y = (z - self.centre[i]) @ np.linalg.inv(low).T
            out[:, i] = np.log(self.weight[i].clip(1e-300)) - 0.5 * ((y**2).sum(1) + r * np.log(2 * np.pi)) - np.log(np.diag(low)).sum()
        return out

    def statistics(self, z: np.ndarray) -> np.ndarray:
        """Of each component the weight, sum and outer product of its rows; at last the log-likelihood and rows."""
        d = self.densities(z)
        top = d.max(1, keepdims=True)
        p = np.exp(d - top)
        total = p.sum(1, keepdims=True)
        p /= total
        outer = np.stack([y.T @ y for y in (z * np.sqrt(p[:, i : i + 1]) for i in range(p.shape[1]))])
        return np.concatenate([p.sum(0), (p.T @ z).ravel(), outer.ravel(), [float((top + np.log(total)).sum()), len(z)]])

    def updated(self, s: np.ndarray) -> Mixture:
        k, r = self.centre.shape
        n = s[:k].clip(1e-9)
        centre = s[k : k + k * r].reshape(k, r) / n[:, None]
        cov = s[k + k * r : k + k * r + k * r * r].reshape(k, r, r) / n[:, None, None] - np.einsum("ki,kj->kij", centre, centre)
        few = n < r + 1  # too few rows for a shape of its own
        cov[few] = np.eye(r) * max(self.ridge, 1e-3)
        return Mixture(self.mean, self.project, n / n.sum(), centre, (cov + cov.transpose(0, 2, 1)) / 2, self.ridge)

    def criterion(self, likelihood: float, rows: float) -> float:
        """Bayes' information criterion; less is better."""
        k, r = self.centre.shape
        return -2 * likelihood + (k * (1 + r + r * (r + 1) / 2) - 1) * np.log(max(rows, 2))


def _start(mean: np.ndarray, project: np.ndarray, k: int, ridge: float) -> Mixture:
    """Round components at quantiles of the principal directions, the widest first: a bit of a component's number each."""
    r, bits, number = project.shape[1], (k - 1).bit_length(), np.arange(k)
    centre = np.zeros((k, r))
    for i in range(min(r, bits)):
        own = range(i, bits, r)
        u = sum((number >> b & 1) / 2 ** (j + 1) for j, b in enumerate(own)) + 1 / 2 ** (len(own) + 1)
        centre[:, i] = [NormalDist().inv_cdf(x) for x in u]
    return Mixture(mean, project, np.full(k, 1 / k), centre, np.repeat(np.eye(r)[None], k, 0), ridge)


def _total(vectors: Vectors, model: object, of: Callable[[object, np.ndarray], np.ndarray], block: int = 8_192) -> np.ndarray:
    """The sum over all vectors of ``of(model, x)``, an array for the rows ``x``; Spark adds up ``block`` numbers at a time."""
    share = vectors.rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for b in batches:
            for a in range(0, len(b), 2_000):
                s = of(share.value, matrix(b["vec"].iloc[a : a + 2_000]))
                total = s if total is None else np.add(total, s, out=total)
        if total is not None:
            for a in range(0, len(total), block):
                yield pd.DataFrame({"block": [a // block], "v": [total[a : a + block].tobytes()]})

    def add(p: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": p["block"].iloc[:1], "v": [sum(np.frombuffer(v) for v in p["v"]).tobytes()]})

    got = vectors.rows.select("vec").mapInPandas(run, "block int, v binary").groupBy("block").applyInPandas(add, "block int, v binary").toPandas().sort_values("block")
    share.unpersist()
    return np.concatenate([np.frombuffer(v) for v in got["v"]])


def _mixture_statistics(tried: list[Mixture], x: np.ndarray) -> np.ndarray:
    z = tried[0].features(x)
    return np.concatenate([m.statistics(z) for m in tried])


def _component_sums(m: Mixture, x: np.ndarray) -> np.ndarray:
    main = m.densities(m.features(x)).argmax(1)
    total = np.zeros((len(m.weight), x.shape[1]))
    np.add.at(total, main, x)
    return np.concatenate([np.bincount(main, minlength=len(m.weight)), total.ravel()])


def _cell_statistics(covers: tuple[Cells, ...], x: np.ndarray) -> np.ndarray:
    some, total = max(1, 4_000_000 // max(len(c.weight) for c in covers)), 0.0
    for a in range(0, len(x), some):
        total = total + np.concatenate([c.statistics(x[a : a + some]) for c in covers])
    return total


def _steps(vectors: Vectors, tried: list[Mixture], steps: int) -> list[Mixture]:
    """Each mixture after steps of expectation-maximisation over all vectors, of which all of them share the scans."""
    for _ in range(steps if tried else 0):
        tried = [m.updated(s) for m, s in zip(tried, _split(tried, _total(vectors, tried, _mixture_statistics)))]
    return tried


def _split(tried: list[Mixture], s: np.ndarray) -> list[np.ndarray]:
    long = [m.weight.size + m.centre.size + m.cov.size + 2 for m in tried]
    return np.split(s, np.cumsum(long)[:-1])


def _cells(vectors: Vectors, m: Mixture, per_cell: int, covers: int, seed: int, steps: int = 4) -> tuple[Cells, ...]:
    """Spherical mixtures of one variance, of about a cell for ``per_cell`` vectors, ``covers`` times.

    Means start from the vectors that a hash of their ids picks, one of ``per_cell`` (of equal ones one), and in a
    component of ``m`` without any from the mean of all its vectors. They are then moved by expectation-maximisation over
    all vectors, responsibilities and all.
    """
    k, d = len(m.weight), vectors.dim
    s = _total(vectors, m, _component_sums)
    size, total = s[:k], s[k:].reshape(k, d)
    out = []
    for cover in range(covers):
        got = vectors.rows.where(F.pmod(F.xxhash64(F.lit(seed), F.lit(cover), "id"), F.lit(per_cell)) == 0).select("vec").distinct().toPandas()
        x = matrix(got["vec"]) if len(got) else np.zeros((0, d))
        lone = total[(size > 0) & (np.bincount(m.densities(m.features(x)).argmax(1), minlength=k) == 0)]
        x = np.concatenate([x, lone / np.linalg.norm(lone, axis=1, keepdims=True).clip(1e-9)])
        out.append(Cells(x[np.lexsort(x.T)], np.full(len(x), -np.log(len(x))), 0.5 / d))
    for _ in range(steps):
        s = np.split(_total(vectors, out, _cell_statistics), np.cumsum([c.centre.size + c.weight.size for c in out])[:-1])
        out = [c.moved(own) for c, own in zip(out, s)]
    return tuple(out)


def fit(
    vectors: Vectors, reduced: int = 32, components: tuple[int, ...] = (2, 4, 8, 16, 32), steps: int = 8, passes: int = 2, ridge: float = 0.05, per_cell: int | None = None, covers: int = 2, seed: int = 20260420
) -> Mixture:
    """Expectation-maximisation with regularised covariances; the number of components by BIC.

    Features are standardised and reduced by the moments of all vectors. All candidates start from quantiles of the
    principal directions, take ``steps`` steps over all vectors and are compared by BIC over all of them; the chosen
    mixture takes ``passes`` more. Spark adds up the statistics of a step, for all candidates in one scan. A second,
    spherical mixture of cells that start in its components is fitted to all vectors too, a cell for about ``per_cell``
    (100, for more than 20,000 vectors the root of half of them: work with cells and work within cells then both grow
    as the power 1.5 of the vectors). Cells are drawn ``covers`` times, so that a link that one set of cells cuts is
    left whole by another.
    """
    r = min(reduced, vectors.dim)
    scale = 1 / np.sqrt(np.diag(vectors.cov).clip(1e-12))
    value, vector = np.linalg.eigh(vectors.cov * np.outer(scale, scale))
    best = np.argsort(-value)[:r]
    project = scale[:, None] * vector[:, best] / np.sqrt(value[best].clip(1e-9))
    chosen = _start(vectors.mean, project, 1, ridge)
    if not vectors.n:
        return chosen
    # fewer rows than these are too few for so many shapes
    tried = _steps(vectors, [_start(vectors.mean, project, k, ridge) for k in components if k * 2 * (r + 1) <= vectors.n], steps)
    if tried:
        s = _split(tried, _total(vectors, tried, _mixture_statistics))
        chosen = min(zip(tried, s), key=lambda t: t[0].criterion(float(t[1][-2]), vectors.n))[0]
    chosen = _steps(vectors, [chosen], passes)[0]
    chosen.covers = _cells(vectors, chosen, per_cell or max(100, isqrt(vectors.n // 2)), covers, seed)
    return chosen


def assign(vectors: Vectors, mixture: Mixture, cell_margin: float = 8.0) -> DataFrame:
    """``vid``, ``part``, ``component``, ``main``, ``density``, ``vec``: the cells in which a vector is compared.

    A vector belongs, in each cover, to its likeliest cell and to each whose log density is within ``cell_margin`` of that
    one: to any number of them. So links across a border have a cell in common. ``main`` marks the likeliest cell, once a
    vector; its ``component`` is the likeliest of the mixture and ``density`` the log density there.
    """
    share = vectors.rows.sparkSession.sparkContext.broadcast(mixture)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = share.value
        for b in batches:
            for a in range(0, len(b), 500):
                p = b.iloc[a : a + 500]
                x = matrix(p["vec"])
                d = m.densities(m.features(x))
                top, before = d.max(1), 0
                for cells in m.covers:
                    s = cells.densities(x)
                    own = s.argmax(1)
                    i, k = np.nonzero(s >= s.max(1)[:, None] - cell_margin)
                    yield pd.DataFrame({"vid": p["vid"].to_numpy()[i], "part": (k + before).astype(np.int32), "component": d.argmax(1)[i].astype(np.int32), "main": (own[i] == k) & (before == 0), "density": top[i], "vec": p["vec"].to_numpy()[i]})
                    before += len(cells.weight)

    return vectors.rows.select("vid", "vec").mapInPandas(run, "vid long, part int, component int, main boolean, density double, vec array<float>")


def _unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the trees of each pair; the smaller root stays, all paths are short afterwards."""
    while len(i):
        p, q = parent[i], parent[j]
        differ = p != q
        i, j, p, q = i[differ], j[differ], p[differ], q[differ]
        np.minimum.at(parent, np.maximum(p, q), np.minimum(p, q))
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]


def forest(x: np.ndarray, least: float, block: int = 1_024, leaders: int = 48) -> np.ndarray:
    """The smallest row that each row is linked to, directly or through others.

    A few rows are first compared with all, which joins most of what is dense; then tile by tile, only
    pairs that aren't joined yet are looked at, and tiles of one and the same tree are passed over.
    """
    parent = np.arange(len(x))
    x32 = x.astype(np.float32)
    led = np.zeros(len(x), bool)
    for _ in range(leaders if len(x) > block // 4 else 0):
        free = np.flatnonzero(~led)
        if not len(free):
            break
        lead = free[len(free) // 2]
        near = np.flatnonzero(x32 @ x32[lead] >= least + 1e-5)
        led[near] = led[lead] = True
        _unite(parent, np.full(len(near), lead), near)
    order = np.argsort(parent, kind="stable")
    xs = x32[order]
    for a in range(0, len(x), block):
        for b in range(a, len(x), block):
            oa, ob = order[a : a + block], order[b : b + block]
            ra, rb = parent[oa], parent[ob]
            if (ra == ra[0]).all() and (rb == ra[0]).all():
                continue
            s = xs[a : a + block] @ xs[b : b + block].T
            i, j = np.nonzero((s >= least - 1e-5) & (ra[:, None] != rb))
            near = s[i, j]
            i, j = oa[i], ob[j]
            close = near < least + 1e-5
            if close.any():
                sure = ~close
                sure[close] = (x[i[close]] * x[j[close]]).sum(1) >= least
                i, j = i[sure], j[sure]
            _unite(parent, i, j)
    return parent


def linked(vectors: Vectors, assigned: DataFrame, least: float = 0.8, tile_rows: int = 6_000) -> DataFrame:
    """``vid`` and ``cluster``: the smallest vector that each is linked to by cosines of at least ``least``.

    Within each cell of the mixture all vectors are compared, in tiles: cells of more than ``tile_rows`` are
    split at random and every two splits meet in a task of their own, so no task holds more than two. A task
    returns one link a vector, a spanning forest; the links of all tiles are joined without the driver.
    Vectors without a link are in no row.
    """
    sizes = assigned.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.ceil(F.col("n") / tile_rows).cast("int").alias("splits"))
    split = F.pmod(F.xxhash64("vid"), F.col("splits")).cast("int")
    few = sizes.count() <= 1_000_000  # a row a cell
    rows = assigned.select("part", "vid", "vec").join(F.broadcast(sizes) if few else sizes, "part").withColumn("own", split)
    tiles = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
    tiles = tiles.where((F.col("splits") == 1) | (F.col("own") != F.col("other"))).select("part", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "vid", "vec")

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("vid")
        vid = p["vid"].to_numpy()
        root = forest(matrix(p["vec"]), least)
        on = root != np.arange(len(root))
        return pd.DataFrame({"a": vid[root[on]], "b": vid[on]})

    links = tiles.groupBy("part", "a", "b").applyInPandas(run, "a long, b long").distinct()
    return connected_components(links).select(F.col("node").alias("vid"), F.col("component").alias("cluster"))


def clusters(vectors: Vectors, least: float = 0.8, min_size: int = 3, mixture: Mixture | None = None, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """(members, assigned): ``id``, ``vid``, ``cluster``, ``first_id`` of clusters of ``min_size`` vectors or more.

    A Gaussian mixture (:func:`fit`) divides the vectors into overlapping cells; links of at least ``least``
    within the cells join them (:func:`linked`). A link whose ends share no cell is missed. ``exact`` compares all
    vectors in tiles of one cell, which misses none and takes as many comparisons as there are pairs. No vectors give
    no rows.
    """
    mixture = mixture or fit(vectors)
    assigned = cut(assign(vectors, mixture))
    found = cut(linked(vectors, vectors.rows.select(F.lit(0).alias("part"), "vid", "vec") if exact else assigned, least))
    large = found.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= min_size).select("cluster")
    ids = vectors.rows.select("vid", "id")
    members = found.join(large, "cluster", "left_semi").join(ids, "vid")
    first = ids.select(F.col("vid").alias("cluster"), F.col("id").alias("first_id"))
    return members.join(first, "cluster").select("id", "vid", "cluster", "first_id"), assigned


def described(members: DataFrame, assigned: DataFrame, labels: DataFrame, typical: int = 5) -> DataFrame:
    """One row a cluster: ``first_id``, ``size``, ``typical`` (ids of its densest members), ``component`` (the
    mixture's, of most members), ``topics`` (``labels`` id, topic: each topic with its members, most first)."""
    dense = members.join(assigned.where("main").select("vid", "component", "density"), "vid")
    rank = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("density"), "id"))
    size = dense.groupBy("cluster", "first_id").agg(F.count(F.lit(1)).alias("size"), F.mode("component", True).alias("component"))
    best = dense.withColumn("rn", rank).where(F.col("rn") <= typical).groupBy("cluster").agg(F.transform(F.sort_array(F.collect_list(F.struct("rn", "id"))), lambda s: s["id"]).alias("typical"))
    topics = dense.select("cluster", "id").join(labels.select("id", "topic").where("topic is not null").distinct(), "id").groupBy("cluster", "topic").agg(F.count(F.lit(1)).alias("n"))
    topics = topics.groupBy("cluster").agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "topic"))), lambda s: F.struct(s["topic"].alias("topic"), (-s["m"]).alias("n"))).alias("topics"))
    return size.join(best, "cluster").join(topics, "cluster", "left").select("first_id", "size", "component", "typical", "topics")
