"""The most similar vectors of every vector, by windows on shifted Hilbert curves."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log10

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .vectors import Vectors, matrix


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points of whole coordinates below 2**bits (Skilling, 2004)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            t = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[n - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def top_of_windows(x: np.ndarray, vid: np.ndarray, k: int, window: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows in order, the k most similar within ``window`` places: (row, row of neighbour, cosine).

    Ties go to the smaller vid; the choice is made in single precision with room for its error, the result
    in double.
    """
    x32 = x.astype(np.float32)
    out_a, out_b, out_s = [], [], []
    step = 256
    for a in range(0, len(x), step):
        b = min(len(x), a + step)
        lo, hi = max(0, a - window), min(len(x), b + window)
        s = x32[a:b] @ x32[lo:hi].T
        away = np.abs(np.arange(a, b)[:, None] - np.arange(lo, hi))
        s[(away > window) | (away == 0)] = -2
        kth = np.partition(s, max(0, s.shape[1] - k), axis=1)[:, max(0, s.shape[1] - k)]
        i, j = np.nonzero((s >= np.maximum(kth - 1e-5, least - 1e-5)[:, None]) & (s > -1.5))
        i, j = i + a, j + lo
        exact = (x[i] * x[j]).sum(1)
        order = np.lexsort((vid[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        keep = (place < k) & (exact >= least)
        out_a.append(i[keep])
        out_b.append(j[keep])
        out_s.append(exact[keep])
    return np.concatenate(out_a), np.concatenate(out_b), np.concatenate(out_s)


def equal_groups(vectors: Vectors) -> DataFrame:
    """``vid``, ``rep`` and ``self`` of each vector that equals another once of unit length.

    ``rep`` is the smallest vid of those equal to it, ``self`` their cosine as the other cosines are computed.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = matrix(b["vec"]) + 0.0  # no negative zeros
            h = np.array([xxhash.xxh3_128_digest(r.tobytes()) for r in x], "S16").view(np.int64).reshape(-1, 2) if len(x) else np.zeros((0, 2), np.int64)
            yield pd.DataFrame({"vid": b["vid"], "h1": h[:, 0], "h2": h[:, 1], "self": (x * x).sum(1)})

    hashed = vectors.rows.select("vid", "vec").mapInPandas(run, "vid long, h1 long, h2 long, self double")
    groups = hashed.groupBy("h1", "h2").agg(F.min("vid").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return hashed.join(groups, ["h1", "h2"]).select("vid", "rep", "self")


def expand(found: DataFrame, equal: DataFrame, k: int, least: float) -> DataFrame:
    """What ``nearest`` finds for representatives, for each vector and among all: exact by cosine, then vid.

    A vector among the ``k`` nearest of another has a representative among the ``k`` nearest ones or the
    other's own, and of each group the ``k`` + 1 smallest vids are all that can be chosen.
    """
    by_vid = Window.partitionBy("rep").orderBy("vid")
    few = equal.withColumn("nth", F.row_number().over(by_vid)).where(F.col("nth") <= k + 1)
    few = cut(few.groupBy("rep").agg(F.sort_array(F.collect_list("vid")).alias("same"), F.first("self").alias("self")))
    others = few.select(F.col("rep").alias("neighbour"), "same")
    wide = found.join(others, "neighbour", "left").select("vid", "cosine", F.explode(F.coalesce("same", F.array("neighbour"))).alias("neighbour"))
    own = few.where(F.col("self") >= least).select(F.col("rep").alias("vid"), F.col("self").alias("cosine"), F.explode("same").alias("neighbour"))
    # at most (k + 1) ** 2 for each representative
    lists = wide.unionByName(own).groupBy("vid").agg(F.sort_array(F.collect_list(F.struct((-F.col("cosine")).alias("far"), "neighbour"))).alias("best"))
    single = lists.join(equal, "vid", "left_anti").select("vid", "best")
    many = equal.select("vid", "rep").join(lists.withColumnRenamed("vid", "rep"), "rep").select("vid", "best")
    best = single.unionByName(many).select("vid", F.slice(F.filter("best", lambda b: b["neighbour"] != F.col("vid")), 1, k).alias("best"))
    return _ranked(best)


def _ranked(best: DataFrame) -> DataFrame:
    return best.select("vid", F.posexplode("best").alias("rank", "b")).select("vid", (F.col("rank") + 1).alias("rank"), F.col("b.neighbour").alias("neighbour"), (-F.col("b.far")).alias("cosine"))


def orderings(n: int) -> int:
    """Curves for ``n`` vectors: 12, and four more for each tenfold beyond 100,000, since a window of fixed length
    covers less and less of a curve."""
    return 12 + max(0, ceil(4 * log10(max(n, 1) / 100_000)))


def exact_nearest(vectors: Vectors, queries: DataFrame, k: int = 5, least: float = -1.0, most: int = 50_000) -> DataFrame:
    """``vid``, ``rank``, ``neighbour``, ``cosine`` as :func:`nearest` has them, without a miss, for stated queries.

    ``queries`` (vid, vec), no more than ``most`` (more are an error), meet all vectors; each task keeps the ``k`` best of
    each query.
    """
    asked = queries.select("vid", "vec").limit(most + 1).toPandas()
    if len(asked) > most:
        raise ValueError(f"more than {most} queries")
    share = vectors.rows.sparkSession.sparkContext.broadcast((matrix(asked["vec"]), asked["vid"].to_numpy(np.int64)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q, own = share.value
        best: list[pd.DataFrame] = []
        for b in batches:
            x, vid = matrix(b["vec"]), b["vid"].to_numpy()
            for a in range(0, len(q), 512):
                s = q[a : a + 512] @ x.T
                s[own[a : a + 512, None] == vid] = -2
                kth = np.partition(s, max(0, s.shape[1] - k), axis=1)[:, max(0, s.shape[1] - k)] if s.shape[1] else np.zeros(len(s))
                i, j = np.nonzero((s >= np.maximum(kth, least)[:, None]) & (s > -1.5))
                best.append(pd.DataFrame({"vid": own[a + i], "neighbour": vid[j], "cosine": (q[a + i] * x[j]).sum(1)}))
            best = [pd.concat(best).sort_values(["vid", "cosine", "neighbour"], ascending=[True, False, True]).groupby("vid").head(k)]
        if best:
            yield best[0]

    found = vectors.rows.select("vid", "vec").mapInPandas(run, "vid long, neighbour long, cosine double").where(F.col("cosine") >= least)
    return _ranked(found.groupBy("vid").agg(F.slice(F.sort_array(F.collect_set(F.struct((-F.col("cosine")).alias("far"), "neighbour"))), 1, k).alias("best")))


def nearest(vectors: Vectors, k: int = 5, least: float = -1.0, curves: int | None = None, dims: int = 8, bits: int = 7, window: int = 256, part_rows: int = 8_192, seed: int = 20260420) -> DataFrame:
    """``vid``, ``rank``, ``neighbour`` and ``cosine``: the ``k`` most similar vectors of each, from ``least`` on.

    Each of ``curves`` orderings (:func:`orderings`, unless given) projects all vectors on ``dims`` random directions, scaled by the moments of
    the whole collection and shifted at random, and sorts them along a Hilbert curve. Spark range-partitions
    and sorts every ordering; a row meets those up to ``window`` places before and after it, over the borders
    of its task too: rows near one meet once more in a strip around it. The best of each ordering merge by
    vector, at most ``k`` rows from each, and rank by cosine in double precision, then by the smaller vid.

    Equal vectors are one on the curves, the one of the smallest vid, and what is found for it holds for all
    of them, by ``expand``; so groups of any size don't fill the windows, and ties are broken over all of them.

    The result is approximate (:func:`exact_nearest` isn't): a neighbour counts if some ordering brings it into the window. Every vector is
    indexed and asked for; none is its own neighbour. No vectors or a single one give no rows.
    """
    curves = curves or orderings(vectors.n)
    rng = np.random.default_rng(seed)
    plan = []
    for _ in range(curves):
        basis = np.linalg.qr(rng.standard_normal((vectors.dim, max(dims, 1))))[0][:, :dims]
        spread = np.sqrt(np.einsum("ij,ik,kj->j", basis, vectors.cov, basis).clip(1e-12))
        plan.append((basis / spread, vectors.mean @ (basis / spread), rng.uniform(0, 1, basis.shape[1])))
    share = vectors.rows.sparkSession.sparkContext.broadcast(plan)

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x, out = matrix(b["vec"]), np.zeros((len(b), curves), np.int64)
            for t, (basis, mean, shift) in enumerate(share.value):
                z = x @ basis - mean
                u = 0.5 * (1 + np.tanh(0.79788456 * (z + 0.044715 * z**3)))  # evens out what is near normal
                cells = ((u + shift) / 2 * (1 << bits)).astype(np.int64).clip(0, (1 << bits) - 1)
                out[:, t] = hilbert(cells, bits)
            yield b.assign(keys=list(out))

    def pairs(p: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return top_of_windows(matrix(p["vec"]), p["vid"].to_numpy(), k, window, least)

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held, head, tail, seen = TaskContext.get().partitionId(), [], [], pd.DataFrame(), 0

        def done(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
            for _, p in rows.groupby("curve", sort=True):
                vid = p["vid"].to_numpy()
                a, b, s = pairs(p)
                yield pd.DataFrame({"vid": vid[a], "neighbour": vid[b], "cosine": s}).assign(vec=None).reindex(columns=out)

        for b in batches:
            b = b.assign(at=np.arange(seen, seen + len(b)))
            head += [b[b["at"] < window]] if seen < window else []
            tail = pd.concat([tail, b]).iloc[-window:]
            seen += len(b)
            held.append(b)
            if sum(map(len, held)) > 4 * part_rows:  # a partition came out larger: work on it in runs that overlap
                rows = pd.concat(held)
                yield from done(rows)
                held = [rows.iloc[-2 * window :]]
        if held:
            yield from done(pd.concat(held))
            yield pd.concat([*head, tail[tail["at"] >= window]]).assign(part=part, size=seen).reindex(columns=out)

    equal = cut(equal_groups(vectors))
    copies = equal.where("vid != rep").select("vid")
    n_copies = copies.count()
    rows = vectors.rows.select("vid", "vec")
    if n_copies:
        rows = rows.join(copies, "vid", "left_anti")
    parts = curves * max(1, ceil((vectors.n - n_copies) / part_rows))
    # Keys are computed once; the range borders are then drawn from them, not from the vectors again
    keyed = cut(rows.mapInPandas(keys, "vid long, vec array<float>, keys array<long>")).select(F.posexplode("keys").alias("curve", "key"), "vid", "vec")
    ordered = keyed.repartitionByRange(parts, "curve", "key", "vid").sortWithinPartitions("curve", "key", "vid")
    out = ["vid", "neighbour", "cosine", "curve", "vec", "part", "at", "size"]
    met = cut(ordered.mapInPandas(meet, "vid long, neighbour long, cosine double, curve int, vec array<float>, part int, at long, size long"))
    found, edges = met.where("part is null").select("vid", "neighbour", "cosine"), met.where("part is not null")

    sizes = sorted((r["part"], r["size"]) for r in edges.select("part", "size").distinct().collect())  # a row for each task
    first = dict(zip([p for p, _ in sizes], np.cumsum([0] + [n for _, n in sizes]).tolist()))
    borders = np.array(sorted(first.values())[1:], np.int64)

    def strips(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            place = b["at"].to_numpy(np.int64) + b["part"].map(first).to_numpy(np.int64)
            lo, hi = np.searchsorted(borders, place - window, "right"), np.searchsorted(borders, place + window, "right")
            row = np.repeat(np.arange(len(b)), hi - lo)
            border = borders[np.repeat(lo, hi - lo) + np.arange(len(row)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)]
            yield pd.DataFrame({"border": border, "place": place[row], "curve": b["curve"].to_numpy(np.int32)[row], "vid": b["vid"].to_numpy()[row], "vec": b["vec"].to_numpy()[row]})

    def over(b: pd.DataFrame) -> pd.DataFrame:
        border, got = b["border"].iloc[0], [pd.DataFrame({"vid": np.zeros(0, np.int64), "neighbour": np.zeros(0, np.int64), "cosine": np.zeros(0)})]
        for _, p in b.sort_values("place").groupby("curve"):
            vid, far = p["vid"].to_numpy(), p["place"].to_numpy() >= border
            if far.all() or not far.any():
                continue
            i, j, s = pairs(p)
            on = far[i] != far[j]
            got.append(pd.DataFrame({"vid": vid[i[on]], "neighbour": vid[j[on]], "cosine": s[on]}))
        return pd.concat(got)

    if len(borders):
        strip = edges.select("vid", "curve", "vec", "part", "at").mapInPandas(strips, "border long, place long, curve int, vid long, vec array<float>")
        found = found.unionByName(strip.groupBy("border").applyInPandas(over, "vid long, neighbour long, cosine double"))
    # By vector: at most k rows from each curve and strip
    best = found.groupBy("vid").agg(F.slice(F.sort_array(F.collect_set(F.struct((-F.col("cosine")).alias("far"), "neighbour"))), 1, k).alias("best"))
    return expand(_ranked(best), equal, k, least) if n_copies else _ranked(best)


def with_ids(vectors: Vectors, found: DataFrame) -> DataFrame:
    """``nearest``, with the ids of the vectors: id, rank, neighbour_id, cosine."""
    ids = vectors.rows.select("vid", "id")
    out = found.join(ids, "vid").select("id", "rank", "neighbour", "cosine")
    return out.join(ids.select(F.col("vid").alias("neighbour"), F.col("id").alias("neighbour_id")), "neighbour").select("id", "rank", "neighbour_id", "cosine")
