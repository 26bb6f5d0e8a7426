"""Records that share most of their words: ProbMinHash signatures, banding, exact verification."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, col, cut, fields, fold, mix
from .components import connected_components
from .copies import same_text

#: Components of a band for up to TEXTS texts; one more for each further factor of STEP, by which texts that have
#: little in common become as rare in a key as before.
ROWS, TEXTS, STEP = 5, 1_000_000, 2.5
#: Chance that a pair just at the threshold has no band in common; the number of bands follows from it.
MISSED = 2e-5
#: Different texts of a key that are compared at once; keys of more are divided, without a loss (see ``_divided``).
CROWDED = 2_000
#: log2 of the cells in which words are counted to put them in an order; any order gives the same result.
ORDER_BITS = 20


def banding(texts: int, threshold: float) -> tuple[int, int]:
    """(bands, rows) for a number of texts: pairs at the threshold are missed with a chance of ``MISSED``."""
    rows = ROWS + max(0, ceil(log(max(texts, 1) / TEXTS) / log(STEP)))
    return ceil(log(MISSED) / log(1 - threshold**rows)), rows


class _Hasher:
    """Hashes of words, remembered within a bound."""

    def __init__(self) -> None:
        self.seen: dict[str, int] = {}

    def __call__(self, found: list[str]) -> np.ndarray:
        seen, out = self.seen, []
        for w in found:
            h = seen.get(w)
            if h is None:
                if len(seen) > 300_000:
                    seen.clear()
                h = seen[w] = xxhash.xxh3_64_intdigest(w)
            out.append(h)
        return np.array(out, np.uint64)


def _occurrences(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of words given by text: doc and hash of each different one, its count; and its place among equals, for all."""
    order = np.lexsort((h, doc))
    d, w = doc[order], h[order]
    new = np.r_[True, (d[1:] != d[:-1]) | (w[1:] != w[:-1])] if len(d) else np.zeros(0, bool)
    start = np.flatnonzero(new)
    count = np.diff(np.r_[start, len(d)])
    nth = np.arange(len(d)) - np.repeat(start, count)
    return d[start], w[start], count, mix(w ^ mix(nth.astype(np.uint64)))


def prob_min_hash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """Signatures (n_docs, m) of weighted sets, each component the element that arrives first there.

    The arrivals of an element form a Poisson process with its weight as rate, drawn from its hash alone;
    each arrival falls on a random component. Two sets agree in a component with the probability of their
    probability Jaccard similarity. An element stops when its next arrival is later than all components'
    firsts. Arrivals at rate 1 and their components are drawn once for all sets that have the element.
    """
    first = np.full(n_docs * m, np.inf)
    who = np.zeros(n_docs * m, np.uint64)
    kinds, kind = np.unique(element, return_inverse=True)
    clock, base = np.zeros(len(kinds)), doc * m
    act, k = np.arange(len(doc)), 0
    of, row, at, rate = kind, doc, base, weight
    grid, last = first.reshape(n_docs, m), np.full(n_docs, np.inf)
    while len(act):
        k += 1
        if k % 4 == 1:  # go on for elements and sets that still need it
            live, sets = np.unique(of), np.unique(row)
        r = mix(kinds[live] ^ mix(np.full(1, k, np.uint64)))
        clock[live] -= np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        where = np.zeros(len(kinds), np.int64)
        where[live] = (mix(r) % np.uint64(m)).astype(np.int64)
        t = clock[of] / rate
        place = at + where[of]
        better = np.flatnonzero(t < first[place])
        p, tt = place[better], t[better]
        order = np.argsort(-tt)  # the earliest comes last and stays
        p = p[order]
        first[p] = tt[order]
        who[p] = kinds[of[better]][order]
        last[sets] = grid[sets].max(1)
        going = t < last[row]
        act = act[going]
        of, row, at, rate = of[going], row[going], at[going], rate[going]
    return who.reshape(n_docs, m)


def _segments(texts: pd.Series, hasher: _Hasher, size: int = 4_000):
    """Words of texts, some thousand texts at a time: (slice, words by text, how many, doc and hash of each)."""
    for at in range(0, len(texts), size):
        each = [WORD.findall(fold(t)) for t in texts.iloc[at : at + size]]
        sizes = [len(x) for x in each]
        yield slice(at, at + size), each, np.array(sizes), np.repeat(np.arange(len(each)), sizes), hasher([w for x in each for w in x])


def _bands(doc: np.ndarray, element: np.ndarray, count: np.ndarray, n_docs: int, bands: int, rows: int) -> np.ndarray:
    """Keys (n_docs, bands) of ``rows`` components each, the words weighted by their counts."""
    sig = prob_min_hash(doc, element, count.astype(np.float64), n_docs, bands * rows)
    key = np.zeros((n_docs, bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        key = mix(key ^ sig[:, i::rows])
    return key


def _signed(texts: DataFrame, min_words: int, bands: int, rows: int) -> DataFrame:
    """Of each text: class (``c1``, ``c2``: same words and the same text), words, their parity in 64 bits, band keys.

    Copies of a class that a task has met before come without keys, so that however many rows have one text, each
    task gives its keys once (as long as it remembers them).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, met = _Hasher(), set()
        for b in batches:
            for cut_, each, sizes, doc, h in _segments(b["text"], hasher):
                keep = np.flatnonzero(sizes >= min_words)
                if not len(keep):
                    continue
                d, w, count, occ = _occurrences(doc, h)
                start = (np.cumsum(sizes) - sizes)[keep]
                over = lambda f, x: f.reduceat(np.append(x, x[:1]), np.c_[start, start + sizes[keep]].ravel())[::2]
                bag1, bag2 = over(np.add, occ), over(np.add, mix(occ))
                parity = over(np.bitwise_xor, np.uint64(1) << (occ & np.uint64(63)))
                text = np.array([_text_class(t, each[i]) for i, t in zip(keep, b["text"].iloc[cut_].iloc[keep])], np.uint64)
                c1, c2 = mix(text ^ mix(bag1)), mix(bag2 ^ mix(text))
                fresh = np.zeros(len(keep), bool)
                for i, c in enumerate(zip(c1.tolist(), c2.tolist())):
                    if c not in met:
                        if len(met) > 500_000:
                            met.clear()
                        met.add(c)
                        fresh[i] = True
                keys: list[np.ndarray | None] = [None] * len(keep)
                if fresh.any():
                    place = np.full(len(sizes), -1)
                    place[keep[fresh]] = np.arange(fresh.sum())
                    of = place[d] >= 0
                    made = _bands(place[d[of]], w[of], count[of], int(fresh.sum()), bands, rows).view(np.int64)
                    for i, k in zip(np.flatnonzero(fresh), made):
                        keys[i] = k
                yield pd.DataFrame({"id": b["id"].iloc[cut_].to_numpy()[keep], "c1": c1.view(np.int64), "c2": c2.view(np.int64), "n": sizes[keep].astype(np.int32), "p": parity.view(np.int64), "keys": keys})

    return texts.mapInPandas(run, f"id {texts.schema['id'].dataType.simpleString()}, c1 long, c2 long, n int, p long, keys array<long>")


def _text_class(text: str, found: list[str]) -> int:
    parts = fields(text)
    if parts is None:
        return xxhash.xxh3_64_intdigest("".join(found))
    return sum(xxhash.xxh3_64_intdigest(p, seed=1) for p in parts) & 0xFFFFFFFFFFFFFFFF


def _together(keyed: DataFrame, threshold: float, crowded: int | None) -> DataFrame:
    """Pairs of classes that have a key in common and may be similar enough, by length and parity.

    ``keyed``: key, c1, c2, n, p. Rows are sorted by key within their tasks and read as a stream. Of n_a + n_b words
    at most (1 - t) / (1 + t) stand in one text alone, so no more bits of the parities differ, and the shorter text
    has t times the words of the longer one at least; neither bound drops a pair. Rows of keys with more than
    ``crowded`` classes come back as they are (``more``), not compared.
    """
    most = (1 - threshold) / (1 + threshold)
    names = ["key", "n", "c1", "c2", "p"]

    def pairs(r: np.ndarray) -> pd.DataFrame:
        key, n, c1, c2, p = r
        out = []
        i = np.arange(len(key) - 1)
        step = 1
        while len(i):
            j = i + step
            i = i[(key[i] == key[j]) & (n[j] * threshold <= n[i] + 1e-6)]  # by n within a key: what is too long stays so
            j = i + step
            near = np.bitwise_count((p[i] ^ p[j]).view(np.uint64)) <= (n[i] + n[j]) * most + 1e-6
            out.append(np.stack([i[near], j[near]]))
            step += 1
            i = i[i + step < len(key)]
        i, j = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
        swap = (c1[i] > c1[j]) | ((c1[i] == c1[j]) & (c2[i] > c2[j]))
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        return pd.DataFrame({"a1": c1[i], "a2": c2[i], "b1": c1[j], "b2": c2[j]}).drop_duplicates()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, full = [], 0, None
        none = np.zeros((5, 0), np.int64)

        def done(last: bool) -> Iterator[pd.DataFrame]:
            nonlocal held, size, full
            r = np.concatenate(held, axis=1) if held else none
            if r.shape[1]:  # one row a class and key
                r = r[:, np.r_[True, (r[:4, 1:] != r[:4, :-1]).any(0)]]
            new = np.flatnonzero(np.r_[True, r[0, 1:] != r[0, :-1]]) if r.shape[1] else np.zeros(0, int)
            keep = r.shape[1] if last or not len(new) else new[-1]
            if crowded is not None and len(new):
                sizes = np.diff(np.r_[new, r.shape[1]])
                large = (sizes > crowded) | (r[0, new] == full if full is not None else False)
                if large[-1]:
                    full, keep = r[0, -1], r.shape[1]
                many = np.repeat(large, sizes)
                if many.any():
                    yield pd.DataFrame(dict(zip(names, r[:, many]))).rename(columns={"c1": "a1", "c2": "a2"}).assign(b1=0, b2=0, more=True)[order]
                here = ~many[:keep]
                yield pairs(r[:, :keep][:, here]).assign(key=0, n=0, p=0, more=False)[order]
            elif len(new):
                yield pairs(r[:, :keep]).assign(key=0, n=0, p=0, more=False)[order]
            held = [r[:, keep:]]
            size = held[0].shape[1]

        for b in batches:
            held.append(b[names].to_numpy(np.int64).T)
            size += len(b)
            if size >= 60_000:
                yield from done(False)
        yield from done(True)

    order = ["a1", "a2", "b1", "b2", "key", "n", "p", "more"]
    rows = keyed.repartition("key").sortWithinPartitions("key", "n", "c1", "c2").select(*names)
    return cut(rows.mapInPandas(run, "a1 long, a2 long, b1 long, b2 long, key long, n int, p long, more boolean"))


def _counts(texts: DataFrame) -> np.ndarray:
    """How many of the texts have a word, by cell; each partition on its own first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, counts = _Hasher(), np.zeros(1 << ORDER_BITS, np.int64)
        for b in batches:
            for _, _, _, doc, h in _segments(b["text"], hasher):
                _, w, _, _ = _occurrences(doc, h)
                counts += np.bincount((w >> np.uint64(64 - ORDER_BITS)).astype(np.int64), minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"cell": at.astype(np.int32), "n": counts[at]})

    got = texts.select("text").mapInPandas(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << ORDER_BITS, np.int64)
    out[got["cell"].to_numpy()] = got["n"].to_numpy()
    return out


def _divided(rows: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Rows of crowded keys under finer keys: the key and a word, for each of the rarest words of the text.

    Two texts of the similarity share t times the words of either, so of the n - t * n + 1 rarest words (in one
    order for all, repeats told apart) they have one in common: no pair that met under the key is lost. Words are
    put in order by how many of these texts have them.
    """
    of = rows.select("key", "c1", "c2", "n", "p").join(texts, ["c1", "c2"])
    counts = rows.sparkSession.sparkContext.broadcast(_counts(rows.select("c1", "c2").distinct().join(texts, ["c1", "c2"])))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, often = _Hasher(), counts.value
        for b in batches:
            for cut_, _, sizes, doc, h in _segments(b["text"], hasher):
                part = b.iloc[cut_]
                order = np.lexsort((h, doc))
                doc, h = doc[order], h[order]
                _, _, _, occ = _occurrences(doc, h)
                order = np.lexsort((occ, often[(h >> np.uint64(64 - ORDER_BITS)).astype(np.int64)], doc))
                doc, occ = doc[order], occ[order]
                nth = np.arange(len(doc)) - (np.cumsum(sizes) - sizes)[doc]
                rare = nth <= sizes[doc] - np.ceil(threshold * sizes[doc] - 1e-9)
                doc, occ = doc[rare], occ[rare]
                out = part[["c1", "c2", "n", "p"]].iloc[doc].reset_index(drop=True)
                out.insert(0, "key", mix(part["key"].to_numpy(np.int64).view(np.uint64)[doc] ^ mix(occ)).view(np.int64))
                yield out

    return of.select("key", "c1", "c2", "n", "p", "text").mapInPandas(run, "key long, c1 long, c2 long, n int, p long")


def _tiles(rows: DataFrame, size: int) -> DataFrame:
    """Rows of keys that no word divides, under keys of two tiles each: every two tiles of a key meet in one place."""
    split = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("splits"))
    own = rows.join(split, "key").withColumn("own", F.pmod(F.xxhash64("c1", "c2"), F.col("splits")).cast("int"))
    both = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
    return both.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "c1", "c2", "n", "p")


def _alike(a: str, b: str, least: float) -> float:
    """Sum of the smaller counts of each word over the sum of the larger ones; 0 for the same text or below ``least``."""
    x, y = Counter(WORD.findall(fold(a))), Counter(WORD.findall(fold(b)))
    shared = sum((x & y).values())
    all_ = sum((x | y).values())
    if not all_ or shared < least * all_ - 1e-9 or same_text(a, b):
        return 0.0
    return shared / all_


def near_pairs(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.8, min_words: int = 8, crowded: int = CROWDED) -> tuple[DataFrame, DataFrame]:
    """Pairs of different texts that share most of their words; returns (pairs, members).

    The similarity of two texts is that of their words as multisets, sum of smaller by sum of larger counts.
    pairs: ``rep_a``, ``rep_b``, ``similarity`` of representatives, each pair once. members: ``id``, ``rep``
    of every row whose text has ``min_words`` words; rows of equal words and the same text have one
    representative, their smallest id, so that exact copies never meet as pairs.

    Each text is read once for its class, its parity and its ProbMinHash signature, words weighted by their counts.
    Bands of the signature (:func:`banding`) are the keys under which texts meet, so a pair at the threshold is missed
    with a chance of ``MISSED``, and less above it, whatever its words are and however large the corpus is. Texts of a
    key are compared by length and parity, in a stream within its task. Keys of more than ``crowded`` texts are
    divided by the rarest words of their texts and, where that doesn't do, into tiles that all meet; both keep every
    pair. Whatever is left is verified word by word.

    Null texts and those of fewer words are in no pair. A row repeated with its id is one row. An empty table
    gives empty results; columns that aren't named are ignored.
    """
    kind = df.select(col(id_col)).schema[0].dataType.simpleString()
    rows = df.where(col(text_col).isNotNull()).select(col(id_col).alias("id"), col(text_col).alias("text"))
    bands, length = banding(df.count(), threshold)
    units = cut(_signed(rows, min_words, bands, length))
    reps = units.groupBy("c1", "c2").agg(F.min("id").alias("rep"))
    members = units.select("id", "c1", "c2").join(reps, ["c1", "c2"]).select("id", "rep").distinct()

    met = _together(units.where("keys is not null").select(F.explode("keys").alias("key"), "c1", "c2", "n", "p"), threshold, crowded)
    found = [met]
    if not met.where("more").isEmpty():
        left = lambda x: x.where("more").select("key", F.col("a1").alias("c1"), F.col("a2").alias("c2"), "n", "p")
        texts = cut(left(met).select("c1", "c2").distinct().join(reps, ["c1", "c2"]).join(rows.withColumnRenamed("id", "rep"), "rep").dropDuplicates(["rep"]).drop("rep"))
        finer = _together(_divided(left(met), texts, threshold), threshold, crowded)
        found.append(finer)
        if not finer.where("more").isEmpty():
            found.append(_together(_tiles(left(finer), crowded), threshold, None))
    both = found[0]
    for f in found[1:]:
        both = both.unionByName(f)
    both = both.where("not more").select("a1", "a2", "b1", "b2").distinct()

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = b[["rep_a", "rep_b"]].copy()
            out["similarity"] = [_alike(x, y, threshold) for x, y in zip(b["text_a"], b["text_b"])]
            yield out[out["similarity"] > 0]

    side = lambda x: reps.select(F.col("c1").alias(f"{x}1"), F.col("c2").alias(f"{x}2"), F.col("rep").alias(f"rep_{x}"))
    named = cut(both.join(side("a"), ["a1", "a2"]).join(side("b"), ["b1", "b2"]).select(F.least("rep_a", "rep_b").alias("rep_a"), F.greatest("rep_a", "rep_b").alias("rep_b")))
    needed = named.select(F.explode(F.array("rep_a", "rep_b")).alias("id")).distinct()
    texts = cut(rows.join(needed, "id").dropDuplicates(["id"]))
    text = lambda x: texts.select(F.col("id").alias(f"rep_{x}"), F.col("text").alias(f"text_{x}"))
    pairs = named.join(text("a"), "rep_a").join(text("b"), "rep_b").mapInPandas(verify, f"rep_a {kind}, rep_b {kind}, similarity double")
    return pairs, members


def expand(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Every pair of rows behind the pairs of representatives: ``id_a`` < ``id_b``."""
    a = members.select(F.col("rep").alias("rep_a"), F.col("id").alias("x"))
    b = members.select(F.col("rep").alias("rep_b"), F.col("id").alias("y"))
    both = pairs.join(a, "rep_a").join(b, "rep_b")
    return both.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), "similarity")


def near_groups(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """``id``, ``rep``, ``group_id`` and the number of links of each row that has a near duplicate.

    Groups are connected through pairs of any number; their id is the smallest representative in them.
    """
    ends = pairs.select(F.col("rep_a").alias("rep")).unionAll(pairs.select(F.col("rep_b").alias("rep")))
    links = ends.groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
    groups = connected_components(pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")))
    return members.join(links, "rep").join(groups.select(F.col("node").alias("rep"), F.col("component").alias("group_id")), "rep").select("id", "rep", "group_id", "links")
