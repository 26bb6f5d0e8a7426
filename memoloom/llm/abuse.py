"""Scores for abusive, hateful and sexual content, by factorization machines over hashed terms."""

from __future__ import annotations

import pickle
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col

KINDS = ("abusive", "hateful", "sexual")
#: log2 of the cells of hashed terms; factors of a term.
TERM_BITS, FACTORS = 18, 6
#: Letters that look like Latin ones, and signs that stand for letters.
_LOOKS = str.maketrans("авеиіјкмнорсѕтухԁɡαοερτυνι", "abeuijkmhopcstyxdgaoeptuvi")
_SIGNS = str.maketrans("0134578@$", "oieastbas")
#: Whole lines of a diff or a mail's header. A deleted comment ('--- text') or wrapped prose ('from a stale
#: token') has no such shape; 'rename from' has it in the head of a file only.
_HEAD = re.compile(
    r"(?:diff --git (?:\"?a/).*|index [0-9a-f]{7,64}\.\.[0-9a-f]{7,64}(?: \d{6})?|(?:---|\+\+\+) (?:\"?[ab]/\S+|/dev/null)"
    r"|(?:new file|deleted file|old|new) mode \d{6}|(?:dis)?similarity index \d+%|git binary patch|(?:literal|delta) \d+"
    r"|commit [0-9a-f]{7,64}|from [0-9a-f]{40} [a-z]{3} [a-z]{3} +\d+ [\d:]+ \d{4}"
    r"|(?:author|from|signed-off-by): [^<>]*<[^<>\s]*>|date: +(?:mon|tue|wed|thu|fri|sat|sun),? [a-z\d]+ +[a-z\d]+ [\d: ]+(?:[+-]\d{4})?|change-id: i[0-9a-f]{40})\s*"
)
_MOVED = re.compile(r"(?:rename|copy) (?:from|to) \S+\s*")
#: The head of a hunk, without the line that it quotes; a line in the body of a binary diff.
_HUNK = re.compile(r"@@ -\d+(?:,\d+)? \+\d+(?:,\d+)? @@")
_BASE85 = re.compile(r"[a-z](?:[0-9a-z!#$%&()*+\-;<=>?@^_`{|}~]{5}){1,13}\s*")
_TERM = re.compile(r"[^\W_](?:[^\W_]|[*#@$](?=[*#@$]*[^\W_]))*")
_SPELT = re.compile(r"(?<![^\W_])[^\W\d_](?:([ .\-])[^\W\d_])(?:\1[^\W\d_])+(?![^\W_])")
_LONG = re.compile(r"([^\W\d_])\1\1+")
_CODE = re.compile(r"[(){};=\[\]]|_\w|\w_")


def _term(t: str) -> str:
    """A term as it was meant: signs and lookalikes for letters, stretched and masked letters."""
    if t.isascii() and t.isalpha():
        return _LONG.sub(r"\1", t)
    if not t.isascii() and any("a" <= c <= "z" for c in t):
        t = t.translate(_LOOKS)
    if "*" in t or "#" in t:
        return f"{t[0]}*{t[-1]}"
    if not t.isalpha() and sum(c.isalpha() for c in t) >= 2 and len(t) >= 4:
        t = t.translate(_SIGNS)
    return _LONG.sub(r"\1", t)


def units(text: str) -> list[list[str]]:
    """The lines of a text as terms, and every two lines of prose where a sentence may run on."""
    low = text.lower()
    if not low.isascii():
        low = "".join(c for c in unicodedata.normalize("NFKD", low) if unicodedata.category(c) not in ("Mn", "Cf"))
    out, open_ = [], None
    file, body = False, False  # in the head of a file; in the body of a binary diff
    for line in low.split("\n"):
        body = body and _BASE85.fullmatch(line) is not None
        file = _HEAD.fullmatch(line) is not None or (file and _MOVED.fullmatch(line) is not None)
        if body or file:
            body = body or line.startswith(("literal ", "delta "))
            open_ = None
            continue
        if hunk := _HUNK.match(line):
            line, open_ = line[hunk.end() :], None
        if _SPELT.search(line):
            line = _SPELT.sub(lambda m: re.sub(r"[ .\-]", "", m[0]), line)
        terms = [_term(t) for t in _TERM.findall(line)]
        if not terms:
            open_ = None
            continue
        out.append(terms)
        prose = len(line) <= 130 and not _CODE.search(line)
        if open_ and prose:
            out.append(open_ + terms)
        open_ = terms if prose and len(line) >= 40 else None
    return out


class _Cells:
    """Hashed cells of terms, remembered within a bound."""

    def __init__(self) -> None:
        self.seen: dict[str, int] = {}

    def __call__(self, term: str) -> int:
        x = self.seen.get(term)
        if x is None:
            if len(self.seen) > 300_000:
                self.seen.clear()
            x = self.seen[term] = xxhash.xxh3_64_intdigest(term) >> (64 - TERM_BITS)
        return x


@dataclass
class Machine:
    """Of each kind a bias, a weight for each known term and factors for each pair; and the threshold."""

    index: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    factor: np.ndarray
    threshold: np.ndarray

    def scores(self, term: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Probabilities (units, kinds) of units given by the starts of their runs of known terms."""
        if not len(start):
            return np.zeros((0, len(KINDS)))
        v = self.factor[term]
        total, square = np.add.reduceat(v, start, axis=0), np.add.reduceat(v * v, start, axis=0)
        raw = self.bias + np.add.reduceat(self.weight[term], start, axis=0) + 0.5 * (total**2 - square).sum(2)
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _pick(start: np.ndarray, size: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the terms of some units, and the starts of these units among them."""
    n = size[rows]
    at = np.repeat(start[rows] - _starts(n), n) + np.arange(n.sum())
    return at, _starts(n)


def _learn(term: np.ndarray, size: np.ndarray, doc: np.ndarray, label: np.ndarray, index: np.ndarray, n_terms: int, rounds: int = 3, epochs: int = 4, negatives: int = 40_000, seed: int = 5) -> Machine:
    """Trains on documents whose labels hold for one of their units at least, which one being unknown.

    A first witness in each positive document is the unit with the most telling terms; later ones are those
    that score highest. Units of other documents are negative: a sample of ``negatives`` at most, and in each
    round those that score highest.
    """
    rng, kinds = np.random.default_rng(seed), len(KINDS)
    start = _starts(size)
    unit_of_term = np.repeat(np.arange(len(size)), size)
    pairs = np.unique(doc[unit_of_term].astype(np.int64) * n_terms + term)
    pd_, pt = pairs // n_terms, pairs % n_terms
    odds = np.zeros((n_terms, kinds))
    for k in range(kinds):
        pos, neg = label[:, k] == 1, label[:, k] == 0
        p, n = np.bincount(pt[pos[pd_]], minlength=n_terms), np.bincount(pt[neg[pd_]], minlength=n_terms)
        odds[:, k] = np.where(p >= 2, np.log((p + 0.5) / (pos.sum() + 1)) - np.log((n + 0.5) / (neg.sum() + 1)), 0)
    score = np.add.reduceat(np.clip(odds, -1, None)[term], start, axis=0) / np.sqrt(size + 3.0)[:, None]
    m = Machine(index, np.full(kinds, -3.0), np.zeros((n_terms, kinds)), rng.normal(0, 0.05, (n_terms, kinds, FACTORS)), np.full(kinds, 0.5))
    grads = [np.full(kinds, 1e-2), np.full((n_terms, kinds), 1e-2), np.full((n_terms, kinds, FACTORS), 1e-2)]
    by_doc = np.argsort(doc, kind="stable")
    d = doc[by_doc]
    first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]]) if len(d) else np.zeros(0, int)
    for _ in range(rounds):
        witness = np.zeros((len(size), kinds), bool)
        for k in range(kinds):
            s = score[by_doc, k]
            best = np.maximum.reduceat(s, first)
            top = np.flatnonzero(s == np.repeat(best, np.diff(np.r_[first, len(d)])))
            top = top[np.unique(d[top], return_index=True)[1]]
            w = by_doc[top]
            witness[w[label[doc[w], k] == 1], k] = True
        clean = (label[doc] == 0) & ~witness
        some = rng.permutation(np.flatnonzero(clean.any(1)))[:negatives]
        hard = [np.argsort(-np.where(clean[:, k], score[:, k], -np.inf))[:1500] for k in range(kinds)]
        rows = np.unique(np.concatenate([some, *hard, np.flatnonzero(witness.any(1))]))
        y = witness[rows].astype(float)
        use = (witness[rows] | clean[rows]).astype(float)
        use *= np.where(y > 0, np.sqrt(np.maximum(1, use.sum(0) / np.maximum(1, y.sum(0)))), 1)
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for a in range(0, len(order), 512):
                o = order[a : a + 512]
                at, st = _pick(start, size, rows[o])
                t = term[at]
                own = np.repeat(np.arange(len(o)), size[rows[o]])
                v = m.factor[t]
                total = np.add.reduceat(v, st, axis=0)
                raw = m.bias + np.add.reduceat(m.weight[t], st, axis=0) + 0.5 * (total**2 - np.add.reduceat(v * v, st, axis=0)).sum(2)
                g = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[o]) * use[o]
                gt = g[own]
                cells, inv = np.unique(t, return_inverse=True)
                gw = np.zeros((len(cells), kinds))
                np.add.at(gw, inv, gt)
                gv = np.zeros((len(cells), kinds, FACTORS))
                np.add.at(gv, inv, gt[:, :, None] * (total[own] - v))
                gw += 0.02 * m.weight[cells]
                gv += 0.05 * m.factor[cells]
                gb = g.sum(0)
                grads[0] += gb**2
                grads[1][cells] += gw**2
                grads[2][cells] += gv**2
                m.bias -= 0.2 * gb / np.sqrt(grads[0])
                m.weight[cells] -= 0.2 * gw / np.sqrt(grads[1][cells])
                m.factor[cells] -= 0.1 * gv / np.sqrt(grads[2][cells])
        score = np.concatenate([m.scores(term[start[a] : start[min(a + 50_000, len(size)) - 1] + size[min(a + 50_000, len(size)) - 1]], start[a : a + 50_000] - start[a]) for a in range(0, len(size), 50_000)])
    m.unit_scores = score
    return m


def _in_turn(jobs: list[tuple], *shared) -> list[Machine]:
    return [_learn(*job, *shared) for job in jobs]


def _in_tasks(spark: SparkSession):
    """Learns each machine in a task of its own; what the tasks are sent is bounded by the number of labels."""

    def learn(jobs: list[tuple], label: np.ndarray, index: np.ndarray, n_terms: int) -> list[Machine]:
        share = spark.sparkContext.broadcast((jobs, label, index, n_terms))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            jobs, label, index, n_terms = share.value
            for b in batches:
                made = [_learn(*jobs[i], label, index, n_terms) for i in b["id"]]
                yield pd.DataFrame({"id": b["id"], "machine": [pickle.dumps((m.bias, m.weight, m.factor)) for m in made]})

        got = spark.range(0, len(jobs), 1, len(jobs)).mapInPandas(run, "id long, machine binary").toPandas().sort_values("id")
        share.destroy()
        return [Machine(index, *pickle.loads(x), np.full(len(KINDS), 0.5)) for x in got["machine"]]

    return learn


def fit(sizes: np.ndarray, cells: np.ndarray, doc: np.ndarray, label: np.ndarray, min_docs: int = 3, stands_for: np.ndarray | None = None, learn=_in_turn) -> Machine:
    """A machine from units of labelled documents (``label``: 1, 0 or -1 for unknown, by document and kind).

    Terms in fewer than ``min_docs`` documents, names above all, are unknown here and later. The thresholds
    are those of the best F1 where each half of the documents is scored by a machine of the other half, 0.5 at
    least; there a document counts as the ``stands_for`` labels that it was drawn from. ``learn`` makes the machines,
    which don't depend on each other.
    """
    stands_for = np.ones(len(label)) if stands_for is None else stands_for
    of = np.repeat(np.arange(len(sizes)), sizes)
    pairs = np.unique(doc[of].astype(np.int64) << TERM_BITS | cells)
    docs_of = np.bincount(pairs & ((1 << TERM_BITS) - 1), minlength=1 << TERM_BITS)
    known = np.flatnonzero(docs_of >= min_docs)
    index = np.full(1 << TERM_BITS, -1, np.int32)
    index[known] = np.arange(len(known))
    keep = index[cells] >= 0
    # each different term of a unit counts once
    both = np.unique(of[keep].astype(np.int64) * max(1, len(known)) + index[cells[keep]])
    of, term = both // max(1, len(known)), both % max(1, len(known))
    n = np.bincount(of, minlength=len(sizes))
    some = n > 0
    if not some.any():
        return Machine(index, np.full(len(KINDS), -9.0), np.zeros((1, len(KINDS))), np.zeros((1, len(KINDS), FACTORS)), np.full(len(KINDS), 0.5))
    n, doc = n[some], doc[some]
    term = term.astype(np.int64)
    half = (np.arange(len(label)) * 2654435761 >> 7) % 2
    held = np.zeros((len(label), len(KINDS)))
    start = _starts(n)
    jobs, others = [], []
    for h in (0, 1):
        inside = half[doc] == h
        if inside.any() and not inside.all():
            jobs.append((term[_pick(start, n, np.flatnonzero(inside))[0]], n[inside], doc[inside]))
            others.append(np.flatnonzero(~inside))
    *parts, m = learn([*jobs, (term, n, doc)], label, index, len(known))
    for part, rest in zip(parts, others):
        at, st = _pick(start, n, rest)
        np.maximum.at(held, doc[rest], part.scores(term[at], st))
    for k in range(len(KINDS)):
        ok = label[:, k] >= 0
        s, y, w = held[ok, k], label[ok, k] == 1, stands_for[ok]
        order = np.argsort(-s)
        hit = (w * y)[order].cumsum()
        f1 = 2 * hit / (w[order].cumsum() + max(1, (w * y).sum()))
        if len(s) and y.any():
            best = int(f1.argmax())
            low = s[order][best + 1] if best + 1 < len(s) else 0.0
            m.threshold[k] = np.clip((s[order][best] + low) / 2, 0.5, 0.98)
    return m


def _flat(texts: pd.Series, cell: _Cells) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(size of each unit, cells, text of each unit)."""
    sizes, cells, of = [], [], []
    for i, t in enumerate(texts):
        for u in units(t) if t else ():
            sizes.append(len(u))
            of.append(i)
            cells += map(cell, u)
    return np.array(sizes, np.int64), np.array(cells, np.int64), np.array(of, np.int64)


def train(docs: DataFrame, id_col: str, text_col: str, labels: DataFrame, label_id: str, max_labels: int = 12_000) -> Machine:
    """A machine from at most ``max_labels`` labelled documents, all where there are no more.

    Of more, those with a positive label are a third at most, more only where the others are too few, each part
    drawn by hashes of ids; a document stands for as many of its part as were drawn from, so that thresholds
    fit all labels.
    """
    any_ = F.greatest(*[F.coalesce(col(k).cast("int"), F.lit(-1)) for k in KINDS]) == 1
    chosen = labels.where(col(label_id).isNotNull()).select(col(label_id).alias("id"), *[F.coalesce(col(k).cast("int"), F.lit(-1)).alias(k) for k in KINDS], any_.alias("any"))
    of = {r["any"]: r["n"] for r in chosen.groupBy("any").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = of.get(True, 0), of.get(False, 0)
    take = max(min(pos, max_labels // 3), max_labels - neg)
    part = lambda on, n, all_: chosen.where(F.col("any") == on).orderBy(F.xxhash64(F.lit(3), "id"), "id").limit(n).withColumn("stands", F.lit(all_ / max(1, min(n, all_))))
    chosen = part(True, take, pos).unionByName(part(False, max_labels - min(take, pos), neg)).drop("any")
    rows = docs.where(col(text_col).isNotNull()).select(col(id_col).alias("id"), col(text_col).alias("text")).join(F.broadcast(chosen), "id")  # at most max_labels rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell = _Cells()
        for b in batches:
            out = []
            for t in b["text"]:
                sizes, cells, _ = _flat(pd.Series([t]), cell)
                out.append((sizes.astype(np.int32), cells.astype(np.int32)))
            yield pd.DataFrame({"id": b["id"], **{k: b[k] for k in KINDS}, "stands": b["stands"], "sizes": [x for x, _ in out], "cells": [x for _, x in out]})

    kind = rows.schema["id"].dataType.simpleString()
    got = rows.mapInPandas(run, f"id {kind}, {', '.join(f'{k} int' for k in KINDS)}, stands double, sizes array<int>, cells array<int>").toPandas()
    got = got.sort_values("id", kind="stable").reset_index(drop=True)
    if not len(got):
        return fit(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 3)))
    sizes = np.concatenate(got["sizes"].to_list()).astype(np.int64)
    cells = np.concatenate(got["cells"].to_list()).astype(np.int64)
    doc = np.repeat(np.arange(len(got)), [len(x) for x in got["sizes"]])
    return fit(sizes, cells, doc, got[list(KINDS)].to_numpy(), stands_for=got["stands"].to_numpy(), learn=_in_tasks(docs.sparkSession))


def content_scores(docs: DataFrame, id_col: str, text_col: str, labels: DataFrame, label_id: str, keep: tuple[str, ...] = (), max_labels: int = 12_000) -> DataFrame:
    """Of each document the scores ``abusive``, ``hateful`` and ``sexual`` (0 to 1) and, for each, whether it
    is ``..._found``, that is, reaches the threshold of the best F1 on held-out labels.

    A document scores as the highest of its lines, and of two lines of prose in a row, since one sentence in
    a long text is enough. Terms are read through spelt-out, stretched, masked and look-alike letters. A
    factorization machine adds a weight for each term and the product of factors for each pair, so that an
    insult counts where a person is meant and not where code or oneself is.

    The machine is trained here on at most ``max_labels`` labelled documents (nulls in labels are unknown);
    all documents are scored whole, in one pass without a shuffle. Null and empty texts score 0 and are not
    found. Every row gives one row, repeated rows too; ``keep`` names columns to carry along. Without
    labels nothing is found; without documents there are no rows.
    """
    machine = train(docs, id_col, text_col, labels, label_id, max_labels)
    share = docs.sparkSession.sparkContext.broadcast(machine)
    rows = docs.select(col(id_col).alias("_id"), *[col(k).alias(f"_k{i}") for i, k in enumerate(keep)], col(text_col).alias("_text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, cell = share.value, _Cells()
        for b in batches:
            score = np.zeros((len(b), len(KINDS)))
            for a in range(0, len(b), 1_000):
                sizes, cells, of = _flat(b["_text"].iloc[a : a + 1_000], cell)
                index = m.index[cells]
                unit = np.repeat(np.arange(len(sizes)), sizes)[index >= 0]
                both = np.unique(unit.astype(np.int64) << 20 | index[index >= 0])
                unit, term = both >> 20, both & ((1 << 20) - 1)
                first = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]]) if len(unit) else np.zeros(0, int)
                if len(first):
                    np.maximum.at(score, of[unit[first]] + a, m.scores(term, first))
            out = b.drop(columns="_text")
            for k, name in enumerate(KINDS):
                out[name] = score[:, k]
            for k, name in enumerate(KINDS):
                out[f"{name}_found"] = (score[:, k] >= m.threshold[k]) & (score[:, k] > 0)
            yield out

    schema = [f"{f.name} {f.dataType.simpleString()}" for f in rows.drop("_text").schema] + [f"{k} double" for k in KINDS] + [f"{k}_found boolean" for k in KINDS]
    out = rows.mapInPandas(run, ", ".join(schema))
    return out.select(F.col("_id").alias(id_col), *[F.col(f"_k{i}").alias(k) for i, k in enumerate(keep)], *KINDS, *[f"{k}_found" for k in KINDS])


def found(scores: DataFrame, id_col: str) -> DataFrame:
    """One row for each document and kind that it was found to be."""
    kinds = F.filter(F.array(*[F.when(F.col(f"{k}_found"), F.lit(k)) for k in KINDS]), lambda x: x.isNotNull())
    return scores.select(col(id_col).alias(id_col), F.explode(kinds).alias("kind"))


def rates(scores: DataFrame, source_col: str) -> DataFrame:
    """By source: documents, and of each kind the number found and its share."""
    agg = [F.count(F.lit(1)).alias("documents")]
    for k in KINDS:
        agg += [F.count_if(f"{k}_found").alias(f"{k}_found"), F.avg(F.col(f"{k}_found").cast("double")).alias(f"{k}_rate")]
    return scores.groupBy(col(source_col).alias(source_col)).agg(*agg)
