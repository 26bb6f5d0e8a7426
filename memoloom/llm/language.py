"""Language of texts and of the passages in them, by a string kernel."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import col, fold, mix

#: log2 of the cells of hashed n-grams; lengths of the blended spectrum.
GRAM_BITS, LENGTHS = 18, (1, 2, 3, 4, 5)
#: Cost of another language at the next word, within a sentence and between two, in units of a word's mean lead.
WITHIN, BETWEEN = 9.0, 2.5
#: Fewest words of a stretch; characters, in a language that is written without spaces between words.
MIN_WORDS, MIN_CHARS, UNSPACED = 6, 20, {"ja", "zh", "th"}
_TOKEN = re.compile(r"[^\W_]+|[.!?。！？…\n\r/|;]|--")
_DIGIT = re.compile(r"\d")


def grams(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, cell) of each different n-gram of each word, its borders included."""
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.array([len(w) + 2 for w in found])
    code = np.frombuffer("".join(f" {w} " for w in found).encode("utf-32-le"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(found)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(code))
    out_w, out_c = [], []
    h = np.zeros(len(code), np.uint64)
    for i in range(max(LENGTHS)):
        n = len(code) - i
        if n <= 0:
            break
        h = mix(h[:n] ^ (code[i:] + np.uint64(i << 32)))
        if i + 1 in LENGTHS:
            ok = left[:n] > i
            if i == 0:
                ok &= code != 32
            out_w.append(word[:n][ok])
            out_c.append((h[ok] >> np.uint64(64 - GRAM_BITS)).astype(np.int64))
    both = np.unique(np.concatenate(out_w) << GRAM_BITS | np.concatenate(out_c))
    return both >> GRAM_BITS, both & ((1 << GRAM_BITS) - 1)


@dataclass
class Model:
    """One-versus-rest weights of each hashed n-gram: the landmarks' n-grams times the Nyström map times the ridge
    solution, so that words times weights is the product of their kernels with the landmarks and the solution.
    ``scale``: on it a word leads by 1 on average; ``temper``: slope of the confidence, from held-out labels."""

    langs: list[str]
    weights: np.ndarray
    scale: float
    temper: float = 1.0

    def of_words(self, found: list[str]) -> np.ndarray:
        """Scores (words, languages) of words; codes and numbers have none, and words of which few n-grams are
        known, such as names, have little."""
        out = np.zeros((len(found), len(self.langs)), np.float32)
        kept = [i for i, w in enumerate(found) if w.isalpha() or not w.isascii()]
        for at in range(0, len(kept), 20_000):
            part = kept[at : at + 20_000]
            w, c = grams([found[i] for i in part])
            if len(w):
                first, v = np.flatnonzero(np.r_[True, w[1:] != w[:-1]]), self.weights[c]
                share = np.add.reduceat(v.any(1), first, dtype=np.float32) / np.diff(np.r_[first, len(w)])
                out[part] = np.add.reduceat(v, first, axis=0) * (share**2)[:, None] * self.scale
        # a run without spaces stands for several words, of some five letters each
        most = 4 * np.maximum(1, np.array([0 if w.isascii() else sum(c > "\u024f" for c in w) for w in found]) / 5)[:, None] if found else 4
        return np.clip(out - out.mean(1, keepdims=True), -most, most)


def _sentences(text: str) -> list[list[str]]:
    out: list[list[str]] = [[]]
    for t in _TOKEN.findall(fold(text)):
        if t[0].isalnum():
            out[-1].append(t)
        elif out[-1]:
            out.append([])
    return [s for s in out if s]


def _spectrum(sentences: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """(sentence, cell) of each different n-gram of the sentences."""
    flat = [w for s in sentences for w in s]
    w, c = grams(flat)
    of = np.repeat(np.arange(len(sentences)), [len(s) for s in sentences])
    both = np.unique(of[w] << GRAM_BITS | c)
    return both >> GRAM_BITS, both & ((1 << GRAM_BITS) - 1)


def fit(texts: list[str], labels: list[str], landmarks: int = 60, most: int = 650, ridge: float = 1e-2, rounds: int = 3, seed: int = 7) -> Model:
    """Kernel ridge regression on Nyström features of a presence spectrum kernel, one language against the rest.

    The kernel of two sentences is the number of n-grams that both have, over the root of the product of
    their numbers. ``landmarks`` sentences of each label span the feature space; ``most`` bounds the
    training sentences of each. The regression learns the labels as they are. These may be wrong at times (they come
    from a country): in each round sentences are judged by the regression of the other half, take the language in
    which they score best and, where doubtful, are left out. A tenth of the sentences is held out for the slope of
    the confidence.
    """
    rng = np.random.default_rng(seed)
    langs = sorted(set(labels))
    pool: dict[str, list[list[str]]] = {x: [] for x in langs}
    for t, x in zip(texts, labels):
        pool[x] += [s for s in _sentences(t) if sum(map(len, s)) >= 10]
    data, y, held = [], [], []
    for k, x in enumerate(langs):
        take = rng.permutation(len(pool[x]))[:most]
        few = take[: len(take) // 10]
        held += [(pool[x][i], k) for i in few]
        data += [pool[x][i] for i in take[len(few) :]]
        y += [k] * (len(take) - len(few))
    if not data:
        return Model(langs or ["und"], np.zeros((1 << GRAM_BITS, max(1, len(langs))), np.float32), 1.0)
    y = np.array(y)
    s, c = _spectrum(data)
    size = np.bincount(s, minlength=len(data)).clip(1)
    start = np.searchsorted(s, np.arange(len(data) + 1))
    marks = np.concatenate([rng.permutation(np.flatnonzero(y == k))[:landmarks] for k in range(len(langs))])
    known, inverse = np.unique(np.concatenate([c[start[i] : start[i + 1]] for i in marks]), return_inverse=True)
    basis = np.zeros((len(known) + 1, len(marks)), np.float32)
    basis[inverse, np.repeat(np.arange(len(marks)), size[marks])] = np.repeat(1 / np.sqrt(size[marks]), size[marks])
    at = np.searchsorted(known, c).clip(max=len(known) - 1)
    at[known[at] != c] = len(known)
    kernel = np.zeros((len(data), len(marks)), np.float32)
    for i in range(0, len(data), 250):
        j = min(len(data), i + 250)
        kernel[i:j] = np.add.reduceat(basis[at[start[i] : start[j]]], start[i:j] - start[i], axis=0) / np.sqrt(size[i:j])[:, None]
    value, vector = np.linalg.eigh(kernel[marks].astype(np.float64))
    root = vector / np.sqrt(value.clip(1e-6))
    z = kernel @ root
    label, sure = y, np.ones(len(data), bool)
    solve = lambda on, y: np.linalg.solve(z[on].T @ z[on] + ridge * on.sum() / len(marks) * np.eye(len(marks)), z[on].T @ np.where(np.arange(len(langs)) == y[on][:, None], 1.0, -1.0))
    for _ in range(rounds):
        # each half of the sentences is judged by the regression of the other, so none confirms its own label
        half, score = rng.random(len(data)) < 0.5, np.zeros((len(data), len(langs)))
        for h in (half, ~half):
            if (sure & h).any():
                score[~h] = z[~h] @ solve(sure & h, y)
        two = np.sort(score, axis=1)[:, -2:]
        y = np.where(two[:, -1] - two[:, 0] > 0.3, score.argmax(1), label) if len(langs) > 1 else label
        sure = (two[:, -1] - two[:, 0] > 0.3) if len(langs) > 1 and (two[:, -1] - two[:, 0] > 0.3).any() else sure
    a = solve(sure, y)
    weights = np.zeros((1 << GRAM_BITS, len(langs)), np.float32)
    weights[known] = basis[:-1] @ (root @ a).astype(np.float32)
    model = Model(langs, weights, 1.0)
    lead = []
    for i in np.flatnonzero(sure)[:: max(1, int(sure.sum()) // 1500)]:
        v = model.of_words(data[i])
        rest = np.delete(v, y[i], axis=1).max(1) if len(langs) > 1 else np.zeros(len(v))
        lead.append((v[:, y[i]] - rest).mean())
    model.scale = 1.0 / max(1e-3, float(np.mean(lead))) if lead else 1.0
    if held and len(langs) > 1:
        total = np.array([model.of_words(x).sum(0) for x, _ in held])
        top = total.argmax(1)
        gap = np.diff(np.sort(total, axis=1)[:, -2:], axis=1)[:, 0]
        right = top == np.array([k for _, k in held])
        # the labels themselves are wrong at times; where all is sure, the rest is their error and not the model's
        floor = min(0.3, float((~right[gap >= np.median(gap)]).mean()))
        grid = 2.0 ** np.arange(-4, 2.5, 0.5)
        p = (1 - floor) / (1 + np.exp(-np.clip(grid[:, None] * gap, 0, 30)))
        model.temper = float(grid[(np.log(np.where(right, p, 1 - p).clip(1e-9))).sum(1).argmax()])
    return model


def paths(score: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The best language of each word of texts laid end to end; ``ends`` marks words that end a sentence.

    Viterbi's recursion; since any other language costs the same, it keeps one best rival a word.
    """
    out = np.zeros(len(score), np.int32)
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(sizes, kind="stable")
    order = order[sizes[order] > 0]
    at = 0
    while at < len(order):
        room = max(1, 400_000 // int(sizes[order[min(len(order) - 1, at + 2_000)]]))
        some = order[at : at + min(room, 2_000)]
        at += len(some)
        n, first, longest = sizes[some], starts[some], int(sizes[some[-1]])
        best = np.zeros((len(some), score.shape[1]), np.float32)
        stay = np.zeros((longest, len(some), score.shape[1]), bool)
        top = np.zeros((longest, len(some)), np.int32)
        for t in range(longest):
            live = np.flatnonzero(n > t)
            here = first[live] + t
            b = best[live]
            if t:
                top[t, live] = b.argmax(1)
                rival = b.max(1) - np.where(ends[here - 1], BETWEEN, WITHIN)
                stay[t, live] = b >= rival[:, None]
                b = np.maximum(b, rival[:, None])
            best[live] = b + score[here]
        state = best.argmax(1)
        for t in range(longest - 1, -1, -1):
            live = np.flatnonzero(n > t)
            out[first[live] + t] = state[live]
            if t:
                s = state[live]
                state[live] = np.where(stay[t, live, s], s, top[t, live])
    return out


@dataclass
class Found:
    main: str
    confidence: float
    segments: list[tuple[str, float, str]]


class Reader:
    """Applies a model to batches of texts, with a bounded memory of words."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.seen: dict[str, int] = {}
        self.table = np.zeros((0, len(self.model.langs)), np.float32)

    def _words(self, found: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(found) if w not in self.seen]
        if new:
            self.seen.update(zip(new, range(len(self.table), len(self.table) + len(new))))
            self.table = np.concatenate([self.table, self.model.of_words(new)])
        seen = self.seen
        out = self.table[[seen[w] for w in found]] if found else np.zeros((0, len(self.model.langs)), np.float32)
        if len(seen) > 200_000:
            self._clear()
        return out

    def __call__(self, texts: list[str | None], min_letters: int = 20) -> list[Found | None]:
        flat: list[str] = []
        ends: list[int] = []
        sizes = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if not text:
                continue
            tokens = _TOKEN.findall(fold(text))
            runs = [t for t in tokens if t[0].isalnum()]
            letters = sum(map(len, runs))
            if letters < min_letters or letters < 4 * min_letters and letters - sum(len(_DIGIT.findall(t)) for t in runs) < min_letters:
                continue
            before = len(flat)
            for t in tokens:
                if t[0].isalnum():
                    flat.append(t)
                elif len(flat) > before and (not ends or ends[-1] != len(flat) - 1):
                    ends.append(len(flat) - 1)
            sizes[i] = len(runs)
        score = self._words(flat)
        last = np.zeros(len(flat), bool)
        last[ends] = True
        state = paths(score, last, sizes)
        starts = np.cumsum(sizes) - sizes
        out: list[Found | None] = [None] * len(texts)
        for i in np.flatnonzero(sizes):
            a, b = starts[i], starts[i] + sizes[i]
            v, s = score[a:b], state[a:b]
            if not v.any():
                continue
            if (s == s[0]).all():
                out[i] = Found(self.model.langs[s[0]], self._sure(v, s[0]), [])
            else:
                out[i] = self._mixed(flat[a:b], v, s, last[a:b])
        return out

    def _sure(self, v: np.ndarray, k: int) -> float:
        """A logistic of the lead of a language over the second in all words, of the slope that held-out labels ask for."""
        total = v.sum(0)
        rest = np.delete(total, k).max() if len(total) > 1 else 0.0
        return float(1 / (1 + np.exp(-np.clip(self.model.temper * (total[k] - rest), -30, 30))))

    def _mixed(self, found: list[str], v: np.ndarray, s: np.ndarray, last: np.ndarray) -> Found:
        langs = self.model.langs
        sentences = Counter()
        weight = Counter()
        a = 0
        for b in [*(np.flatnonzero(last) + 1), len(s)]:
            if b > a:
                n = np.bincount(s[a:b], minlength=len(langs))
                sentences[int(n.argmax())] += 1
                a = b
        weight.update(s.tolist())
        main = max(sentences, key=lambda k: (sentences[k], weight[k], -k))
        edges = np.flatnonzero(np.r_[True, s[1:] != s[:-1], True])
        kept: list[list[int]] = []
        for a, b in zip(edges[:-1], edges[1:]):
            x = langs[s[a]]
            if sum(map(len, found[a:b])) >= MIN_CHARS if x in UNSPACED else b - a >= MIN_WORDS:
                if kept and kept[-1][0] == s[a]:
                    kept[-1][2] = b
                else:
                    kept.append([s[a], a, b])
        segments = [(langs[k], self._sure(v[a:b], k), " ".join(found[a : min(b, a + 12)])) for k, a, b in kept]
        return Found(langs[main], self._sure(v[s == main], main), segments if len({x for x, _, _ in segments}) > 1 else [])


def train(df: DataFrame, id_col: str, text_col: str, country_col: str, allowed: DataFrame, per_language: int = 500) -> Model:
    """A model from texts whose country has one language, at most ``per_language`` texts of each.

    A language that is nowhere alone is taught by the countries that allow it among others; the rounds of :func:`fit`
    take what belongs to those others out again.

    The sample is bounded by that parameter and the number of languages, and fixed by hashes of the ids.
    """
    single = allowed.groupBy("country").agg(F.min("lang").alias("lang"), F.count_distinct("lang").alias("n")).where("n = 1").select("country", "lang")
    single = single.unionByName(allowed.join(single.select("lang").distinct(), "lang", "left_anti").select("country", "lang"))
    rows = df.where(F.length(col(text_col)) >= 40).select(F.upper(F.trim(col(country_col))).alias("country"), col(text_col).alias("text"), F.xxhash64(F.lit(11), col(id_col)).alias("h"))
    order = Window.partitionBy("lang").orderBy("h", "text")
    sample = rows.join(F.broadcast(single), "country").select("lang", "h", "text").withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= per_language)
    got = sample.select("lang", "text").toPandas().sort_values(["lang", "text"])
    return fit(got["text"].tolist(), got["lang"].tolist())


def languages(df: DataFrame, id_col: str, text_col: str, country_col: str, allowed: DataFrame, min_letters: int = 20, per_language: int = 500) -> DataFrame:
    """Language of each text and of each stretch in texts of more than one: one row each, with a confidence.

    Columns: ``id_col``, ``seg_no``, ``lang``, ``confidence``, ``fits`` (whether the text's country, without
    outer blanks and in upper case, allows the language; false where ``allowed`` lacks the country),
    ``begins`` (first words of a stretch). ``seg_no`` 0 is the main language, that of most sentences; 1, 2,
    ... are the stretches, in order, of texts with stretches of more than one language. A stretch has six
    words or, in languages without spaces, twenty characters; shorter ones are passed over, so that names,
    codes, tags and short quotes part nothing.

    Each word is scored by the n-grams it has; sums of scores with a cost for every change of language give
    the best sequence of languages. Texts are read whole, at any length, in one pass without a shuffle.

    ``allowed`` (country, lang) must be small: more than 100,000 rows are refused. Null, empty and short
    texts (under ``min_letters`` letters) give no rows, as do texts of codes alone. Repeated rows repeat
    their result. Other columns are ignored.
    """
    pairs = allowed.select("country", "lang").where("country is not null and lang is not null").distinct()
    listed = pairs.limit(100_001).collect()
    if len(listed) > 100_000:
        raise ValueError("more than 100,000 pairs of country and language")
    fits = {(r["country"], r["lang"]) for r in listed}
    spark = df.sparkSession
    model = train(df, id_col, text_col, country_col, pairs, per_language)
    share = spark.sparkContext.broadcast((model, fits))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, fits = share.value
        reader = Reader(model)
        for b in batches:
            rows = []
            for i, c, x in zip(b["id"], b["country"], reader(b["text"].tolist(), min_letters)):
                if x is None:
                    continue
                rows.append((i, 0, x.main, x.confidence, (c, x.main) in fits, ""))
                rows += [(i, k, *s[:2], (c, s[0]) in fits, s[2]) for k, s in enumerate(x.segments, 1)]
            yield pd.DataFrame(rows, columns=["id", "seg_no", "lang", "confidence", "fits", "begins"])

    kind = df.select(col(id_col)).schema[0].dataType.simpleString()
    rows = df.where(F.length(col(text_col)) >= min_letters).select(col(id_col).alias("id"), F.upper(F.trim(col(country_col))).alias("country"), col(text_col).alias("text"))
    out = rows.mapInPandas(run, f"id {kind}, seg_no int, lang string, confidence double, fits boolean, begins string")
    return out.withColumnRenamed("id", id_col)
