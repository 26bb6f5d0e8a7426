"""Evaluation texts that occur in training text."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, cut, is_at_most, mix, words

#: Positions of a window of words that a mask looks at (1) or ignores (0). The full window
#: comes first; each of the others ignores a third of the words, so that every third is ignored once.
SPAN = 13
MASKS = (
    "1111111111111",
    "1101101101101",
    "1011011011011",
    "0110110110110",
)
#: Bits of the filter for each window of the items, which document windows must pass before they are joined; and
#: log2 of its smallest and largest size. Beyond the largest, more windows pass and fail at the join: nothing is lost.
BITS_A_WINDOW, LEAST_BITS, MOST_BITS = 64, 16, 30
#: Diagonals on either side of a hit that an alignment may move to, by words that one side has more.
GAP = 3


def _hashes(found: list[str], cache: dict[str, int]) -> np.ndarray:
    out = []
    for w in found:
        h = cache.get(w)
        if h is None:
            if len(cache) > 500_000:
                cache.clear()
            h = cache[w] = xxhash.xxh3_64_intdigest(w)
        out.append(h)
    return np.array(out, np.uint64)


def windows(h: np.ndarray, mask: str) -> np.ndarray:
    """One hash for each window of the words, of those positions that the mask looks at."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, len(mask), np.uint64)
    for i, m in enumerate(mask):
        if m == "1":
            out = mix(out ^ h[i : i + n])
    return out


def _seeds(df: DataFrame, id_col: str, text_col: str, masks: tuple[str, ...], bits: np.ndarray | None, name: str) -> DataFrame:
    """Rows (id, mask, position, hash) of all windows, or of those that pass the filter."""
    rows = df.where(col(text_col).isNotNull()).select(col(id_col).alias("id"), col(text_col).alias("text"))
    share = None if bits is None else df.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, int] = {}
        passes = None if share is None else share.value
        shift = np.uint64(64 - (len(passes).bit_length() + 2)) if passes is not None else None
        for b in batches:
            ids, out = b["id"].to_numpy(), []
            each = [words(t) for t in b["text"]]
            sizes = np.array([len(x) for x in each])
            if not sizes.sum():
                continue
            flat, ends = _hashes(list(chain.from_iterable(each)), cache), np.cumsum(sizes)
            doc = np.repeat(np.arange(len(each)), sizes)
            for m, mask in enumerate(masks):
                h = windows(flat, mask)
                at = np.arange(len(h))
                keep = at + len(mask) <= ends[doc[: len(h)]]  # no window reaches into the next text
                if passes is not None:
                    place = h >> shift
                    keep &= (passes[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                at = at[keep]
                d = doc[at]
                out.append(pd.DataFrame({name: ids[d], "mask": np.full(len(at), m, np.int32), f"{name}_at": (at - (ends - sizes)[d]).astype(np.int32), "h": h[at].view(np.int64)}))
            yield pd.concat(out)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInPandas(run, f"{name} {kind}, mask int, {name}_at int, h long")


def _filter(seeds: DataFrame) -> np.ndarray:
    """A bitmap of the hashes, ``BITS_A_WINDOW`` for each of them within the bounds of its size."""
    size = int(np.clip(np.ceil(np.log2(max(1, BITS_A_WINDOW * seeds.count()))), LEAST_BITS, MOST_BITS))
    cell = F.shiftrightunsigned("h", 67 - size).cast("int")
    bit = F.expr(f"shiftleft(1, cast(shiftrightunsigned(h, {64 - size}) & 7 as int))")
    got = seeds.select(cell.alias("cell"), bit.alias("bit")).groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (size - 3), np.uint8)
    out[got["cell"].to_numpy()] = got["bits"].to_numpy().astype(np.uint8)
    return out


def longest_run(same: np.ndarray) -> int:
    """Length of the longest run of true values."""
    edge = np.flatnonzero(np.diff(np.r_[0, same.astype(np.int8), 0]))
    return int((edge[1::2] - edge[::2]).max()) if len(edge) else 0


def align(docs: list[np.ndarray], items: list[np.ndarray], shifts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(matched, passage): of the best local alignment near a diagonal, the words that agree and its length in words.

    A word that agrees scores 1, one that is replaced, left out or put in costs 1; the alignment may move ``GAP``
    diagonals to either side of ``shifts`` (place in the document less place in the item). Many pairs at once.
    """
    n, wide = len(docs), 2 * GAP + 1
    matched, passage = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n:
        return matched, passage
    size, length = np.array([len(d) for d in docs]), np.array([len(x) for x in items])
    first, own = np.cumsum(size) - size, np.cumsum(length) - length
    doc, item = np.concatenate([*docs, np.zeros(1, np.uint64)]), np.concatenate([*items, np.zeros(1, np.uint64)])
    # score, agreeing words and length of the best alignment that ends in a cell
    state, best = np.zeros((3, n, wide), np.int64), np.zeros(n, np.int64)
    offset = np.arange(wide) - GAP
    for i in range(int(length.max())):
        live = np.flatnonzero(length > i)
        j = i + shifts[live, None] + offset
        ok = (j >= 0) & (j < size[live, None])
        same = ok & (doc[np.where(ok, first[live, None] + j, -1)] == item[own[live] + i][:, None])
        old = state[:, live]
        step = np.stack([np.where(same, 1, -1), same, np.ones_like(j)])
        new = old + step
        less = np.pad(old[:, :, 1:], ((0, 0), (0, 0), (0, 1))) + np.array([-1, 0, 1])[:, None, None]  # a word of the item left out
        new = np.where(less[0] > new[0], less, new)
        for b in range(1, wide):  # words put in between
            more = new[:, :, b - 1] + np.array([-1, 0, 1])[:, None]
            new[:, :, b] = np.where(more[0] > new[0, :, b], more, new[:, :, b])
        new = np.where((new[0] > 0) & ok, new, 0)
        state[:, live] = new
        top = new[0].argmax(1)
        score, agree, size_ = new[:, np.arange(len(live)), top]
        up = score > best[live]
        at = live[up]
        best[at], matched[at], passage[at] = score[up], agree[up], size_[up]
    return matched, passage


def _compare(min_match: float):
    """Verifies candidates (doc, item, shifts, hits, doc_text, item_text) by their whole texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, int] = {}
        for b in batches:
            for a in range(0, len(b), 500):
                p = b.iloc[a : a + 500]
                docs = [_hashes(words(t), cache) for t in p["doc_text"]]
                items = [_hashes(words(t), cache) for t in p["item_text"]]
                exact, pair, lead = np.zeros(len(p), np.int32), [], []
                for i, (d, x, shifts) in enumerate(zip(docs, items, p["shifts"])):
                    last = None
                    for s in np.sort(shifts):
                        lo, hi = max(0, -s), min(len(x), len(d) - s)
                        exact[i] = max(exact[i], longest_run(d[lo + s : hi + s] == x[lo:hi]))
                        if last is None or s - last > GAP:
                            pair.append(i)
                            lead.append(s)
                            last = s
                m, n = align([docs[i] for i in pair], [items[i] for i in pair], np.array(lead, np.int64))
                pair = np.array(pair, np.int64)
                good = np.where((n >= SPAN) & (m >= min_match * n - 1e-9), m, 0)
                matched, passage = np.zeros(len(p), np.int32), np.zeros(len(p), np.int32)
                np.maximum.at(matched, pair, good)
                on = good == matched[pair]
                np.maximum.at(passage, pair[on], np.where(good[on] > 0, n[on], 0))
                exact[exact < SPAN] = 0
                keep = (exact > 0) | (matched > 0)
                yield pd.DataFrame({"doc": p["doc"], "item": p["item"], "exact_words": exact, "matched": matched, "passage_words": passage, "hits": p["hits"]})[keep]

    return run


def leaks(docs: DataFrame, doc_id: str, doc_text: str, items: DataFrame, item_id: str, item_text: str, masks: tuple[str, ...] = MASKS, min_match: float = 0.7, broadcast_rows: int = 200_000) -> DataFrame:
    """Pairs of a document and an evaluation item of which it holds a passage.

    Texts are sequences of words (runs of letters or digits, without case), whatever stands between. Fixed
    masks lie over windows of 13 words and ignore some positions; windows of documents and items that agree
    at the other positions hit. Document windows first pass a bitmap of the items' hashes, as large as their number
    asks for, so only likely hits leave the scan; they are joined by hash. The texts of pairs with hits are then
    compared by their words: the exact run on the diagonal of each hit, and the best alignment around it, with
    words replaced, left out and put in.

    Returns one row a pair that has 13 exact words in a row, or an aligned passage of 13 words or more of which at
    least ``min_match`` agree: ``exact_words``, the longest run of 13 or more words in common, else 0;
    ``matched``, the words that agree in the best passage, and ``passage_words``, its length (0 where none is good
    enough); ``hits``, how many windows hit. Null, empty and shorter texts have no windows. Items of equal texts
    are reported each, rows of equal ids as one (of different texts under one id, each is compared and the most
    counts); an empty table gives an empty result; other columns are ignored.
    """
    item_rows = items.where(col(item_text).isNotNull()).select(col(item_id).alias("item"), col(item_text).alias("item_text"))
    item_seeds = cut(_seeds(item_rows, "item", "item_text", masks, None, "item"))
    doc_seeds = _seeds(docs, doc_id, doc_text, masks, _filter(item_seeds), "doc")
    hits = doc_seeds.join(item_seeds, ["mask", "h"]).groupBy("doc", "item").agg(F.collect_set(F.col("doc_at") - F.col("item_at")).alias("shifts"), F.count_distinct("item_at").cast("int").alias("hits"))
    hits = cut(hits)
    texts = docs.where(col(doc_text).isNotNull()).select(col(doc_id).alias("doc"), col(doc_text).alias("doc_text"))
    small = is_at_most(hits, broadcast_rows)
    both = texts.join(F.broadcast(hits) if small else hits, "doc").join(item_rows, "item")
    kinds = {f.name: f.dataType.simpleString() for f in both.schema}
    checked = both.select("doc", "item", "shifts", "hits", "doc_text", "item_text").mapInPandas(_compare(min_match), f"doc {kinds['doc']}, item {kinds['item']}, exact_words int, matched int, passage_words int, hits int")
    best = checked.groupBy("doc", "item").agg(F.max("exact_words").alias("exact_words"), F.max(F.struct("matched", "passage_words")).alias("m"), F.max("hits").alias("hits"))
    return best.select(F.col("doc").alias(doc_id), F.col("item").alias(item_id), "exact_words", "m.matched", "m.passage_words", "hits")
