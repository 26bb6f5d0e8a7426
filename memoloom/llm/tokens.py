"""Token ids of every text by a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import importlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, cut

#: Where the vocabularies lie, unless a caller names another folder.
FOLDER = "/opt/tokenizers"
#: Fixed value: how byte_bpe_50k splits a text before its merges.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A border between two characters at which any run of PATTERN ends one piece and begins another, whatever
#: stands elsewhere: white space follows something else; a letter or digit run ends before another class.
SURE = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\p{L}\s])|(?<=\p{N})(?=[^\p{N}\s])")


def _vocabulary(folder: str, name: str) -> Path:
    path = Path(folder, f"{name}.tiktoken")
    return path if path.exists() else Path(importlib.import_module("public_tokenizers").path(path.name))


@lru_cache(maxsize=2)
def encoding(folder: str = FOLDER, name: str = "byte_bpe_50k"):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, _vocabulary(folder, name).open("rb"))}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def stitch(text: str, at: int, until: int) -> int:
    """The first sure border at ``at`` or after it, as the text up to ``until`` shows; -1 if there is none."""
    if at <= 0:
        return 0
    found = SURE.search(text, at, until)
    return found.start() if found else -1


def pieces(text: str, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Spans of the text that can be encoded apart, each about ``chunk`` characters.

    Neighbouring chunks share ``overlap`` characters and both split them; where their pieces meet for the
    first time is the seam. A chunk without a seam in its overlap goes on into the next.
    """
    cuts = [0]
    for at in range(chunk, len(text), chunk):
        seam = stitch(text, at, min(len(text), at + overlap))
        if seam > cuts[-1]:
            cuts.append(seam)
    return list(zip(cuts, [*cuts[1:], len(text)]))


def _span(text: str, no: int, chunk: int, overlap: int) -> str | None:
    """Piece ``no`` of a text, by looking at the overlaps of that chunk alone; None if it has no seam."""
    begin = stitch(text, no * chunk, min(len(text), no * chunk + overlap))
    if begin < 0:
        return None
    end, k = -1, no + 1
    while end < 0:
        if k * chunk >= len(text):
            end = len(text)
        else:
            end = stitch(text, k * chunk, min(len(text), k * chunk + overlap))
            k += 1
    return text[begin:end]


def encode_texts(
    df: DataFrame, id_col: str, text_col: str, tokenizer: str = "byte_bpe_50k", folder: str = FOLDER, chunk: int = 8_192, overlap: int = 1_024
) -> DataFrame:
    """``id_col`` and ``ids``, the token ids of each text, without special tokens.

    Texts of up to ``chunk`` characters are encoded where they are read, without a shuffle. Longer ones are
    cut into chunks with overlaps; each chunk finds, from its overlaps alone, the seams at which its pieces
    and its neighbour's resynchronise, the spans between the seams are spread over the tasks and encoded, and
    their ids are joined in order again. The result is that of encoding the whole text at once.

    A null and an empty text give an empty list. Strings of special tokens are ordinary text. Lone
    surrogates can't occur in Spark's strings. Every row gives one row, repeated rows too; other columns are
    ignored. The decoder is :func:`decode`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(folder, tokenizer)
        for b in batches:
            *rest, texts = b.columns
            sizes, flat = [0], []
            for t in texts.to_pylist():
                if t:
                    flat += enc.encode_ordinary(t)
                sizes.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([*rest, ids], names=[*b.schema.names[:-1], "ids"])

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, doc, text in zip(*(c.to_pylist() for c in b.columns)):
                out = [(row, doc, no, s) for no in range(-(-len(text) // chunk)) if (s := _span(text, no, chunk, overlap)) is not None]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), b.schema.field(1).type, pa.int32(), pa.string()))], names=["row", "doc", "no", "text"])

    rows = df.select(col(id_col).alias("doc"), col(text_col).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    long = F.length("text") > chunk
    short = rows.where(~F.coalesce(long, F.lit(False))).mapInArrow(run, f"doc {kind}, ids array<int>")
    parts = rows.where(long).withColumn("row", F.monotonically_increasing_id()).select("row", "doc", "text").mapInArrow(spans, f"row long, doc {kind}, no int, text string")
    coded = parts.repartition(F.col("row"), F.col("no")).mapInArrow(run, f"row long, doc {kind}, no int, ids array<int>")
    whole = coded.groupBy("row", "doc").agg(F.sort_array(F.collect_list(F.struct("no", "ids"))).alias("parts")).select("doc", F.flatten("parts.ids").alias("ids"))
    return short.unionByName(whole).select(F.col("doc").alias(id_col), "ids")


def decode(ids: list[int], tokenizer: str = "byte_bpe_50k", folder: str = FOLDER) -> str:
    """The text of a list of ids: the raw bytes of its tokens joined, then read as UTF-8."""
    return b"".join(encoding(folder, tokenizer).decode_tokens_bytes(ids)).decode("utf-8")


def token_counts(df: DataFrame, id_col: str, ids_col: str = "ids") -> DataFrame:
    """Number of tokens by id and in all, as a share of the corpus; texts are encoded once, the sum is one row."""
    n = cut(df.select(col(id_col).alias(id_col), F.size(ids_col).cast("long").alias("n_tokens")))
    total = n.agg(F.sum("n_tokens").alias("total")).scalar()
    return n.withColumn("share", F.col("n_tokens") / F.nullif(total, F.lit(0)))
