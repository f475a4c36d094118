"""Packs tokenised texts into windows of equal length: concatenate and cut.

First pass: every task tokenises its texts and notes how many tokens of its partition came before each. Second pass:
a prefix sum over the partitions' totals turns those counts into places in one long row of tokens, which fixed windows
cut. A boundary record per partition says in which window it begins and ends; neighbours share that window, and its
pieces fit together without any exchange of tokens.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterdw.llm.common import mapped, staged, text_slices, texts

WINDOW = 1024
END_ID = 0
# long texts are tokenised in parts; the pattern of the vocabulary always splits before a blank between two letters
PART_CHARS = 1 << 18
SAFE_CUT = regex.compile(r"(?<=\p{L}) (?=\p{L})")


def vocabulary() -> str:
    """The rank file of the vocabulary that byte_bpe_50k.json holds too; its ids are the same, it is read faster.

    Tokens added to the vocabulary are only in the JSON file beside it.
    """
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    beside = Path(path).with_suffix(".json")
    added = json.loads(beside.read_text("utf-8"))["added_tokens"] if beside.exists() else []
    for token in added:
        if SAFE_CUT.search(token["content"]) or any(
                token.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added token {token} is not a plain literal")
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={token["content"]: token["id"] for token in added})


def with_added(path: str) -> Callable[[str], list[int]]:
    """Encodes a text; the literals of added tokens have their own ids, as by `tokenizers`."""
    whole = encoder(path)
    added = whole.special_tokens_set

    def encode(text: str) -> list[int]:
        if any(token in text for token in added):
            return whole.encode(text, allowed_special="all")
        return whole.encode_ordinary(text)

    return encode


def token_ids(encode, text: str) -> list[int]:
    ids: list[int] = []
    at = 0
    while len(text) - at > PART_CHARS:
        cut = SAFE_CUT.search(text, at + PART_CHARS)
        if not cut:
            break
        ids += encode(text[at:cut.start()])
        at = cut.start()
    return ids + encode(text[at:] if at else text)


def tokenised(docs: DataFrame, key: str, text: str, path: str, end_id: int) -> DataFrame:
    """First pass. Per text: key, part, tokens of the part before it, its tokens with the end, the ids."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        encode = with_added(path)
        part, before = TaskContext.get().partitionId(), 0
        for batch in text_slices(batches, "text", 1 << 20):
            rows = [np.array([*token_ids(encode, value), end_id], "<u4") for value in texts(batch, "text")]
            lengths = np.array([len(row) for row in rows], np.int64)
            starts = before + np.cumsum(lengths) - lengths
            before += int(lengths.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(np.full(len(rows), part, np.int32)), pa.array(starts),
                 pa.array(lengths), pa.array([row.tobytes() for row in rows], pa.binary())],
                ["key", "part", "before", "doc_tokens", "ids"])

    return mapped(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), run,
                  f"key {kind}, part int, before bigint, doc_tokens bigint, ids binary")


def boundaries(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """A boundary record per partition: its place in the whole, and the windows it begins and ends in.

    One row per task of the first pass, so the single ordered window over them stays small.
    """
    totals = tokens.groupBy("part").agg(F.max(F.col("before") + F.col("doc_tokens")).alias("total"))
    upto = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    return totals.withColumn("base", upto - F.col("total")).selectExpr(
        "part", "base", "total", f"base div {window} as first_sequence", f"base % {window} as first_offset",
        f"(base + total - 1) div {window} as last_sequence", f"(base + total - 1) % {window} as last_offset")


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, path: str | None = None,
         end_id: int = END_ID) -> DataFrame:
    """One row per piece: key, start, length, doc_tokens, sequence_id, offset, ids (little-endian, 32 bits each).

    Null and empty texts are the end id alone. Rows with equal or null keys are packed apart, each as it stands. Long
    texts give as many pieces as windows they touch. An empty table gives no pieces. Other columns are not read, so
    their names may clash. Only the last window is short; `sequences` fills it up with the end id.
    """
    tokens = staged(tokenised(docs, key, text, path or vocabulary(), end_id), "tokens")
    placed = (tokens.join(F.broadcast(boundaries(tokens, window).select("part", "base")), "part")
              .withColumn("place", F.col("base") + F.col("before")))
    cut = f"""transform(sequence(place div {window}, (place + doc_tokens - 1) div {window}), w -> struct(
        greatest(w * {window} - place, 0L) as start,
        least((w + 1) * {window}, place + doc_tokens) - greatest(w * {window}, place) as length,
        w as sequence_id,
        greatest(place - w * {window}, 0L) as offset,
        substring(ids, cast(4 * greatest(w * {window} - place, 0L) + 1 as int),
                  cast(4 * (least((w + 1) * {window}, place + doc_tokens) - greatest(w * {window}, place)) as int))
            as ids))"""
    return (placed.select("key", "doc_tokens", F.explode(F.expr(cut)).alias("piece"))
            .select(F.col("key").alias(key), "piece.start", "piece.length", "doc_tokens", "piece.sequence_id",
                    "piece.offset", "piece.ids"))


def sequences(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """The windows themselves: sequence_id, tokens used, ids padded with zeros to the full length.

    A window has at most `window` pieces, so no group is large.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"), parts.alias("parts"))
            .selectExpr("sequence_id", "used",
                        "rpad(aggregate(parts, cast('' as binary), (all, p) -> concat(all, p.ids)), "
                        f"{4 * window}, X'00') as ids"))
