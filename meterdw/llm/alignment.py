"""Aligns the tokens that two tokenizers make of the same bytes.

Every token points to the farthest-right token that it overlaps, itself included; of two that end together the second
tokenizer's counts as farther right. Following the pointers leads to the token that ends the stretch of bytes at whose
ends both tokenizers cut. All pointers of a batch jump at once: each takes over the pointer of its target, which doubles
the distance covered every time, until none moves. Tokens with the same last target form a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterdw.llm import packing
from meterdw.llm.common import BROADCAST_BYTES, mapped, staged, text_slices, texts
from meterdw.operators.joins import split_join

# long texts are cut before a blank between letters, where no token of either vocabulary spans
PART_CHARS = 1 << 18
PAIR_BYTES = 64


@dataclass
class Side:
    """A tokenizer: ids of a text with a blank before it, and the bytes of every id."""

    encode: Callable[[str], list[int]]
    tokens: list[bytes]

    def __post_init__(self):
        self.sizes = np.array([len(token) for token in self.tokens], np.int64)


def byte_vocabulary() -> str:
    return packing.vocabulary()


def piece_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def byte_side(path: str) -> Side:
    """The rank file; literals of added tokens are plain text here."""
    ranks = packing.encoder(path)
    highest = ranks.max_token_value
    tokens = [b""] * (highest + 1)
    for token in ranks.token_byte_values():
        tokens[ranks.encode_single_token(token)] = token
    return Side(lambda text: packing.token_ids(ranks.encode_ordinary, " " + text), tokens)


BETWEEN_LETTERS = regex.compile(r"(?<=\p{L}) (?=\p{L})")


@lru_cache(maxsize=2)
def piece_side(path: str) -> Side:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
    if any(a != "▁" and b == "▁" for piece in pieces for a, b in zip(piece, piece[1:])):
        raise ValueError(f"{path} has pieces with a blank after a letter: long texts cannot be cut before blanks")

    def encode(text: str) -> list[int]:
        ids: list[int] = []
        at = 0
        while len(text) - at > PART_CHARS and (cut := BETWEEN_LETTERS.search(text, at + PART_CHARS)):
            ids += model.encode(text[at:cut.start()])
            at = cut.end()  # the model puts a blank before the rest
        return ids + model.encode(text[at:] if at else text)

    return Side(encode, [bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
                         for i, piece in enumerate(pieces)])


def last_targets(pointers: np.ndarray) -> np.ndarray:
    """Where each chain of pointers ends; targets that point to themselves end it."""
    while True:
        ahead = pointers[pointers]
        if np.array_equal(ahead, pointers):
            return pointers
        pointers = ahead


@dataclass
class Aligned:
    """Token places of both sides: groups in order, and every overlapping pair."""

    group_a: np.ndarray     # group of every token, from 0 on
    group_b: np.ndarray
    last_a: np.ndarray      # whether the token ends its group
    last_b: np.ndarray
    link_a: np.ndarray      # places of the two tokens of every link, in the order of the bytes
    link_b: np.ndarray


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> Aligned:
    """Groups and links of two cuts of the same bytes, given where each token ends (rising, the last ends equal)."""
    count = len(ends_a)
    starts_a = np.concatenate([[0], ends_a[:-1]]) if count else ends_a
    far_b = np.searchsorted(ends_b, ends_a, "left")
    far_a = np.searchsorted(ends_a, ends_b, "left")
    itself = np.arange(len(ends_b)) + count
    longer = ends_a[far_a] > ends_b if count else np.zeros(0, bool)
    target = last_targets(np.concatenate([far_b + count, np.where(longer, far_a, itself)]))
    last_b = target[count:] == itself
    order = np.cumsum(last_b) - 1
    last_a = ends_a == ends_b[target[:count] - count]
    near_b = np.searchsorted(ends_b, starts_a, "right")
    many = far_b - near_b + 1
    link_a = np.repeat(np.arange(count), many)
    link_b = np.arange(len(link_a)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(near_b, many)
    return Aligned(order[target[:count] - count], order[target[count:] - count], last_a, last_b, link_a, link_b)


def group_texts(ids_a: np.ndarray, ids_b: np.ndarray, found: Aligned) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of both sides in the order of a listing, group by group and A before B, and which of them are B's."""
    before_a = np.searchsorted(found.group_b, found.group_a, "left")
    before_b = np.searchsorted(found.group_a, found.group_b, "right")
    order = np.empty(len(ids_a) + len(ids_b), np.int64)
    side = np.zeros(len(order), bool)
    at_b = np.arange(len(ids_b)) + before_b
    order[np.arange(len(ids_a)) + before_a] = 2 * ids_a + found.last_a
    order[at_b] = 2 * ids_b + found.last_b
    side[at_b] = True
    return order, side


def _unequal(text: str, a: list[int], b: list[int], one: Side, other: Side) -> bool:
    whole = b" " + text.encode()
    return (b"".join(map(one.tokens.__getitem__, a)) != whole
            or b"".join(map(other.tokens.__getitem__, b)) != whole)


def distinct_pairs(rows: np.ndarray, pairs: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """The different pairs of every row, in order of row and pair, and how often each occurs there."""
    order = np.lexsort((pairs, rows))
    rows, pairs = rows[order], pairs[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]) | (pairs[1:] != pairs[:-1])
    at = np.flatnonzero(first)
    return (rows[at], pairs[at]), np.diff(np.append(at, len(rows)))


def _per_row(rows: np.ndarray, count: int, weights=None) -> pa.Array:
    return pa.array(np.bincount(rows, weights, count).astype(np.int64))


def aligned_rows(docs: DataFrame, key: str, text: str, path_a: str, path_b: str) -> DataFrame:
    """Per text: its number, key, tokens, groups, links, digest; its different linked id pairs and how often each.

    A pair is written as id of A times the size of B's vocabulary, plus id of B.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        one, other = byte_side(path_a), piece_side(path_b)
        wide = len(other.tokens)
        listing = [f"{i}{end}" for i in range(len(one.tokens)) for end in ",|"]
        shift = len(listing)
        listing += [f"{i}{end}" for i in range(wide) for end in ",;"]
        number = TaskContext.get().partitionId() << 33
        for batch in text_slices(batches, "text"):
            rows_a, rows_b, flat_a, flat_b = [], [], [], []
            for row, value in enumerate(texts(batch, "text")):
                a, b = (one.encode(value), other.encode(value)) if value else ([], [])
                if _unequal(value, a, b, one, other):
                    a, b = [], []
                rows_a.append(len(a))
                rows_b.append(len(b))
                flat_a.append(np.array(a, np.int64))
                flat_b.append(np.array(b, np.int64))
            ids_a, ids_b = np.concatenate(flat_a), np.concatenate(flat_b)
            count = batch.num_rows
            of_a, of_b = np.repeat(np.arange(count), rows_a), np.repeat(np.arange(count), rows_b)
            found = align(np.cumsum(one.sizes[ids_a]), np.cumsum(other.sizes[ids_b]))
            order, side = group_texts(ids_a, ids_b, found)
            order[side] += shift
            words = list(map(listing.__getitem__, order.tolist()))
            ends = np.cumsum(np.add(rows_a, rows_b)).tolist()
            digests = [hashlib.sha256("".join(words[begin:end])[:-1].encode()).hexdigest() if end > begin else ""
                       for begin, end in zip([0, *ends], ends)]
            of_link = of_a[found.link_a]
            pairs, often = distinct_pairs(of_link, ids_a[found.link_a] * wide + ids_b[found.link_b])
            bounds = pa.array(np.searchsorted(pairs[0], np.arange(count + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(number + np.arange(count)), batch.column("key"), pa.array(rows_a, pa.int64()),
                 pa.array(rows_b, pa.int64()), _per_row(of_b[found.last_b], count), _per_row(of_link, count),
                 pa.array(digests), pa.ListArray.from_arrays(bounds, pa.array(pairs[1])),
                 pa.ListArray.from_arrays(bounds, pa.array(often.astype(np.int32)))],
                ["row", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "often"])
            number += count

    return mapped(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), run,
                  f"row bigint, key {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                  "groups_sha256 string, pairs array<bigint>, often array<int>")


def pair_counts(rows: DataFrame, wide: int) -> DataFrame:
    """Per id pair: in how many texts it is linked, and whether none of its A id's pairs is in more.

    Both tables are bounded by the vocabularies: the pairs by what can overlap, the highest counts by A's ids.
    """
    linked = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))
    linked = staged(linked, "pairs")
    first = F.expr(f"pair div {wide}")
    highest = linked.groupBy(first.alias("first")).agg(F.max("docs").alias("most"))
    return linked.join(highest, first == F.col("first")).select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def align_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", path_a: str | None = None,
                 path_b: str | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per text: key, n_a, n_b (tokens), n_groups, n_links, n_best, count_sum, groups_sha256, pairs, often.

    `pairs` lists the different linked id pairs of the text (A's id times the size of B's vocabulary, plus B's id), `often`
    how many links each stands for. A pair's count is the number of texts, repeated rows included, that hold it linked.
    Null and empty texts have no tokens, nor have texts whose joined token bytes on either side differ from a blank and
    the text: zeros, empty lists and an empty digest. Rows with equal or null keys are aligned apart. Very long texts are
    tokenised in parts and aligned as one. An empty table gives no rows. Other columns are not read.

    The counts are broadcast while their counted rows come to `broadcast_bytes`; beyond, they are shuffled, with pairs of
    very many texts cut into pieces.
    """
    path_a, path_b = path_a or byte_vocabulary(), path_b or piece_vocabulary()
    rows = staged(aligned_rows(docs, key, text, path_a, path_b), "aligned")
    counts = staged(pair_counts(rows, len(piece_side(path_b).tokens)), "pair-counts")
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "often")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.often").alias("often"))
    if counts.count() * PAIR_BYTES <= broadcast_bytes:
        counted = links.join(F.broadcast(counts), "pair")
    else:
        counted = split_join(links, counts, "pair", "inner", spread_by=["row"])
    sums = counted.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("often")).otherwise(0)).cast("bigint").alias("n_best"),
        F.sum(F.col("often") * F.col("docs")).alias("count_sum"))
    none = F.lit(0).cast("bigint")
    return rows.join(sums, "row", "left").select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256", "pairs", "often")
