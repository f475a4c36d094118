"""Counts the tokens of texts by byte-pair merging, without making the tokens.

A vocabulary whose words end in a marked symbol splits every text into words first, and white space parts words for good.
Each word starts as a linked list of byte symbols; a heap holds its adjacent pairs by rank, and the pair of the least
rank, leftmost first, is merged until none is left. The count is the number of symbols at the start less the merges. A
task remembers the counts of what stands between blanks, so that a common word is merged once.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterdw.llm.common import mapped, text_slices, texts

LIMIT = 2048
# what a task remembers: so many strings, none longer than this
MEMO_ENTRIES = 1 << 19
MEMO_CHARS = 64
# the splitting of the vocabulary, on texts of characters that no normal form changes and whose classes are old and settled
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SETTLED = regex.compile(r"[\t-\r\x20-\x7e\xa1-\u017f\u2013\u2014\u2018\u2019\u201c-\u201e\u2026]*+")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = {byte: chr(256 + i) for i, byte in enumerate(b for b in range(256) if b not in set(plain))}
    return [moved.get(byte) or chr(byte) for byte in range(256)]


def merged_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Number of symbols left when pairs are merged by rank, the leftmost of equal rank first."""
    size = count = len(symbols)
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    heap = [(rank, at) for at in range(size - 1) if (rank := ranks.get((symbols[at], symbols[at + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        rank, left = heapq.heappop(heap)
        right = after[left]
        # a pair that one of its symbols has left since has another rank, or none
        if not symbols[left] or right >= size or ranks.get((symbols[left], symbols[right])) != rank:
            continue
        symbols[left] += symbols[right]
        symbols[right] = ""
        count -= 1
        follower = after[left] = after[right]
        if follower < size:
            before[follower] = left
            if (rank := ranks.get((symbols[left], symbols[follower]))) is not None:
                heapq.heappush(heap, (rank, left))
        leader = before[left]
        if leader >= 0 and (rank := ranks.get((symbols[leader], symbols[left]))) is not None:
            heapq.heappush(heap, (rank, leader))
    return count


class Merged(dict):
    """Token counts of words, remembered; `symbols` gives a word's bytes as symbols."""

    def __init__(self, symbols: Callable[[str], list[str]], ranks: dict[tuple[str, str], int], end: str):
        super().__init__()
        self.symbols, self.ranks, self.end = symbols, ranks, end

    def __missing__(self, word: str) -> int:
        symbols = self.symbols(word)
        symbols[-1] += self.end
        found = merged_count(symbols, self.ranks)
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[word] = found
        return found


class Counter:
    """Counts tokens as the library reads the vocabulary.

    A text of settled characters is lower-cased and split here; any other goes through the library's own normaliser and
    splitter, which show every byte of a word by its symbol. Both only split: the merging is done here.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        if model["type"] != "BPE" or any(model.get(k) for k in (
                "dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError(f"{path} is not a plain byte-pair vocabulary")
        end = model["end_of_word_suffix"] or ""
        pairs = (pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"])
        ranks = {(left, right): rank for rank, (left, right) in enumerate(pairs)}
        symbols = byte_symbols()
        if missing := {s + e for s in symbols for e in ("", end)} - set(model["vocab"]):
            raise ValueError(f"{path} lacks the symbols {sorted(missing)[:3]}")
        self.plain = Merged(lambda word: [symbols[byte] for byte in word.encode()], ranks, end)
        self.shown = Merged(list, ranks, end)
        whole = Tokenizer.from_file(path)
        self.normal, self.split = whole.normalizer, whole.pre_tokenizer
        splits = content["pre_tokenizer"].get("pretokenizers", [])
        self.known = (content["normalizer"].get("normalizers") == NORMALIZER and len(splits) == 2
                      and splits[0]["pattern"] == {"Regex": WORDS})
        self.words = regex.compile(WORDS)
        added = content["added_tokens"]
        if any(regex.search(r"\s", t["content"]) or t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]
               for t in added):
            raise ValueError(f"{path} has added tokens that are not plain literals")
        literals = sorted((t["content"] for t in added), key=len, reverse=True)
        self.literal = regex.compile("|".join(map(regex.escape, literals)) or r"(?!)")

    def _count(self, text: str) -> int:
        """Tokens of a text without added tokens."""
        if self.known and SETTLED.fullmatch(text):
            return sum(map(self.plain.__getitem__, self.words.findall(text.lower())))
        shown = self.split.pre_tokenize_str(self.normal.normalize_str(text))
        return sum(self.shown[word] for word, _ in shown)

    def count(self, text: str) -> int:
        """Literals of added tokens count one each; the stretches between them are read apart."""
        parts = self.literal.split(text)
        return len(parts) - 1 + sum(self._count(part) for part in parts if part)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def counts(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
           limit: int = LIMIT) -> DataFrame:
    """One row per text: key, n_bytes (UTF-8), n_tokens, over_limit (more than `limit` tokens).

    Null and empty texts have no bytes and no tokens. Literals of added tokens count as one token, as the library reads
    them. Rows with equal or null keys are counted apart, each as it stands. A very long text is counted word by word;
    a very long word is one list and one heap. An empty table gives no rows. Other columns are not read, so their names
    may clash.
    """
    path = path or vocabulary()
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        count = counter(path).count
        for batch in text_slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n_bytes"),
                 pa.array([count(value) for value in texts(batch, "text")], pa.int64())],
                ["key", "n_bytes", "n_tokens"])

    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
    rows = mapped(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), size.alias("n_bytes")), run,
                  f"key {kind}, n_bytes bigint, n_tokens bigint")
    return rows.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
