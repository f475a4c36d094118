"""Token counts, token alignment and vector codes against the libraries and brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from meterdw.llm import alignment, token_counts, vector_codes
from meterdw.llm.common import table
from meterdw.llm.queries import QUERIES

TEXTS = [None, "", " ", "\n\t", "plain words, it's fine; THEY'LL go", "Straße ÉTÉ İstanbul ΣΑΣ ﬁn été Å",
         "日本語の文章 漢字かな", "emoji 😀😀 👩‍👩‍👧 ​ zero", "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>", "<s> </s> <unk> <0x41>",
         "nul\x00 \x1c\x1d\x85\xa0 odd blanks", "1234567890 ½ ² ٣", "under▁scored ▁ blank", "x" * 5000, "ab" * 3000 + " end",
         "aaa " * 2000, "don't 'S 'T we'Ve", "  two  blanks   three ", "tail ", "﻿mark �", "plain words, it's fine; THEY'LL go"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "k", 1, "p") for i, t in enumerate(TEXTS)] + [(None, "null key", "k", 1, "p"), (4, "known key", "k", 1, "p")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, key string, row int, pairs string").repartition(3)


# --- token counts -------------------------------------------------------------------------------

SEEDS = st.integers(0, 10 ** 6)
READER = Tokenizer.from_file(token_counts.vocabulary())


@pytest.fixture
def reader():
    return READER


def size(reader, text):
    return len(reader.encode(text or "", add_special_tokens=False).ids)


def test_counts_equal_the_library(docs, reader):
    got = Counter(tuple(r) for r in token_counts.counts(docs, limit=1000).collect())
    want = Counter((r.doc_id, len((r.text or "").encode()), n := size(reader, r.text), n > 1000) for r in docs.collect())
    assert got == want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aAeEbé ÉßΣσςİı'stTlL129½ª.,-–“ \t\n\x0b\x1c\xa0́ͅ日<|>😀ﬁ"), max_size=40))
def test_counts_of_odd_texts(text):
    assert token_counts.counter(token_counts.vocabulary()).count(text) == size(READER, text)


def by_rounds(symbols, ranks):
    symbols = list(symbols)
    while True:
        pairs = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        if not pairs:
            return len(symbols)
        _, i = min(pairs)
        symbols[i:i + 2] = ["".join(symbols[i:i + 2])]


@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=30), SEEDS)
def test_merging_takes_the_least_rank_leftmost_first(symbols, seed):
    rng = random.Random(seed)
    made = list("abc")
    ranks = {}
    while len(ranks) < 12:
        pair = (rng.choice(made), rng.choice(made))
        ranks.setdefault(pair, len(ranks))
        made.append("".join(pair))
    assert token_counts.merged_count(list(symbols), ranks) == by_rounds(symbols, ranks)


def test_a_full_memo_is_emptied(monkeypatch, reader):
    monkeypatch.setattr(token_counts, "MEMO_ENTRIES", 3)
    counter = token_counts.Counter(token_counts.vocabulary())
    text = "every word here is a new one, every word"
    assert counter.count(text) == size(reader, text) and len(counter.plain) <= 3


def test_counts_of_the_table(spark, folder, reader):
    want = {r.doc_id: size(reader, r.text) for r in table(spark, folder, "documents").collect()}
    assert {r.doc_id: r.n_tokens for r in QUERIES["op11_token_counts"](spark, folder).collect()} == want


# --- alignment ----------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def sides():
    """Ids and token bytes by the two libraries themselves."""
    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    other = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    values = {symbol: byte for byte, symbol in enumerate(token_counts.byte_symbols())}

    def piece(i):
        text = other.id_to_piece(i)
        return bytes([int(text[3:5], 16)]) if other.is_byte(i) else text.replace("▁", " ").encode()

    def cut(text):
        if not text:
            return [], [], [], []
        a, b = one.encode(" " + text, add_special_tokens=False).ids, other.encode(text)
        x, y = [bytes(values[c] for c in one.id_to_token(i)) for i in a], [piece(i) for i in b]
        whole = (" " + text).encode()
        return (a, b, x, y) if b"".join(x) == whole == b"".join(y) else ([], [], [], [])

    return cut


def walk(a, b, x, y):
    """Groups and links by walking both sides at once."""
    i = j = at = bt = 0
    links, groups, left, right = [], [], [], []
    while i < len(a) and j < len(b):
        links.append((a[i], b[j]))
        end_a, end_b = at + len(x[i]), bt + len(y[j])
        if end_a <= end_b:
            left.append(a[i])
        if end_b <= end_a:
            right.append(b[j])
        if end_a == end_b:
            groups.append((left, right))
            left, right = [], []
        i, at = (i + 1, end_a) if end_a <= end_b else (i, at)
        j, bt = (j + 1, end_b) if end_b <= end_a else (j, bt)
    return groups, links


def expected(rows, cut):
    found = [(key, *walk(*(parts := cut(text))), len(parts[0]), len(parts[1])) for key, text in rows]
    docs = Counter(pair for _, _, links, _, _ in found for pair in set(links))
    top = {}
    for (a, _), n in docs.items():
        top[a] = max(n, top.get(a, 0))
    out = Counter()
    for key, groups, links, n_a, n_b in found:
        listing = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out[(key, n_a, n_b, len(groups), len(links), sum(docs[p] == top[p[0]] for p in links), sum(docs[p] for p in links),
             hashlib.sha256(listing.encode()).hexdigest() if n_a else "")] += 1
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("limit", [alignment.BROADCAST_BYTES, 0])
def test_alignment_equals_a_walk(docs, sides, limit):
    got = alignment.align_corpus(docs, broadcast_bytes=limit).select(COLUMNS)
    assert Counter(map(tuple, got.collect())) == expected([(r.doc_id, r.text) for r in docs.collect()], sides)


def test_alignment_of_the_table(spark, folder, sides):
    rows = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    assert Counter(map(tuple, QUERIES["op12_alignment"](spark, folder).collect())) == expected(rows, sides)


@given(st.lists(st.integers(1, 5), min_size=1, max_size=40), SEEDS)
def test_pointers_end_where_both_cut(sizes, seed):
    rng = random.Random(seed)
    ends = np.cumsum(sizes)
    other = np.array(sorted({int(ends[-1]), *rng.sample(range(1, int(ends[-1]) + 1), rng.randint(0, int(ends[-1])))}))
    found = alignment.align(ends, other)
    both = sorted(set(ends.tolist()) & set(other.tolist()))
    assert found.group_a.tolist() == [sum(e < end for e in both) for end in ends.tolist()]
    assert found.group_b.tolist() == [sum(e < end for e in both) for end in other.tolist()]
    assert ends[found.last_a].tolist() == other[found.last_b].tolist() == both
    begins, starts = np.append(0, ends[:-1]), np.append(0, other[:-1])
    assert list(zip(found.link_a.tolist(), found.link_b.tolist())) == [
        (i, j) for i in range(len(ends)) for j in range(len(other)) if begins[i] < other[j] and starts[j] < ends[i]]


def test_long_texts_are_cut_where_no_token_spans(monkeypatch, sides):
    rng = random.Random(3)
    text = " ".join(rng.choice(["word", "Wörter", "1 2", "  gap", "x.y", "日本"]) for _ in range(400))
    monkeypatch.setattr(alignment, "PART_CHARS", 20)
    a, b, _, _ = sides(text)
    assert alignment.piece_side.__wrapped__(alignment.piece_vocabulary()).encode(text) == b
    assert alignment.byte_side(alignment.byte_vocabulary()).encode(text) == a


def test_no_texts(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.align_corpus(none).isEmpty() and token_counts.counts(none).isEmpty()


# --- vector codes -------------------------------------------------------------------------------

def brute_codes(rows, parts=4, entries=256, rounds=4):
    """(key, label, vector) rows by full distance tables."""
    kept = [(k, lab, v) for k, lab, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept = sorted(((k, lab, [int(np.floor(np.float64(x) * 1024)) for x in v]) for k, lab, v in kept),
                  key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    points = np.array([v for _, _, v in kept]).reshape(len(kept), parts, -1)
    books = points[:entries].transpose(1, 0, 2).copy()

    def nearest():
        away = ((points[:, :, None] - books[None]) ** 2).sum(3)
        return away.argmin(2), away.min(2).sum(1)

    for _ in range(rounds):
        index, _ = nearest()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = points[index[:, p] == e, p]
                if len(mine):
                    books[p, e] = mine.sum(0) // len(mine)
    index, error = nearest()
    labels = Counter()
    for (_, lab, _), one in zip(kept, error):
        labels[lab] += int(one)
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return Counter((k, "".join(f"{i:02x}" for i in row), int(one), labels[lab], sha)
                   for (k, lab, _), row, one in zip(kept, index, error))


def vector_rows():
    rng = random.Random(9)
    rows = [(i, rng.choice([0, 1, 2, None]), [rng.gauss(0, 0.1) for _ in range(16)]) for i in range(330)]
    rows += [(400 + i, 1, rows[i % 7][2]) for i in range(40)]             # copies: ties among codebook entries
    rows += [(500 + i, 2, [rng.choice([0.0, 0.5, -0.25])] * 16) for i in range(30)]
    rows += [(-1, 0, rows[3][2]), (-2, 0, rows[3][2]), (7, 5, [1.0] * 16), (None, None, [0.25] * 16), (600, 1, None),
             (601, 1, [None] + [0.0] * 15), (602, 1, [float("nan")] * 16), (603, 1, [float("inf")] + [0.1] * 15),
             (604, 3, [-0.0001] * 16), (605, 3, [100.0] * 16)]
    rng.shuffle(rows)
    return rows


KIND = "vec_id bigint, label int, embedding array<double>, key string, name string, vector int, code string"


def vectors(spark, rows):
    return spark.createDataFrame([(*row, "x", "y", 1, "z") for row in rows], KIND).repartition(3)


@pytest.mark.parametrize("limit", [vector_codes.BROADCAST_BYTES, 0])
def test_codes_equal_full_tables(spark, limit):
    rows = vector_rows()
    got = vector_codes.compress(vectors(spark, rows), broadcast_bytes=limit)
    assert Counter(map(tuple, got.collect())) == brute_codes(rows)


def test_few_and_no_vectors(spark):
    few = [(3, 1, [0.5, 0.1, 0.2, 0.3]), (1, None, [0.1] * 4), (3, 1, [0.5, 0.1, 0.2, 0.3])]
    assert Counter(map(tuple, vector_codes.compress(vectors(spark, few)).collect())) == brute_codes(few)
    assert vector_codes.compress(vectors(spark, [(1, 1, None)])).isEmpty()
    assert vector_codes.compress(vectors(spark, [])).isEmpty()
    huge = vector_codes.compress(vectors(spark, [(1, 1, [1e300] * 4), (2, 1, [-1e300] * 4)])).collect()
    assert [r.error for r in huge] == [0, 0]
    with pytest.raises(ValueError, match="one length"):
        vector_codes.compress(vectors(spark, [(1, 1, [0.0] * 4), (2, 1, [0.0] * 8)]))
    with pytest.raises(ValueError, match="one length"):
        vector_codes.compress(vectors(spark, [(1, 1, [0.0] * 6)]))


@settings(deadline=None)
@given(st.integers(1, 9), st.integers(1, 3), st.integers(1, 40), SEEDS)
def test_cells_keep_every_nearest_entry(entries, dim, width, seed):
    rng = random.Random(seed)
    book = np.array([[rng.randint(-20, 20) for _ in range(dim)] for _ in range(entries)])
    points = np.array([[rng.randint(-30, 30) for _ in range(dim)] for _ in range(50)])
    index, error = vector_codes.Nearest(book, width).assign(points)
    away = ((points[:, None] - book[None]) ** 2).sum(2)
    assert index.tolist() == away.argmin(1).tolist() and error.tolist() == away.min(1).tolist()


def test_remembered_cells_are_bounded(monkeypatch):
    monkeypatch.setattr(vector_codes, "CELLS", 4)
    monkeypatch.setattr(vector_codes, "BLOCK", 5)
    points = np.arange(200).reshape(-1, 1)
    search = vector_codes.Nearest(np.array([[3], [90], [150]]), 7)
    index, _ = search.assign(points)
    assert index.tolist() == [abs(np.array([3, 90, 150]) - p).argmin() for p in range(200)] and len(search.cells) <= 9
