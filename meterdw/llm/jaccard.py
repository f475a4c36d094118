"""Exact join of texts on the Jaccard similarity of their five-word shingles, by set relations.

1. Equal sets become one set with members. Sets are named by a 64-bit hash.
2. Every set lists its rarest shingles (as many as a link needs to share one of) under each of them, with its size and
   the shingle's position. Rarity is read off a fixed share of the texts: it orders shingles, and any order is exact.
3. Index lists are skipped by position: sorted by size and position, an entry (or a whole block of entries alike in
   both, in lists of frequent shingles) is skipped when no overlap can still reach what the sizes ask for.
4. Every candidate has a sketch: the parity of the number of its shingles in each of some buckets. Buckets in which two
   sketches differ are a lower bound of the shingles in which the sets differ, which discards most pairs unseen.
5. Candidates that hang together form groups, whose sets are sent to one place once. There a set's answers are derived
   from those of a similar set: overlaps with a leader bound the overlap of any two others from below and above, and
   only pairs that the bounds leave open, and that no found link connects already, are compared.
6. A large group is cut into parts of bounded size. Parts are solved alone, then their clusters' leaders against each
   other, until little changes; then all sets outside the largest cluster meet every part. Near copies of one text fall
   into one cluster in the first rounds, so the work stays in proportion to the group, not to its square.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterdw.llm.common import mapped, mix, set_id, shingle_sets, small, staged, text_slices
from meterdw.llm.components import components

PERCENT = 80
# one text in SAMPLE shows how frequent shingles are; those seen in RARE or more of these go last in the order
SAMPLE = 16
RARE = 3
FREQUENT_MOST = 2_000_000
# sets in a part of a group, and in one meeting of two parts
PART = 64
MEETING = 32
# cold index lists are short (frequent shingles are apart); a longer one is treated like those of frequent shingles
COLD_MOST = 2048


def needed(n: np.ndarray) -> np.ndarray:
    """The least overlap of two sets whose sizes add up to n."""
    return (PERCENT * n + 99 + PERCENT) // (100 + PERCENT)


def prefix(n: int) -> int:
    return n - (PERCENT * n + 99) // 100 + 1


def _frequent(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of RARE or more of the sampled texts, ascending, with their counts; at most FREQUENT_MOST."""

    def run(batches):
        seen: set[int] = set()
        for batch in text_slices(batches, "text"):
            sets = []
            for tokens in shingle_sets(batch.column("text")):
                if (name := set_id(tokens)) not in seen:
                    seen.add(name)
                    sets.append(tokens)
            if sets:
                values, counts = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], ["token", "c"])

    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).select("text")
    counts = staged(mapped(sample, run, "token bigint, c bigint").groupBy("token")
                    .agg(F.sum("c").alias("c")).where(F.col("c") >= RARE), "frequent")
    least = RARE
    while counts.where(F.col("c") >= least).count() > FREQUENT_MOST:
        least *= 2
    rows = counts.where(F.col("c") >= least).toArrow()
    tokens = rows["token"].to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], rows["c"].to_numpy()[order]


def _members(docs: DataFrame) -> DataFrame:
    """key, mark, n, set of every text; without words n is 0 and set null."""
    kind = docs.schema["key"].dataType.simpleString()

    def run(batches):
        for batch in text_slices(batches, "text"):
            sets = shingle_sets(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("mark"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_id(s) if len(s) else None for s in sets], pa.int64())], ["key", "mark", "n", "set"])

    return staged(mapped(docs, run, f"key {kind}, mark bigint, n bigint, set bigint"), "members")


def _postings(docs: DataFrame, tokens: np.ndarray, counts: np.ndarray) -> DataFrame:
    """token, spread, set, at (size and position), for the prefix of every set; each task names a set once.

    Entries of frequent shingles are marked by a spread of 1 and more, which deals them to several tasks.
    """
    frequent = docs.sparkSession.sparkContext.broadcast((tokens, counts))

    def run(batches):
        known, often = frequent.value
        seen: set[int] = set()
        for batch in text_slices(batches, "text"):
            out = []
            for found in shingle_sets(batch.column("text")):
                if not len(found) or (name := set_id(found)) in seen:
                    continue
                seen.add(name)
                n, take = len(found), prefix(len(found))
                spread = np.zeros(n, np.int64)
                if len(known):
                    place = np.minimum(np.searchsorted(known, found), len(known) - 1)
                    hot = known[place] == found
                    if hot.any():
                        last = np.lexsort((found[hot], often[place[hot]]))
                        found = np.concatenate([found[~hot], found[hot][last]])
                        spread[n - int(hot.sum()):] = 1 + name % 61
                out.append((found[:take], spread[:take], np.full(take, name),
                            (np.int64(n) << np.int64(32)) + np.arange(take)))
            if out:
                columns = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0].view(np.int64)), *map(pa.array, columns[1:])], ["token", "spread", "set", "at"])

    return mapped(docs.select("text"), run, "token bigint, spread bigint, set bigint, at bigint")


def _reach(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether entries of one list (a not larger than b) can still have the overlap that their sizes ask for."""
    mask = np.int64((1 << 32) - 1)
    na, nb, pa_, pb = a >> 32, b >> 32, a & mask, b & mask
    return (100 * na >= PERCENT * nb) & (np.minimum(na - pa_, nb - pb) >= needed(na + nb))


def _candidates(postings: DataFrame) -> DataFrame:
    """Pairs (token null, a, b) from short lists, and the entries (token, set, at) of frequent shingles, staged."""

    def pairs(token, name, at):
        left, right, step = [], [], 1
        run_at = np.arange(len(token))
        while len(run_at := run_at[run_at < len(token) - step]):
            run_at = run_at[token[run_at] == token[run_at + step]]
            fit = run_at[_reach(at[run_at], at[run_at + step]) & (name[run_at] != name[run_at + step])]
            left.append(np.minimum(name[fit], name[fit + step]))
            right.append(np.maximum(name[fit], name[fit + step]))
            step += 1
        found = np.unique(np.stack([np.concatenate(left), np.concatenate(right)]), axis=1) if left else np.empty(
            (2, 0), np.int64)
        return found

    def emit(token, a, b):
        return pa.RecordBatch.from_arrays([pa.array(token, pa.int64()), pa.array(a, pa.int64()),
                                           pa.array(b, pa.int64())], ["token", "a", "b"])

    def run(batches):
        held = [np.empty(0, np.int64) for _ in range(4)]
        long = None
        for batch in batches:
            new = [batch.column(c).to_numpy() for c in ("token", "spread", "set", "at")]
            hot = new[1] > 0
            if hot.any():
                yield emit(new[0][hot], new[2][hot], new[3][hot])
            new = [c[~hot] for c in new]
            if not len(new[0]):
                continue
            if long is not None:
                same = new[0] == long
                yield emit(new[0][same], new[2][same], new[3][same])
                if same.all():
                    continue
                new, long = [c[~same] for c in new], None
            held = [np.concatenate([h, c]) for h, c in zip(held, new)]
            ends = np.flatnonzero(held[0] != held[0][-1])
            cut = int(ends[-1]) + 1 if len(ends) else 0
            done, held = [h[:cut] for h in held], [h[cut:] for h in held]
            if len(held[0]) > COLD_MOST:
                long = held[0][0]
                yield emit(held[0], held[2], held[3])
                held = [h[:0] for h in held]
            yield from lists(done)
        yield from lists(held)

    def lists(columns):
        token, _, name, at = columns
        if not len(token):
            return
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (name[1:] != name[:-1])
        token, name, at = token[fresh], name[fresh], at[fresh]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        size = np.diff(np.append(first, len(token)))
        of = np.repeat(size, size)
        big = of > COLD_MOST
        if big.any():
            yield emit(token[big], name[big], at[big])
        some = (of > 1) & ~big
        found = pairs(token[some], name[some], at[some])
        if found.shape[1]:
            yield emit([None] * found.shape[1], found[0], found[1])

    dealt = postings.repartition("token", "spread").sortWithinPartitions("token", "spread", "at", "set")
    return staged(mapped(dealt, run, "token bigint, a bigint, b bigint"), "candidates")


def _blocks(entries: DataFrame) -> DataFrame:
    """For lists of frequent shingles: (token, at, node), the blocks that are not skipped and what they hang on to.

    A block is all entries of a list with one size and one position; there are as many as sizes and positions, however
    many entries. Blocks that can reach each other (or more than one entry in itself) share a node.
    """
    alike = entries.groupBy("token", "at").agg((F.min("a") != F.max("a")).alias("several"))
    by_size = alike.groupBy("token", F.shiftright("at", 32).alias("n")).agg(
        F.collect_list(F.struct("at", "several")).alias("blocks"))

    def solve(token, at, several):
        order = np.lexsort((at,))
        at, several = at[order], several[order]
        root = np.arange(len(at))
        alive = several & _reach(at, at)
        for i in range(len(at) - 1):
            upto = int(np.searchsorted(at, ((100 * (at[i] >> 32)) // PERCENT + 1) << 32))
            near = i + 1 + np.flatnonzero(_reach(at[i], at[i + 1:upto]))
            if len(near):
                alive[i] = alive[near] = True
                merged = np.unique(root[np.append(near, i)])
                if len(merged) > 1:
                    root[np.isin(root, merged)] = merged[0]
        node = mix(np.full(len(at), token, np.int64).view(np.uint64) + mix(at[root].view(np.uint64))).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.full(int(alive.sum()), token)), pa.array(at[alive]),
                                           pa.array(node[alive])], ["token", "at", "node"])

    def run(batches):
        token, at, several = None, [], []
        for batch in batches:
            for one, blocks in zip(batch.column("token").to_pylist(), batch.column("blocks").to_pylist()):
                if one != token and at:
                    yield solve(token, np.array(at, np.int64), np.array(several, bool))
                    at, several = [], []
                token = one
                at += [b["at"] for b in blocks]
                several += [b["several"] for b in blocks]
        if at:
            yield solve(token, np.array(at, np.int64), np.array(several, bool))

    dealt = by_size.select("token", "n", "blocks").repartition("token").sortWithinPartitions("token", "n")
    return staged(mapped(dealt.select("token", "blocks"), run, "token bigint, at bigint, node bigint"), "blocks")


def sketch(tokens: np.ndarray) -> bytes:
    """The parity of the tokens in each bucket; there are twice as many buckets as tokens, or somewhat more."""
    bits = max(64, 1 << int(2 * len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def apart_at_least(one: bytes, other: bytes) -> int:
    """A lower bound of the number of tokens that are in one of two sets only. The longer sketch is folded."""
    a, b = sorted((np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8)), key=len)
    return int(np.bitwise_count(a ^ np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)).sum())


def _near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches leave it open that they link."""

    def run(batches):
        for batch in batches:
            size, one, other = (batch.column(c).to_pylist() for c in ("n", "one", "other"))
            least = needed(np.array(size, np.int64))
            yield batch.filter(pa.array([(n - apart_at_least(x, y)) // 2 >= k for n, x, y, k in zip(
                size, one, other, least.tolist())], pa.bool_())).select(["a", "b"])

    of = sets.select("set", "n", "sketch")
    both = (pairs.join(of.toDF("a", "size_a", "one"), "a").join(of.toDF("b", "size_b", "other"), "b")
            .select("a", "b", (F.col("size_a") + F.col("size_b")).alias("n"), "one", "other"))
    return staged(mapped(both, run, "a bigint, b bigint"), "near")


def _sets(docs: DataFrame, members: DataFrame, names: DataFrame) -> DataFrame:
    """set, n, sketch, tokens of the named sets, from the text of one member each."""
    one = (members.join(small(names.select("set"), 16), "set", "left_semi")
           .groupBy("set").agg(F.min(F.struct("key", "mark")).alias("m")))
    wanted = small(staged(one.select("set", F.col("m.key").alias("one_key"), F.col("m.mark").alias("one_mark")),
                          "wanted"), 48)
    rows = docs.join(wanted, (docs["mark"] == wanted["one_mark"]) & docs["key"].eqNullSafe(wanted["one_key"]))

    def run(batches):
        seen: set[int] = set()
        for batch in text_slices(batches, "text"):
            for name, tokens in zip(batch.column("set").to_pylist(), shingle_sets(batch.column("text"))):
                if name not in seen and len(tokens) and set_id(tokens) == name:
                    seen.add(name)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([len(tokens)]), pa.array([sketch(tokens)], pa.binary()),
                         pa.array([tokens.tobytes()], pa.binary())], ["set", "n", "sketch", "tokens"])

    return staged(mapped(rows.select("set", "text"), run, "set bigint, n bigint, sketch binary, tokens binary"),
                  "sets")


def group_links(names: list[int], sets: list[np.ndarray], labels: list[int]) -> list[tuple[int, int]]:
    """Links that join all of a group's sets that belong together, given which are joined already (equal labels)."""
    count = len(sets)
    if count < 2:
        return []
    size = np.array([len(s) for s in sets], np.int64)
    values, inverse, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(count), size)
    # the leader: the set with the most shingles that others share
    shared = np.bincount(owner, weights=often[inverse] > 1, minlength=count)
    leader = int(np.argmax(shared))
    held = np.zeros(len(values), bool)
    held[inverse[owner == leader]] = True
    with_leader = np.bincount(owner, weights=held[inverse], minlength=count).astype(np.int64)
    least = needed(size[:, None] + size[None, :])
    lower = with_leader[:, None] + with_leader[None, :] - size[leader]
    upper = np.minimum.outer(with_leader, with_leader) + np.minimum.outer(size - with_leader, size - with_leader)
    root = np.unique(np.array(labels), return_inverse=True)[1]
    links = []

    def join(i, j):
        links.append((names[i], names[j]))
        root[root == root[j]] = root[i]

    sure = np.triu(lower >= least, 1)
    for i, j in np.argwhere(sure):
        if root[i] != root[j]:
            join(i, j)
    still = np.triu((upper >= least) & ~sure, 1) & (root[:, None] != root[None, :])
    for i in np.flatnonzero(still.any(axis=1)).tolist():
        others = np.flatnonzero(still[i] & (root != root[i]))
        if not len(others):
            continue
        mine = np.zeros(len(values), bool)
        mine[inverse[owner == i]] = True
        overlap = np.bincount(owner, weights=mine[inverse], minlength=count).astype(np.int64)
        for j in others[overlap[others] >= least[i, others]].tolist():
            if root[i] != root[j]:
                join(i, j)
    return links


def _links(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) inside groups given as rows (grp, part, set, label); each part of a group goes to one task."""

    def solve(rows):
        kept = {row[0]: row for row in rows}
        names = sorted(kept)
        return group_links(names, [np.frombuffer(kept[n][2], np.uint64) for n in names], [kept[n][1] for n in names])

    def emit(found):
        return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                                           pa.array([f[1] for f in found], pa.int64())], ["a", "b"])

    def run(batches):
        here, rows, found = None, [], []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("grp", "part", "set", "label", "tokens")]
            for grp, part, name, label, tokens in zip(*columns):
                if (grp, part) != here:
                    found += solve(rows) if rows else []
                    here, rows = (grp, part), []
                rows.append((name, label, tokens))
            if found:
                yield emit(found)
                found = []
        found += solve(rows) if rows else []
        if found:
            yield emit(found)

    # the rows of groups are slim: broadcast while they are few, so that only the sets that are needed are sent
    dealt = (sets.join(small(staged(groups, "parts"), 40), "set").select("grp", "part", "set", "label", "tokens")
             .repartition("grp", "part").sortWithinPartitions("grp", "part"))
    return staged(mapped(dealt, run, "a bigint, b bigint"), "links")


def _part(count: str, salt: int):
    parts = F.ceil(F.col(count) / PART)
    return F.when(F.col(count) <= PART + PART // 2, F.lit(0)).otherwise(
        F.pmod(F.xxhash64("set", F.lit(salt)), parts)).cast("int")


def _solve(groups: DataFrame, sets: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """All links that matter inside groups (grp, set): sets that belong together become connected by them.

    `pairs` are the candidates of the groups where they are known one by one; without them any two sets of a group are.
    """
    groups = staged(groups, "groups")
    counted = groups.join(groups.groupBy("grp").agg(F.count(F.lit(1)).alias("size")), "grp")
    links = _links(counted.select("grp", _part("size", 0).alias("part"), "set", F.col("set").alias("label")), sets)
    large = staged(counted.where(F.col("size") > PART + PART // 2), "large")
    if large.isEmpty():
        return links
    inside = links.join(large.select(F.col("set").alias("a")), "a", "left_semi")

    def labelled(found):
        names = components(found).select(F.col("node").alias("set"), "label")
        return staged(large.join(names, "set", "left").select(
            "grp", "set", "size", F.coalesce("label", "set").alias("label")), "labelled")

    rows = labelled(inside)
    clusters = rows.select("grp", "label").distinct().count()
    for salt in range(1, 9 if pairs is None else 1):
        # the leaders of clusters against each other
        leaders = rows.groupBy("grp", "label").agg(F.min("set").alias("set"))
        several = leaders.groupBy("grp").agg(F.count(F.lit(1)).alias("of")).where("of > 1")
        leaders = staged(leaders.join(several, "grp"), "leaders")
        new = _links(leaders.select("grp", _part("of", salt).alias("part"), "set", "label"), sets)
        inside = inside.unionByName(new)
        rows = labelled(inside)
        left = rows.select("grp", "label").distinct().count()
        if left > 0.9 * clusters:
            break
        clusters = left
    alone = links.join(large.select(F.col("set").alias("a")), "a", "left_anti")
    if pairs is not None:
        label = rows.select("set", "label")
        apart = (pairs.join(label.toDF("a", "label_a"), "a").join(label.toDF("b", "label_b"), "b")
                 .where("label_a <> label_b"))
        two = F.explode(F.array(F.struct(F.col("a").alias("set"), F.col("label_a").alias("label")),
                                F.struct(F.col("b").alias("set"), F.col("label_b").alias("label"))))
        both = apart.select(F.xxhash64("a", "b").alias("grp"), F.lit(0).alias("part"), two.alias("s"))
        return inside.unionByName(_links(both.select("grp", "part", "s.*"), sets)).unionByName(alone)
    # all sets outside the largest cluster of a group meet every part of it
    sizes = rows.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("c"))
    largest = sizes.groupBy("grp").agg(F.max_by("label", F.struct("c", "label")).alias("main"),
                                       (F.sum("c") - F.max("c")).alias("rest")).where("rest > 0")
    rows = staged(rows.join(largest, "grp"), "rest")
    meetings, parts = F.ceil(F.col("rest") / MEETING).cast("int"), F.ceil(F.col("size") / PART).cast("int")
    met = F.pmod(F.xxhash64("set", F.lit(98)), meetings).cast("int")
    lies = F.pmod(F.xxhash64("set", F.lit(99)), parts).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    minority = rows.where("label <> main").select("grp", "set", "label", met.alias("m"), every(parts).alias("p"))
    all_rows = rows.select("grp", "set", "label", every(meetings).alias("m"), lies.alias("p"))
    both = minority.unionByName(all_rows).select(
        "grp", F.xxhash64("m", "p").alias("part"), "set", "label").distinct()
    return inside.unionByName(_links(both, sets)).unionByName(alone)


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id for every row: the size of its set, and the least key it is linked to.

    Texts link when 100 * |A n B| >= 80 * |A u B|. Null and empty texts, and those of white space alone, have no
    shingles and no links: their component is their own key. Rows without a key take part; a component's id is the
    least key in it, and null if it has none. Rows alike in key or text stay apart as rows, in one component when
    their sets are equal. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("text")).select("key", "mark", "text")
    members = _members(rows)
    found = _candidates(_postings(rows, *_frequent(rows)))
    pairs = staged(found.where("token is null").select("a", "b").distinct(), "pairs")
    entries = found.where("token is not null").withColumnsRenamed({"b": "at"})
    blocks = _blocks(entries)
    hung = entries.join(blocks, ["token", "at"]).select("a", F.col("node").alias("b")).distinct()

    hung = staged(hung, "hung")
    names = hung.select(F.col("a").alias("set")).distinct()
    both = pairs.select(F.explode(F.array("a", "b")).alias("set"))
    sets = _sets(rows, members, staged(both.union(names).distinct(), "names"))

    near = _near(pairs, sets)
    cold = components(near).select(F.col("label").alias("grp"), F.col("node").alias("set"))
    hot = (components(hung).select(F.col("label").alias("grp"), F.col("node").alias("set"))
           .join(names, "set", "left_semi").select("grp", "set"))
    links = _solve(hot, sets).unionByName(_solve(cold, sets, near))

    joined = components(links).withColumnRenamed("node", "set")
    ids = members.where("set is not null").groupBy("set").agg(F.min("key").alias("least"),
                                                             F.count(F.lit(1)).alias("copies"))
    known = staged(ids.join(joined, "set", "left"), "ids")
    least = known.where("label is not null").groupBy("label").agg(F.min("least").alias("component"))
    named = staged(known.join(least, "label", "left").where("label is not null or copies > 1").select(
        "set", F.coalesce("component", "least").alias("component"), F.lit(True).alias("named")), "named")
    return members.join(named, "set", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("named"), F.col("component")).otherwise(F.col("key")).alias("component_id"))


def one_per_class(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that stay: of every class the document with the least key.

    Rows without a key stay. Rows that share a key share its fate, as a key names one document.
    """
    found = classes(docs, key, text)
    leave = staged(found.where(F.col("component_id") != F.col(key)).select(key).distinct(), "leave")
    return docs.join(small(leave, 16), key, "left_anti").select(*docs.columns)
