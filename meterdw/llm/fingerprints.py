"""Fingerprints of texts by winnowing: rolling hashes of k units, the least of every window, rightmost on ties.

The hash of a gram is a polynomial of its units modulo a prime. None is computed from its units alone: grams of two and
four units are put together from neighbouring grams of half their length, and one unit is rolled in for the fifth, so
every text is passed over once a step. A mixing function then orders the grams, as the polynomial by itself would not.

A unit is a word of up to 32 characters (longer runs are cut), or one character of scripts written without blanks.
Any run of WINDOW + K - 1 units that two texts share contains a whole window, so they share the hash chosen there; its
place is kept beside it. All of it is built from SQL functions: a text is an array of units, an array of hashes, and
an array of window minima found by doubling the window. A hash (upper 32 bits) and its place from the end (lower 31
bits) are one number, so the least number is the least hash, and the last of equal ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterdw.llm.common import staged

K = 5
DOUBLINGS = 4
WINDOW = 1 << DOUBLINGS
LAST = (1 << 31) - 1
PRIME = (1 << 31) - 1  # products of two residues stay below 2^62
BASE = 1_000_003
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}"
UNIT = rf"[{UNSPACED}]|[^\s{UNSPACED}]{{1,32}}"


def _joined(left: str, right: str, skip: int, width: int) -> str:
    """Hashes of grams of `left`'s length followed by `width` units of `right`, which begins `skip` places later."""
    power = pow(BASE, width, PRIME)
    return (f"zip_with(slice({left}, 1, greatest(0, size({right}) - {skip})), slice({right}, {skip + 1}, "
            f"size({right})), (a, b) -> (a * {power}L + b) % {PRIME}L)")


def winnow(rows: DataFrame, text: str, out: str) -> DataFrame:
    """Adds column `out`: the chosen numbers (hash and place) in the order of their places. No units, none chosen."""
    units, grams = f"_{out}_units", f"_{out}_grams"
    rows = rows.withColumn(units, F.transform(F.regexp_extract_all(F.col(text), F.lit(UNIT), F.lit(0)),
                                              lambda unit: F.pmod(F.xxhash64(unit), F.lit(PRIME))))
    pairs, fours, rolled = (f"_{out}_{length}" for length in ("pairs", "fours", "rolled"))
    rows = rows.withColumn(pairs, F.expr(_joined(units, units, 1, 1)))
    rows = rows.withColumn(fours, F.expr(_joined(pairs, pairs, 2, 2)))
    rows = rows.withColumn(rolled, F.expr(_joined(fours, units, K - 1, 1)))
    numbered = F.transform(
        F.when(F.size(units) == 0, F.expr("cast(array() as array<bigint>)"))
        .when(F.size(units) < K, F.array(F.xxhash64(units))).otherwise(
            F.transform(rolled, lambda gram: F.xxhash64(gram))),
        lambda gram, at: F.shiftleft(F.shiftrightunsigned(gram, 32), 31).bitwiseOR(F.lit(LAST).cast("bigint") - at))
    rows = rows.withColumn(grams, numbered)
    least = grams
    for step in range(DOUBLINGS):
        wider = f"_{out}_{step}"
        rows = rows.withColumn(wider, F.expr(
            f"zip_with({least}, slice({least}, {(1 << step) + 1}, size({least})), (a, b) -> least(a, b))"))
        least = wider
    chosen = F.expr(f"array_distinct(slice({least}, 1, greatest(1, size({least}) - {WINDOW - 1})))")
    made = [units, pairs, fours, rolled, grams, *(f"_{out}_{step}" for step in range(DOUBLINGS))]
    return rows.withColumn(out, chosen).drop(*made)


def hashes(chosen: str) -> Column:
    return F.array_distinct(F.transform(F.col(chosen), lambda number: F.shiftright(number, 31)))


def fingerprint(chosen: str) -> Column:
    """The chosen hashes with their places (in units), as text."""
    return F.array_join(F.transform(F.col(chosen), lambda number: F.concat(
        F.lower(F.hex(F.shiftright(number, 31))), F.lit("@"),
        (F.lit(LAST) - number.bitwiseAND(F.lit(LAST))).cast("string"))), " ")


def likeness(one: Column, other: Column) -> Column:
    """Shared hashes against all hashes; two texts without units are alike."""
    union = F.size(F.array_union(one, other))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(one, other)) / union)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_chars and fingerprint of every row; null texts count as empty and have an empty fingerprint."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return winnow(docs.select(F.col(key).alias("key"), whole.alias("text")), "text", "chosen").select(
        F.col("key").alias(key), F.char_length("text").cast("bigint").alias("n_chars"),
        fingerprint("chosen").alias("fingerprint"))


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Text with a key free of nulls: the id or a stand-in, whether it is null, and a hash of the text."""
    kind = docs.schema[key].dataType
    stand_in = F.lit("" if kind.simpleString() == "string" else 0).cast(kind)
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(key), stand_in).alias("k"), F.col(key).isNotNull().alias("known"),
                       F.xxhash64(whole).alias("mark"), whole.alias("text"))


KEY = ["known", "k", "mark"]


def previous(keyed: DataFrame) -> DataFrame:
    """Per distinct id and text: the one before it in ascending order (before the first comes the last).

    Runs are the partitions of a sort by range; the look back across runs needs one row of each.
    """
    distinct = keyed.groupBy(*KEY).agg((F.max(F.char_length("text"))).cast("bigint").alias("chars"))
    runs = staged(distinct.repartitionByRange(*KEY).withColumn("run", F.spark_partition_id()), "runs")
    row = F.struct(*KEY, "chars")
    ends = runs.groupBy("run").agg(F.max(row).alias("last"))
    in_order = Window.orderBy("run")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("run", F.coalesce(F.lag("last").over(in_order), F.last("last").over(whole)).alias("across"))
    back = F.coalesce(F.lag(row).over(Window.partitionBy("run").orderBy(*KEY)), F.col("across"))
    return runs.join(F.broadcast(ends), "run").select(*KEY, back.alias("back")).select(
        *KEY, *[F.col(f"back.{name}").alias(f"back_{name}") for name in (*KEY, "chars")])


def with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every row and of its edited text, whose second half is the beginning of the next document.

    Columns: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The next document is
    the next distinct (id, text) in ascending order, null ids first, equal ids in the order of a hash of their texts; after the last comes the
    first, and a table of one document follows itself. Rows with equal ids and texts get equal results. Null texts are
    empty; an empty table gives no rows. Other columns are not read.
    """
    keyed = _keyed(docs, key, text)
    # both joins read one shuffle of texts and chosen numbers: a text is winnowed once, before it
    whole = winnow(keyed, "text", "chosen")
    linked = whole.join(previous(keyed).hint("merge"), KEY)
    once = linked.withColumn("copy", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.lit(1)))).where("copy = 1")
    following = once.select(
        *[F.col(f"back_{name}").alias(name) for name in KEY],
        F.expr("substring(text, 1, cast(back_chars div 2 as int))").alias("head"), hashes("chosen").alias("next"))
    edited = F.expr("concat(substring(text, 1, char_length(text) - char_length(text) div 2), head)")
    rows = (whole.join(following.hint("merge"), KEY)
            .select(F.when(F.col("known"), F.col("k")).alias("key"), "text", "chosen", edited.alias("edited"), "next"))
    rows = winnow(rows, "edited", "after")
    return rows.select(
        F.col("key").alias(key), F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint("chosen").alias("fingerprint"), fingerprint("after").alias("edited_fingerprint"),
        likeness(hashes("chosen"), hashes("after")).alias("near_edited"),
        likeness(hashes("chosen"), F.col("next")).alias("near_next"))
