"""Near-duplicate lines: exact set-similarity join on line tokens.

A line is the set of its space-separated tokens.  Two lines match when the
Jaccard similarity of their sets is at least ``threshold``.  Lines are ordered by
(document id, text hash, line number); a line is removed when an earlier line
matches it.  Lines without a token stay.

Method.  Lines with equal sets form one class, kept at its first place, so copies
never meet in a join.  Tokens of a class are ordered by rarity and the first
``n - ceil(threshold * n) + 1`` form its prefix; matching sets share a token of
both prefixes, and of the smaller set already the first
``n - ceil(2 * threshold / (1 + threshold) * n) + 1`` do.  Prefixes are joined on
the token and filtered by length (``n1 >= threshold * n2``), by position (what is
left behind the shared token must still reach the needed overlap) and by a 128-bit
parity map of the sets (64 bits for short lines): every token flips one bit, so
differing bits are differing tokens, however large the sets.  The sets of the remaining pairs are read again and
their Jaccard similarity is computed.  One earlier match removes a line, so every
class is first compared with the one earlier candidate that its parity map is
nearest to; only classes that this pair leaves go through their other candidates.

Large groups of near copies would make all their pairs.  So every class first
looks at the earliest class that shares its smallest or its largest token hash
(one partner per key, linear).  Where length and parity map allow a match the nearest
such pair is verified first, and a class that it removes does not search the join; all
others do, in one join.  This only saves work: the result is that of the full join.

Rarity is the corpus count of the token's hash bucket, on a scale of quarter
powers of two: a table of 2^RARITY_BITS bytes whatever the corpus, used as one
literal.  Any total order gives the same pairs; the table only decides how few
candidates there are.  A token is a 7-bit rarity and 56 bits of its hash; classes
are told apart by 96 bits of hash over the set.

Everything is DataFrame functions.  Texts are shuffled by document id to read the
sets of candidate pairs, and to drop lines.

Defined cases: a null text stays null, an empty one empty; a document whose lines
all go stays with an empty text; rows equal in id and text share their lines'
fate; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.llm.common import cut_lineage, let, let_go

THRESHOLD = 0.8
RARITY_BITS = 18
# Lists of class numbers (16 bytes each) are broadcast up to so many rows and shuffled beyond.
BROADCAST_ROWS = 1_000_000
# Lines of up to so many tokens do with 64 parity bits; the others have 128.
SHORT_LINE = 60
_OTHER_SPACE = "[\\t\\x0b\\x0c\\r]"
_TOKEN_CHAR = "[^ \\t\\x0b\\x0c\\r]"


def token_hashes(line: Column) -> Column:
    """Distinct hashes of the space-separated tokens; the other white space counts as a space."""
    other = F.contains(line, F.lit("\t")) | F.contains(line, F.lit("\x0b")) | F.contains(line, F.lit("\x0c")) | F.contains(line, F.lit("\r"))
    plain = F.when(other, F.regexp_replace(line, _OTHER_SPACE, " ")).otherwise(line)
    hashes = F.array_distinct(F.transform(F.split(plain, " "), lambda t: F.xxhash64(t)))
    # two spaces in a row leave an empty token; numbers are faster to look through than texts
    return F.array_remove(hashes, F.xxhash64(F.lit("")))


def rarity_table(spark: SparkSession, docs: DataFrame, text_col: str, bits: int) -> bytes:
    """4 * log2 of the corpus count by hash bucket: one byte per bucket."""
    # other white space may stay in a token here: the table only orders tokens
    tokens = docs.select(F.explode(F.split(F.replace(F.col(text_col), F.lit("\n"), F.lit(" ")), " ")).alias("t")).where("t <> ''")
    bucket = F.xxhash64("t").bitwiseAND((1 << bits) - 1)
    every = spark.range(1 << bits).select(F.col("id").alias("b"), F.lit(0).cast("long").alias("w"))
    counts = tokens.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("w"))
    counts = counts.unionByName(every).groupBy("b").agg(F.sum("w").alias("w"))
    grade = F.least(F.lit(127), F.floor(F.log2(F.col("w") + 1) * 4)).cast("int")
    cells = F.sort_array(F.collect_list(F.struct("b", F.lpad(F.hex(grade), 2, "0").alias("g"))))
    row = counts.agg(F.unhex(F.array_join(F.transform(cells, lambda x: x["g"]), "")).alias("table")).first()
    return bytes(row["table"])


def token_keys(hashes: Column, rarity: bytes) -> Column:
    """Sorted keys of token hashes: rarity in the top byte, hash below it."""
    table, last = F.lit(rarity), len(rarity) - 1

    def key(h: Column) -> Column:
        grade = F.ascii(F.substring(table, h.bitwiseAND(last).cast("int") + 1, F.lit(1)).cast("string"))
        return F.shiftleft(grade.cast("long"), 56).bitwiseOR(F.shiftrightunsigned(h, 8))

    return F.sort_array(F.transform(hashes, key))


def _prefix_length(n: Column, threshold: float) -> Column:
    return (n - F.ceil(n * threshold - 1e-9) + 1).cast("int")


def _parity(hashes: Column, upper: bool = False) -> Column:
    """64 parity bits: every token, or every one whose hash bit 6 is set, flips the bit that six others name."""
    def flip(h: Column) -> Column:
        one = F.shiftright(h, 6).bitwiseAND(1) if upper else F.lit(1).cast("long")
        return F.call_function("shiftleft", one, h.bitwiseAND(63).cast("int"))

    return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a.bitwiseXOR(flip(h)))


def line_classes(docs: DataFrame, rarity: bytes, threshold: float) -> DataFrame:
    """One row per distinct token set: first place, size, parity map, prefix and sketch."""
    lines = docs.select("_id", "_th", F.posexplode(F.split("_text", "\n")).alias("_pos", "_line"))
    # tested on the line: a test of its hashes would make them twice
    filled = lines.where(F.col("_line").rlike(_TOKEN_CHAR))
    hashed = filled.select("_id", "_th", "_pos", token_hashes(F.col("_line")).alias("h"))
    keyed = hashed.select("_id", "_th", "_pos", "h", F.size("h").alias("n"), token_keys(F.col("h"), rarity).alias("k"))
    prefix = F.transform(F.slice("k", F.lit(1), _prefix_length(F.col("n"), threshold)), _short)
    more = F.when(F.col("n") > SHORT_LINE, _parity(F.col("h"), True))
    rows = keyed.select(
        F.struct("_id", "_th", "_pos").alias("place"), F.xxhash64("k").alias("k1"), F.hash("k").alias("k2"),
        F.struct("n", _parity(F.col("h")).alias("bits"), more.alias("more"), prefix.alias("prefix"),
                 F.array_min("h").alias("least"), F.array_max("h").alias("most")).alias("about"))
    classes = rows.groupBy("k1", "k2").agg(F.min("place").alias("place"), F.first("about").alias("about"))
    return classes.select("place", "about.*")


def _short(key: Column) -> Column:
    """32 bits of a token key; a collision only makes one more candidate."""
    return F.hash(key)


def _could_match(threshold: float, n1: Column, n2: Column) -> Column:
    """Length and parity filters of a pair with bits and more of both."""
    total = n1 + n2
    needed = total * (threshold / (1 + threshold)) - 1e-9
    return (F.least(n1, n2) >= F.greatest(n1, n2) * threshold - 1e-9) & (_differing() <= total - 2 * needed)


def _differing() -> Column:
    bits, more = F.col("bits1").bitwiseXOR(F.col("bits2")), F.col("more1").bitwiseXOR(F.col("more2"))
    # ``bits`` is the map of all tokens, so without those of ``more`` it is that of the others
    return F.when(more.isNull(), F.bit_count(bits)).otherwise(F.bit_count(more) + F.bit_count(bits.bitwiseXOR(more)))


def first_partners(classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b, d): class a with the earliest class b of one of its sketches that could be a match, the nearest one."""
    about = ("cid", "n", "bits", "more")
    sketches = F.posexplode(F.array("least", "most")).alias("s", "mh")
    entries = classes.select(sketches, F.col("place._id").alias("id"), *about)
    # one number a column, not a struct, so that rows are counted by hash and not sorted
    pivots = entries.groupBy("s", "mh").agg(*[F.min_by(c, "id").alias(f"{c}2") for c in about], F.count(F.lit(1)).alias("m"))
    met = entries.join(pivots.where("m > 1"), ["s", "mh"]).where(F.col("cid") != F.col("cid2")).select(
        F.col("cid").alias("a"), F.col("cid2").alias("b"), *[F.col(c).alias(f"{c}1") for c in about[1:]], *[f"{c}2" for c in about[1:]])
    best = met.where(_could_match(threshold, F.col("n1"), F.col("n2"))).groupBy("a").agg(F.min(F.struct(_differing().alias("d"), "b")).alias("x"))
    return best.select("a", F.col("x.b").alias("b"), F.col("x.d").cast("int").alias("d"))


def candidate_pairs(classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b), one of them ``searching``, that pass prefix, length, position and
    parity; ``d`` is in how many parity bits they differ."""
    # size, position and mark in one number: these rows are most of what is shuffled
    packed = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR((F.col("at") * 2 + F.col("searching").cast("int")).cast("long"))
    entries = classes.select("cid", "n", "bits", "more", "searching", F.posexplode("prefix").alias("at", "tok"))
    entries = entries.select("tok", "cid", packed.alias("x"), "bits", "more")

    def side(k: int) -> DataFrame:
        return entries.select("tok", *[F.col(c).alias(f"{c}{k}") for c in ("cid", "x", "bits", "more")])

    n1, n2 = (F.shiftright(x, 32) for x in ("x1", "x2"))
    at1, at2 = (F.shiftright(F.col(x).bitwiseAND((1 << 32) - 1), 1) for x in ("x1", "x2"))
    # the first of a pair is the smaller set; its shorter prefix is enough
    short = n1 - F.ceil(n1 * (2 * threshold / (1 + threshold)) - 1e-9) + 1
    needed = (n1 + n2) * (threshold / (1 + threshold)) - 1e-9
    near = side(1).join(side(2), "tok").where(
        ((n1 < n2) | ((n1 == n2) & (F.col("cid1") < F.col("cid2"))))
        & (F.col("x1").bitwiseOR(F.col("x2")).bitwiseAND(1) == 1)
        # n2 is no smaller than ``short``; naming it keeps this condition out of the
        # left input, so that both inputs are one and the same exchange
        & (at1 < F.least(short, n2)) & (F.least(n1 - at1, n2 - at2) >= needed) & _could_match(threshold, n1, n2))
    return near.select(F.col("cid1").alias("a"), F.col("cid2").alias("b"), _differing().cast("int").alias("d")).distinct()


def verified(spark: SparkSession, docs: DataFrame, classes: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs that match, as (a, b) with b standing before a."""
    ids = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
    places = classes.select("cid", "place").join(ids, "cid")
    wanted = places.groupBy(F.col("place._id").alias("_wid"), F.col("place._th").alias("_wth")).agg(
        F.collect_list(F.struct(F.col("place._pos").alias("pos"), "cid", "place")).alias("want"))
    # the texts are looked up as they come, not sorted
    here = docs.join(wanted.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("_wid")) & (F.col("_th") == F.col("_wth")))
    lines = here.select(F.split("_text", "\n").alias("lines"), "want").select("lines", F.explode("want").alias("w"))
    sets = lines.select("w.cid", "w.place", token_hashes(F.get("lines", F.col("w.pos"))).alias("h"))
    # rows equal in id and text give the same set
    sets = cut_lineage(spark, sets.groupBy("cid").agg(F.first("place").alias("place"), F.first("h").alias("h")))
    # the later class of a pair is the one that may go
    ends = [sets.select(F.col("cid").alias(c), F.col("place").alias(f"p_{c}")) for c in ("a", "b")]
    second = F.col("p_b") < F.col("p_a")
    late, early = F.when(second, F.col("a")).otherwise(F.col("b")), F.when(second, F.col("b")).otherwise(F.col("a"))
    turned = cut_lineage(spark, pairs.join(ends[0], "a").join(ends[1], "b").select(late.alias("a"), early.alias("b"), "d"))
    x, y = (sets.select(F.col("cid").alias(c), F.col("h").alias(f"h_{c}")) for c in ("a", "b"))

    def matching(some: DataFrame) -> DataFrame:
        both = some.join(x, "a").join(y, "b").withColumn("o", F.size(F.array_intersect("h_a", "h_b")))
        same = both.where(F.col("o") >= threshold * (F.size("h_a") + F.size("h_b") - F.col("o")) - 1e-9)
        return cut_lineage(spark, same.select("a", "b"))

    nearest = turned.groupBy("a").agg(F.min(F.struct("d", "b")).alias("x"))
    found = matching(nearest.select("a", "x.b"))
    rest = turned.join(found.select("a"), "a", "left_anti").join(nearest.select("a", F.col("x.b").alias("_tried")), "a")
    return found.unionByName(matching(rest.where(F.col("b") != F.col("_tried")).select("a", "b")))


def later_lines(spark: SparkSession, docs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Numbers (cid) of the classes that an earlier one matches."""
    partners = cut_lineage(spark, first_partners(classes, threshold))
    found = verified(spark, docs, classes, partners, threshold).select(F.col("a").alias("cid")).distinct()
    # the others search; found ones are only met
    marks = found.withColumn("_in", F.lit(True))
    if found.count() <= BROADCAST_ROWS:  # else the classes are shuffled to the marks
        marks = F.broadcast(marks)
    marked = classes.join(marks, "cid", "left").withColumn("searching", F.col("_in").isNull())
    pairs = cut_lineage(spark, candidate_pairs(marked, threshold))
    more = verified(spark, docs, classes, pairs, threshold).select(F.col("a").alias("cid"))
    return found.unionByName(more).distinct()


def kept_lines(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
               bits: int = RARITY_BITS) -> DataFrame:
    """(_kid, _kth, _keep): the numbers of the lines with tokens that stay, per document."""
    slim = docs.select(F.col(id_col).alias("_id"), _text_hash(text_col).alias("_th"), F.col(text_col).alias("_text"))
    rarity = rarity_table(spark, slim, "_text", bits)
    classes = cut_lineage(spark, line_classes(slim, rarity, threshold).withColumn("cid", F.monotonically_increasing_id()))
    later = later_lines(spark, slim, classes, threshold)
    first = classes.select("cid", "place").join(later, "cid", "left_anti")
    numbers = first.groupBy(F.col("place._id").alias("_kid"), F.col("place._th").alias("_kth")).agg(F.collect_list("place._pos").alias("_keep"))
    return cut_lineage(spark, numbers)


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _flags(numbers: Column) -> Column:
    """Array that is true at the given places, as long as the largest one needs; one pass over them."""
    def upto(sorted_numbers: Column) -> Column:
        def stretch(x: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(sorted_numbers, i - 1)).otherwise(F.lit(-1))
            return F.concat(F.array_repeat(F.lit(False), x - before - 1), F.array(F.lit(True)))

        return F.flatten(F.transform(sorted_numbers, stretch))

    return let(F.sort_array(numbers), upto)


def dedup_lines(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
                bits: int = RARITY_BITS) -> DataFrame:
    """Input with the text cut to its first lines, plus ``_n_lines`` and ``_n_removed``."""
    names = docs.columns
    kept = kept_lines(spark, docs, threshold, id_col, text_col, bits)
    let_go(spark)  # of the classes, before the texts are shuffled
    whole = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), _text_hash(text_col).alias("_th"))  # the text once
    joined = whole.join(kept.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("_kid")) & (F.col("_th") == F.col("_kth")), "left")
    flags = _flags(F.coalesce("_keep", F.array().cast("array<int>")))

    def cleaned(lines: Column) -> Column:
        """How many lines there are, and those that stay."""
        stays = let(flags, lambda kept: F.filter(lines, lambda line, i: F.coalesce(F.get(kept, i), F.lit(False)) | ~line.rlike(_TOKEN_CHAR)))
        return F.struct(F.coalesce(F.size(lines), F.lit(0)).alias("n"), stays.alias("left"))

    out = joined.select("_row", let(F.split(F.col("_row")[text_col], "\n"), cleaned).alias("_x")).select("_row", F.col("_x.n").alias("_n"), F.col("_x.left").alias("_left"))
    row = F.col("_row")
    return out.select(
        *[(F.array_join("_left", "\n") if c == text_col else row[c]).alias(c) for c in names],
        F.col("_n").alias("_n_lines"), (F.col("_n") - F.coalesce(F.size("_left"), F.lit(0))).alias("_n_removed"))
