"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

Lines are compared as sequences of words. Equal lines are merged by a 128-bit hash. Two
different lines of MIN_WORDS words or more are near copies when one edit of a word
(replace, insert or delete) turns one into the other - at five words that is a
similarity of 0.8. The join runs in three steps:

1. Half keys. With one edit, and L the words of the shorter line, either the first
   floor(L/2) words or the last L - floor(L/2) agree. Lines none of whose four half keys
   is shared have no near copy and go no further; none with one is lost.
2. Deletion variants of the others, as hashed keys: (length, place, line without that
   word) is equal for two lines exactly when they differ in that word at most, so the
   earliest line of such a group is a match of all the others, without pairs; a line
   without one word equals another whole line exactly when that word was inserted.
3. Each line and its earliest match are held against each other again on the words.

A line goes when an earlier line (by doc_id, then place) is equal or within the bound.

Defined cases: null text has no lines; blank lines stay and match nothing; words are runs
of anything but ASCII white space; rows that agree in doc_id and text are one document
given once per row, rows that agree in doc_id alone are ordered by a hash of the text;
null doc_ids come first; an empty table gives an empty result; extra columns are ignored.
A line of n words that passes step 1 costs 2n word hashes: exclusive ors of hashes of words
with their places, up to each word and from it on, give its n variants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_unique, materialize, n_partitions

MIN_WORDS = 5
_BLANKS = " \t\x0b\x0c\r"
#: Bits of the map of lines that share a half key (16 MB), whatever the corpus.
BITS = 1 << 27


def words_of(line: Column) -> Column:
    return F.split(F.btrim(line, F.lit(_BLANKS)), "[ \\t\\x0B\\f\\r]+")


def spaced(line: Column) -> Column:
    """The line's words with one space between them; only lines that are not so already pay for a pattern."""
    trimmed = F.btrim(line, F.lit(_BLANKS))
    odd = F.lit(False)
    for blank in ("  ", *_BLANKS[1:]):
        odd = odd | F.contains(trimmed, F.lit(blank))
    return F.when(odd, F.regexp_replace(trimmed, "[ \\t\\x0B\\f\\r]+", " ")).otherwise(trimmed)


def half_keys(line: Column, n: Column) -> Column:
    """Of a spaced line of n words, four hashes (null where too short): for L = n and L = n - 1, the first floor(L/2) words
    and the other L - floor(L/2) from the end."""
    keys = []
    for short in (n, n - 1):
        q = F.shiftright(short, 1)
        for side, count in (("p", q), ("s", q - short)):
            keys.append(F.when(short >= MIN_WORDS, F.xxhash64(F.lit(side), short, F.call_function("substring_index", line, F.lit(" "), count))))
    return F.when(n >= MIN_WORDS, F.array(*keys))


def sequence_hash(words: Column) -> Column:
    """The exclusive or of hashes of the words with their places."""
    return F.aggregate(F.transform(words, lambda w, j: F.xxhash64(w, j)), F.lit(0).cast("bigint"), lambda a, x: a.bitwiseXOR(x))


def deletion_hashes(lines: DataFrame) -> DataFrame:
    """uid, n, i, v for each word of (uid, words): v is the sequence_hash of the line without its i-th word, in which
    the words after it stand a place further left."""
    each = lines.select("uid", F.size("words").alias("n"), F.posexplode("words").alias("i", "w"))
    each = each.select("uid", "n", "i", F.xxhash64("w", "i").alias("here"), F.xxhash64("w", F.col("i") - 1).alias("left"))
    upto = Window.partitionBy("uid").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.bit_xor(F.col("here").bitwiseXOR(F.col("left"))).over(upto).bitwiseXOR(F.col("here"))
    return each.select("uid", "n", "i", before.bitwiseXOR(F.bit_xor("left").over(Window.partitionBy("uid"))).alias("v"))


def marked_bits(rows: DataFrame, *columns: str) -> DataFrame:
    """(slab, bits): BITS bits, set where the columns' hash of a row falls."""
    x = F.xxhash64(*columns).bitwiseAND(BITS - 1)
    at = rows.select(F.shiftright(x, 15).alias("slab"), x.bitwiseAND(32767).alias("bit"))
    return at.repartition(n_partitions(rows.sparkSession), "slab").groupBy("slab").agg(F.bitmap_construct_agg("bit").alias("bits"))


def perhaps_in(rows: DataFrame, marks: DataFrame, *columns: str) -> DataFrame:
    """The rows whose bit is set: all that were marked, and some others."""
    x = F.xxhash64(*columns).bitwiseAND(BITS - 1)
    byte = F.substring(F.col("bits"), F.shiftright(x.bitwiseAND(32767), 3).cast("int") + 1, F.lit(1))
    bit = F.call_function("shiftright", F.conv(F.hex(byte), 16, 10).cast("int"), x.bitwiseAND(7).cast("int"))
    return rows.join(F.broadcast(marks), F.shiftright(x, 15) == F.col("slab")).where(bit.bitwiseAND(1) == 1).drop("slab", "bits")


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether two word arrays differ in at most one word replaced, inserted or deleted:
    their common prefix and suffix cover all but one word of the longer."""

    def same(x: Column, y: Column) -> Column:
        first_odd = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False)
        return F.when(first_odd == 0, F.least(F.size(x), F.size(y))).otherwise(first_odd - 1)

    longest = F.greatest(F.size(a), F.size(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (same(a, b) + same(F.reverse(a), F.reverse(b)) >= longest - 1)


def line_decisions(docs: DataFrame) -> DataFrame:
    """A row for each line with words: doc_id, tid (hash of the text), line, exact and near
    (booleans: why it goes)."""
    spark = docs.sparkSession
    texts = docs.where("text IS NOT NULL").select("doc_id", "text", F.xxhash64("text").alias("tid"))
    split = texts.select("doc_id", "tid", F.posexplode(F.split("text", "\n")).alias("line", "raw"))
    lines = split.where(F.btrim("raw", F.lit(_BLANKS)) != "").select("doc_id", "tid", "line", spaced(F.col("raw")).alias("spaced"))
    n = F.octet_length("spaced") - F.octet_length(F.replace("spaced", F.lit(" "), F.lit(""))) + 1
    lines = lines.select("doc_id", "tid", "line", F.xxhash64("spaced").alias("ha"), F.xxhash64(F.lit("b"), "spaced").alias("hb"), "spaced", n.alias("n"))
    lines = lines.select("doc_id", "tid", "line", "ha", "hb", half_keys(F.col("spaced"), F.col("n")).alias("halves"))
    lines = materialize(lines, "lines")
    total = lines.count()
    firsts = materialize(
        lines.groupBy("ha", "hb").agg(F.min(F.struct("doc_id", "tid", "line")).alias("at"), F.count(F.lit(1)).alias("copies"), F.first("halves").alias("halves")),
        "distinct-lines",
    )
    # step 1: distinct lines that share a half key
    halves = firsts.select("ha", "hb", "at", F.explode("halves").alias("half")).where("half IS NOT NULL")
    shared = halves.groupBy("half").agg(F.min("ha").alias("lo"), F.max("ha").alias("hi")).where("lo <> hi").select("half")
    some = materialize(halves.join(shared, "half", "left_semi").select("at.*").distinct(), "half-key-lines")
    # a map of bits of fixed size leaves out most other lines before any exchange
    place = ["doc_id", "tid", "line"]
    likely = perhaps_in(split, marked_bits(some, *place), *place)
    likely = likely.withColumn("none", F.col("doc_id").isNull()).na.fill(0, "doc_id")
    wanted = some.withColumn("none", F.col("doc_id").isNull()).na.fill(0, "doc_id")
    found = likely.join(wanted, [*place, "none"], "left_semi").select(F.when(~F.col("none"), F.col("doc_id")).alias("doc_id"), "tid", "line", words_of(F.col("raw")).alias("words"))
    found = found.dropDuplicates(place)
    # numbered in order, so that one number is place and identity
    ordered = found.repartitionByRange(n_partitions(spark), "doc_id", "tid", "line").sortWithinPartitions("doc_id", "tid", "line")
    cands = materialize(ordered.withColumn("uid", F.monotonically_increasing_id()), "candidates")
    # step 2
    variants = deletion_hashes(cands).select("uid", F.xxhash64("n", "i", "v").alias("key"), "v")
    variants = materialize(variants, "variants")  # 24 bytes each, read three times
    replaced = variants.select("uid", "key")
    groups = replaced.groupBy("key").agg(F.min("uid").alias("first"), F.max("uid").alias("last")).where("first <> last")
    one = replaced.join(groups, "key").where("uid <> first").select("uid", F.col("first").alias("match"))
    whole = cands.select(F.col("uid").alias("whole"), sequence_hash(F.col("words")).alias("v"))
    other = variants.select("uid", "v").join(whole, "v")
    pairs = one.unionByName(other.select(F.greatest("uid", "whole").alias("uid"), F.least("uid", "whole").alias("match"))).distinct()
    # step 3
    texts_of = cands.select("uid", "words")
    checked = (
        pairs.join(texts_of, "uid")
        .join(texts_of.select(F.col("uid").alias("match"), F.col("words").alias("match_words")), "match")
        .where((F.size("words") >= MIN_WORDS) & (F.size("match_words") >= MIN_WORDS))
        .where(within_one_edit(F.col("words"), F.col("match_words")))
        .select("uid")
        .distinct()
    )
    near = cands.join(checked, "uid").select(F.struct("doc_id", "tid", "line").alias("at"), F.lit(True).alias("near"))
    marked = firsts.join(near, "at", "left").select("ha", "hb", "at", "copies", F.coalesce("near", F.lit(False)).alias("near"))
    marked = materialize(marked, "marked-lines")
    joined = join_unique(lines.drop("halves"), marked, ["ha", "hb"], "copies", total)
    return joined.select("doc_id", "tid", "line", (~F.struct("doc_id", "tid", "line").eqNullSafe(F.col("at"))).alias("exact"), "near")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """doc_id, kept_text and counts for every row of docs."""
    gone = F.col("exact") | F.col("near")
    per_doc = (
        line_decisions(docs)
        .groupBy("doc_id", "tid")
        .agg(
            F.count_if(F.col("exact")).alias("n_exact"),
            F.count_if(F.col("near") & ~F.col("exact")).alias("n_near"),
            F.array_distinct(F.collect_list(F.when(gone, F.col("line")))).alias("gone"),
        )
    )
    docs = docs.select(F.col("doc_id").alias("id"), "text")
    same = docs.id.eqNullSafe(per_doc.doc_id) & (F.xxhash64("text") == per_doc.tid)
    lines = F.split("text", "\n")
    n_lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    left = F.array_except(F.sequence(F.lit(0), n_lines - 1), "gone")
    # the text is split once, outside what is done for each line
    joined = F.transform(F.array(lines), lambda all_lines: F.array_join(F.transform(left, lambda i: all_lines[i]), "\n"))[0]
    kept = F.when(F.col("gone").isNull() | (F.size("gone") == 0), F.col("text")).otherwise(joined)
    return docs.join(per_doc, same, "left").select(
        F.col("id").alias("doc_id"),
        F.when(F.col("text").isNull(), 0).otherwise(n_lines).cast("bigint").alias("n_lines"),
        F.size(F.coalesce("gone", F.array().cast("array<int>"))).cast("bigint").alias("n_removed"),
        F.coalesce("n_exact", F.lit(0)).alias("n_exact"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.coalesce(kept, F.lit("")).alias("kept_text"),
    )


def op8_line_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    out = dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_removed", "n_exact", "n_near", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
