"""Bottom-k sketches of a text's word shingles, by column expressions only.

A shingle is five consecutive words (lower case; runs of other characters than
space and tab to carriage return); fewer words make one shingle, none makes
none.  The sketch is the ``k`` smallest distinct 64-bit hashes of the shingles,
ascending, with the words hashed first and the shingle as the hash of its
words' hashes.  The k smallest of the union of two sketches are the sketch of
the texts' union, so parts can be sketched alone and merged.

Estimates from sketches:
- resemblance: the share of the merged sketch that lies in both;
- distinct shingles: exact below k, else (k - 1) / the k-th hash on a 0..1 scale;
- containment of one text in another: resemblance times the estimated union
  over the estimated first set.

Defined cases: a null text is the empty text; two empty sketches have
likeness 1 (equal texts are alike), an empty and another 0; an empty table
gives no rows; with one document its own text follows it; rows with a null
doc_id come first; rows with equal doc_ids follow each other by text;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 128
WORDS = 5
_SPACE = "[\\x20\\x09-\\x0D]+"


def bound(value: Column, then) -> Column:
    """``then`` of a column that is computed once for a row (a lambda's
    variable), however often ``then`` uses it."""
    return F.transform(F.array(value), then)[0]


def shingle_hashes(text: Column, words_each: int = WORDS) -> Column:
    """One hash per shingle, in text order; empty for no words."""
    trimmed = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), f"^{_SPACE}|{_SPACE}$", "")
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE))
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.size(h) - (words_each - 1)),
                           lambda i: F.xxhash64(*[F.element_at(h, i + j) for j in range(words_each)]))
        few = F.array(F.aggregate(h, F.lit(0).cast("long"), lambda a, x: F.xxhash64(a, x)))
        return F.when(F.size(h) >= words_each, many).when(F.size(h) > 0, few).otherwise(F.array().cast("array<bigint>"))

    return bound(hashes, windows)


def bottom(hashes: Column, k: int = K) -> Column:
    """The k smallest distinct hashes, ascending."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K, words_each: int = WORDS) -> Column:
    return bottom(shingle_hashes(text, words_each), k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two sketched sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard resemblance, 0 to 1."""
    share = bound(F.struct(a.alias("a"), b.alias("b")), lambda s: bound(
        merged(s["a"], s["b"], k),
        lambda m: F.size(F.array_intersect(F.array_intersect(m, s["a"]), s["b"])) / F.greatest(F.size(m), F.lit(1))))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(share)


def distinct_shingles(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    place = F.element_at(s, k).cast("double") / F.lit(2.0 ** 64) + F.lit(0.5)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise(F.lit(float(k - 1)) / place)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set's shingles that the second holds, 0 to 1."""
    both = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def as_text(s: Column) -> Column:
    """The sketch as hex digits, 16 a hash."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def merge_sketches(parts: DataFrame, key: str, column: str, k: int = K) -> DataFrame:
    """One sketch per key from rows that each hold a sketch of a part.

    Hashes are combined before the shuffle, and a key's distinct hashes are
    cut to k in a second step over salted groups, so a hot key is no one
    task's work.
    """
    hashes = parts.select(key, F.explode(column).alias("h")).distinct()
    salted = hashes.withColumn("salt", F.pmod(F.xxhash64("h", F.lit(1)), F.lit(64)))
    small = (salted.withColumn("r", F.row_number().over(Window.partitionBy(key, "salt").orderBy("h")))
             .where(F.col("r") <= k).groupBy(key).agg(F.collect_list("h").alias("h")))
    return small.select(key, F.slice(F.sort_array("h"), 1, k).alias(column))


def with_next(docs: DataFrame, k: int = K, per_range: int = 2000) -> DataFrame:
    """Adds fingerprint, next_text and next_fingerprint of the following doc_id
    (after the last: the first) to rows with doc_id and text.

    Documents are dealt by ranges of doc_id of about ``per_range`` rows; the
    following row is found inside a range by a window, and for the last row of
    a range by the first row of the next range that has rows.
    """
    spark = docs.sparkSession
    n = docs.select("doc_id").count()
    ranges = max(1, min(n // per_range, 10_000))
    at = F.col("doc_id").cast("double")
    cuts = sorted(set(docs.select(at.alias("d")).where("d IS NOT NULL")
                      .approxQuantile("d", [i / ranges for i in range(1, ranges)], 0.2 / ranges))) if ranges > 1 else []
    # the number of the range by binary search in the sorted bounds
    slot = F.lit(0)
    if cuts:
        bounds = F.lit(cuts)
        slot = F.coalesce(F.size(F.filter(bounds, lambda b: b <= at)), F.lit(0))
    ranged = docs.withColumn("range", slot)
    rows = ranged.withColumn("fingerprint", sketch(F.col("text"), k))
    order = [F.col("doc_id").asc_nulls_first(), "text"]
    inside = Window.partitionBy("range").orderBy(*order)
    led = (rows.withColumn("next_text", F.lead("text").over(inside))
           .withColumn("next_fingerprint", F.lead("fingerprint").over(inside)))
    # the first row of each range, known by its doc_id alone; at most `ranges` rows
    least = ranged.groupBy("range").agg(F.min_by("doc_id", F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("doc_id"))
    firsts = (ranged.join(F.broadcast(least.select(F.col("range").alias("r"), F.col("doc_id").alias("d"))),
                        (F.col("range") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("d")))
              .groupBy("range").agg(F.min("text").alias("text"))
              .select("range", F.struct("text", sketch(F.col("text"), k).alias("fingerprint")).alias("first")))
    nearby = Window.orderBy("range")
    starts = firsts.select("range", F.coalesce(F.lead("first").over(nearby), F.first("first").over(nearby)).alias("first"))
    return (led.join(starts, "range", "left")
            .withColumn("next_text", F.coalesce("next_text", "first.text"))
            .withColumn("next_fingerprint", F.coalesce("next_fingerprint", "first.fingerprint"))
            .drop("range", "first"))


def fingerprint_documents(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, distinct_shingles.

    The edited text has its last floor(n_chars / 2) characters replaced by the
    first as many of the next document.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    own = docs.select(docs["doc_id"], text.alias("text"), F.length(text).cast("long").alias("n_chars"))
    after = with_next(own, k)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
                      F.substring("next_text", F.lit(1), half))
    done = after.withColumn("edited", edited).withColumn("edited_sketch", sketch(F.col("edited"), k))
    return done.select(
        "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        as_text(F.col("fingerprint")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("fingerprint"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("fingerprint"), F.col("next_fingerprint"), k).alias("near_next"),
        distinct_shingles(F.col("fingerprint"), k).alias("distinct_shingles"))
