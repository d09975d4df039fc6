"""Mixing sources to target weights.

The words of each source are summed, targets share out all words by weight,
and a source's rate is its target over its words.  Each document is emitted
floor(rate) times and once more with a probability of the fraction, by a hash
of its id and text, so reruns agree and no document is known to another.
Of ``SEEDS`` seeds for that hash, each source takes the one that brings its
words nearest to its target.

Targets stop at ``most`` times a source's words.  What is above is shared
among the rest by weight until none is above: target = min(most * size,
level * weight), where the level makes the targets sum to all words.

Defined cases: a null text has no words; a null source is a source of its own,
ordered last; sources without words have target 0 and take nothing; an empty
table gives no rows; equal rows draw alike; rows with a null doc_id draw by
their text; further columns are kept by ``mix`` and ignored by ``shares``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimforge.llm.common import materialize

WEIGHTS = (1, 2, 3)
MOST = 3
SEEDS = 32
_WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target from rows (source, size).

    Only scalars come to the driver: each round sums the sources that are not
    at their cap, and the level rises until no further source reaches it.
    """
    grouped = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = _ranked(grouped)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = materialize(ranked.select("source", "source_size", weight.alias("weight"),
                                        (F.lit(float(most)) * F.col("source_size")).alias("cap")), "sources")
    level = 0.0
    while True:
        capped = F.col("cap") <= F.lit(level) * F.col("weight")
        row = weighed.agg(F.sum("source_size").alias("all"), F.sum(F.when(capped, F.col("cap"))).alias("full"),
                          F.sum(F.when(~capped, F.col("weight"))).alias("open")).first()
        if not row["open"]:
            break
        risen = (row["all"] - (row["full"] or 0.0)) / row["open"]
        if risen <= level * (1 + 1e-15):
            break
        level = risen
    return weighed.select("source", "source_size", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds ``place``, from 0, by code point of the source, null last.

    Ranges are sorted in parallel; only their row counts are summed in one task.
    """
    ordered = materialize(sources.orderBy(F.col("source").asc_nulls_last())
                          .withColumn("at", F.monotonically_increasing_id()), "source-order")
    ordered = ordered.withColumn("range", F.shiftright("at", 33)).withColumn("inside", F.col("at").bitwiseAND((1 << 33) - 1))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ordered.groupBy("range").agg(F.count("*").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return ordered.join(ranges, "range").select("source", "source_size", (F.col("before") + F.col("inside")).alias("place"))


def _draw(seed: Column | int) -> Column:
    """Uniform in [0, 1) by document and seed."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    return F.shiftrightunsigned(F.xxhash64("doc_id", "text_hash", seed), 11) * F.lit(2.0 ** -53)


def shares(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, text_hash, source, size, source_size, target, copies per row."""
    sizes = materialize(docs.select("doc_id", "source", word_count(docs["text"]).alias("size"),
                                    F.xxhash64(docs["text"]).alias("text_hash")), "document-sizes")
    rates = targets(sizes, weights, most).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    rated = sizes.join(_hinted(rates), sizes["source"].eqNullSafe(rates["source"])).drop(rates["source"])
    whole, fraction = F.floor("rate"), F.col("rate") - F.floor("rate")
    # words each seed would take, beyond the whole copies
    tried = rated.groupBy("source").agg(
        F.max(fraction * F.col("source_size")).alias("wanted"),
        *[F.sum(F.when(_draw(s) < fraction, F.col("size")).otherwise(0)).alias(f"s{s}") for s in range(SEEDS)])
    miss = F.array(*[F.struct(F.abs(F.col(f"s{s}") - F.col("wanted")).alias("miss"), F.lit(s).alias("seed"))
                     for s in range(SEEDS)])
    seeds = materialize(tried.select(F.col("source").alias("seed_source"), F.array_min(miss)["seed"].alias("seed")), "seeds")
    drawn = rated.join(_hinted(seeds), rated["source"].eqNullSafe(seeds["seed_source"]))
    return drawn.select("doc_id", "text_hash", "source", "size", "source_size", "target",
                        (whole + F.when(_draw(F.col("seed")) < fraction, 1).otherwise(0)).alias("copies"))


def _hinted(sources: DataFrame, rows: int = 100_000) -> DataFrame:
    """A broadcast for up to ``rows`` sources (counted); else Spark's skew-splitting join."""
    return F.broadcast(sources) if sources.limit(rows + 1).count() <= rows else sources.hint("merge")


def mixture(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken."""
    return shares(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The documents of the mix: each row as often as it is taken.

    Rows are matched to their number of copies by doc_id, source and text
    hash; rows that agree in these draw alike, so one of them tells for all.
    """
    key = ["doc_id", "source", "text_hash"]
    copies = shares(docs).groupBy(*key).agg(F.first("copies").alias("copies")).where("copies > 0")
    copies = copies.select(*[F.col(c).alias(f"_mix_{c}") for c in key], F.col("copies").alias("_mix_copies"))
    rows = docs.withColumn("_mix_hash", F.xxhash64("text"))
    matched = rows.join(copies, (rows["doc_id"].eqNullSafe(copies["_mix_doc_id"]))
                        & rows["source"].eqNullSafe(copies["_mix_source"]) & (rows["_mix_hash"] == copies["_mix_text_hash"]))
    return matched.select(*[docs[c] for c in docs.columns], F.explode(F.array_repeat(F.lit(1), F.col("_mix_copies").cast("int"))).alias("_mix_copy")).drop("_mix_copy")
