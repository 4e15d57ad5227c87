"""Vector-layer publish reconciliation.

IDs: U2, U3, C6, C7.  Prefix matching (C7) is an equi join on the
name prefixes of expected lengths, not a nested-loop theta join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def existing_names(expected: DataFrame, layers: DataFrame, exp: str = "expected", name: str = "layer") -> DataFrame:
    """Every expected name once with whether a layer of that very name exists."""
    there = layers.select(F.col(name).alias(exp)).distinct().withColumn("_hit", F.lit(True))
    return (expected.select(exp).distinct().join(there, exp, "left")
            .select(exp, F.coalesce("_hit", F.lit(False)).alias("exists")))


def new_layers(after: DataFrame, before: DataFrame, name: str = "layer") -> DataFrame:
    """Layers present after the upload and not before (set difference)."""
    return after.select(name).distinct().join(before.select(name).distinct(), name, "left_anti")


def match_expected(expected: DataFrame, layers: DataFrame, exp: str = "expected", name: str = "layer") -> DataFrame:
    """For each expected table name, the new layer published from it.

    Candidates are layers starting with the expected name; the pick is the
    exact name, else ``name + digits`` (an auto-incremented copy), else the
    shortest, then the smallest name; ``ambiguous`` marks more than one
    candidate.  A layer is cut only to the lengths that occur in ``expected``
    and equi-joined."""
    names = expected.select(exp).where(F.col(exp).isNotNull()).distinct()
    lengths = names.select(F.length(exp).alias("n")).distinct()
    # distinct lengths are few (names are short); the list bounds the explode
    known = F.array_compact(F.array(*(F.lit(r[0]) for r in lengths.orderBy("n").collect()))) \
        if not lengths.isEmpty() else F.array().cast("array<int>")
    fits = F.filter(known, lambda n: n <= F.length(name))
    pref = layers.select(name, F.explode(F.transform(fits, lambda n: F.left(F.col(name), n))).alias(exp))
    cand = names.join(pref, exp)
    tail = F.expr(f"substring({name}, length({exp}) + 1)")
    rank = (F.when(F.col(name) == F.col(exp), F.lit(0))
            .when(tail.rlike("^[0-9]+$"), F.lit(1)).otherwise(F.lit(2)))
    best = cand.groupBy(exp).agg(F.min(F.struct(rank.alias("r"), F.length(name).alias("l"), F.col(name).alias("n")))
                                 .alias("_b"), F.count("*").cast("bigint").alias("n_matches"))
    return best.select(exp, F.col("_b.n").alias(name), "n_matches", (F.col("n_matches") > 1).alias("ambiguous"))


def reconcile(expected: DataFrame, after: DataFrame, before: DataFrame, exp: str = "expected",
              name: str = "layer") -> DataFrame:
    """C7 + U3: outcome per expected name - ``published`` (a new layer
    matched), ``pre-existing`` (the name was already there) or ``missing``.
    When nothing matched but new layers exist, every new layer counts as
    published (U3), with a NULL expected name."""
    new = new_layers(after, before, name)
    matched = match_expected(expected, new, exp, name)
    existing = after.select(F.col(name).alias(exp)).distinct().withColumn("_pre", F.lit(True))
    out = (expected.select(exp).distinct().join(matched, exp, "left").join(existing, exp, "left")
           .select(exp, F.when(F.col(name).isNotNull(), F.lit("published"))
                   .when(F.col("_pre"), F.lit("pre-existing")).otherwise(F.lit("missing")).alias("outcome"),
                   name, F.coalesce("n_matches", F.lit(0)).cast("bigint").alias("n_matches"),
                   F.coalesce("ambiguous", F.lit(False)).alias("ambiguous")))
    # U3: "did anything match?" is an uncorrelated EXISTS subquery, run once
    # and used as a filter - no join at all.
    fallback = (new.where(~matched.exists())
                .select(F.lit(None).cast("string").alias(exp), F.lit("published").alias("outcome"), name,
                        F.lit(1).cast("bigint").alias("n_matches"), F.lit(False).alias("ambiguous")))
    return out.unionByName(fallback)
