"""A/B comparison of conversion between two groups of users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def assign_variant(users: DataFrame, experiment: str) -> DataFrame:
    """Add ``variant`` A or B, a fixed half-and-half split by a digest of user and experiment.

    Any system that has MD5 can repeat it: A where the first hexadecimal digit is even.
    """
    digit = F.substring(F.md5(F.concat("user_id", F.lit("|"), F.lit(experiment)).cast("binary")), 1, 1)
    return users.withColumn("variant", F.when(digit.isin(list("02468ace")), "A").otherwise("B"))


def ab_test(users: DataFrame, variant_col: str = "variant", converted: Column | None = None) -> DataFrame:
    """Conversion of variant B against A: counts, rates, lift and pooled z-score.

    ``users`` has one row per user with variant ``A`` or ``B``; a user converts with a
    purchase unless ``converted`` says otherwise. Undefined ratios are NULL.
    """
    converted = F.col("total_purchases") > 0 if converted is None else converted
    in_variant = lambda name: F.col(variant_col) == name
    counts = users.agg(
        F.count_if(in_variant("A")).alias("users_a"),
        F.count_if(in_variant("A") & converted).alias("converters_a"),
        F.count_if(in_variant("B")).alias("users_b"),
        F.count_if(in_variant("B") & converted).alias("converters_b"),
    )
    users_a, users_b = F.col("users_a"), F.col("users_b")
    rate_a, rate_b = F.col("rate_a"), F.col("rate_b")
    pooled = F.try_divide(F.col("converters_a") + F.col("converters_b"), users_a + users_b)
    spread = pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), users_a) + F.try_divide(F.lit(1.0), users_b))
    return (
        counts.withColumn("rate_a", F.try_divide("converters_a", "users_a"))
        .withColumn("rate_b", F.try_divide("converters_b", "users_b"))
        .withColumn("lift", F.try_divide(rate_b, rate_a) - 1)
        .withColumn("z_score", F.try_divide(rate_b - rate_a, F.sqrt(spread)))
    )
