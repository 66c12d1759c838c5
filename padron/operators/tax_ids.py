"""Tax IDs found where they do not belong: foreign prefixes, IDs inside names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.functions.tax_id import is_valid_id, normalise_id
from padron.functions.text import words
from padron.sources.lookups import countries


def foreign_prefixes(df: DataFrame, column: str = "ID") -> DataFrame:
    """Per VAT country prefix: IDs carrying it, and those whose rest is a valid national ID."""
    prefixes = countries(df.sparkSession).select("prefix")
    split = df.select(
        F.substring(column, 1, 2).alias("prefix"), normalise_id(F.substr(F.col(column), F.lit(3))).alias("rest")
    )
    kept = split.join(F.broadcast(prefixes), "prefix", "left_semi")
    return kept.groupBy("prefix").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_valid_id(F.col("rest"))).alias("n_valid")
    )


def ids_in_names(df: DataFrame, column: str) -> DataFrame:
    """Adds ``name`` (the words that are no valid ID) and ``nif`` (the most frequent valid one, the first among equals)."""
    valid, other = F.col("_valid"), F.col("_words")
    scored = F.transform(
        F.array_distinct(valid),
        lambda t: F.struct(
            F.size(F.filter(valid, lambda v: v == t)).alias("n"), (-F.array_position(valid, t)).alias("at"), t.alias("id")
        ),
    )
    return (
        df.withColumn("_words", words(F.col(column)))
        .withColumn("_valid", F.filter("_words", lambda w: is_valid_id(normalise_id(w))))
        .withColumn("name", F.array_join(F.filter(other, lambda w: ~is_valid_id(normalise_id(w))), " "))
        .withColumn("nif", F.array_max(scored)["id"])
        .drop("_words", "_valid")
    )
