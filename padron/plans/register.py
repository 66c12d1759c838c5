"""Link an external company register to the company table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.functions.cells import flag_from_letter
from padron.functions.tax_id import correct_id, id_type, is_valid_id, normalise_id, valid_or_null
from padron.functions.text import clean_name
from padron.sources.staging import stage

ATTRIBUTES = ["nif", "company", "NameProposed", "isPYME", "UTE"]


def standardise_register(df: DataFrame) -> DataFrame:
    """``ID_EMPRESA, NIF, NOMBRE, UTE`` (S/N) -> cleaned names, ID, validity, type and flag."""
    tax_id = normalise_id(F.col("NIF"))
    return (
        df.select("ID_EMPRESA", "NOMBRE", tax_id.alias("nif"), flag_from_letter(F.col("UTE")).alias("UTE"))
        .withColumn("empresa", clean_name(F.col("NOMBRE")))
        .withColumn("empresa_proc", clean_name(F.col("empresa"), remove_type=True))
        .withColumn("UsedNames", F.array_sort(F.array_distinct(F.array_compact(F.array("empresa", "empresa_proc")))))
        .withColumn("valid_nif", F.when(F.col("nif") != "", is_valid_id(F.col("nif"))))
        .withColumn("nif_type", F.when(F.col("nif") != "", id_type(F.col("nif"))))
    )


@dataclass(frozen=True)
class RegisterLinks:
    """``values``: ID_EMPRESA, tier, attribute, value, distinct. ``not_found``: register rows without a match."""

    values: DataFrame
    found: DataFrame
    not_found: DataFrame


def link_by_id(register: DataFrame, companies: DataFrame) -> DataFrame:
    """Register rows joined to companies on the tax ID (rows without one match nothing)."""
    mine = register.filter(F.col("nif").isNotNull())
    return mine.join(companies, "nif")


def alias_rows(df: DataFrame, key: str, names: str) -> DataFrame:
    return df.select(key, F.explode(names).alias("alias")).filter("alias <> ''").distinct()


def merged_valid_ids(*ids: Column) -> Column:
    """Sorted set of the valid ones among several IDs."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[valid_or_null(normalise_id(i)) for i in ids]))))


def _melt(df: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """``key, attribute, value``: one row per known value."""
    items = F.array(*[F.struct(F.lit(n).alias("attribute"), v.cast("string").alias("value")) for n, v in values.items()])
    return df.select(key, F.inline(items)).filter(F.col("value").isNotNull())


def _facts(id_value: Column) -> dict[str, Column]:
    return {
        "nif": id_value,
        "company": F.col("nif"),
        "NameProposed": F.col("NameProposed"),
        "isPYME": F.col("isPYME"),
    }


def _known(names: str) -> Column:
    return F.coalesce(F.col(names), F.array().cast("array<string>"))


def found_by_id(register: DataFrame, companies: DataFrame) -> DataFrame:
    """``ID_EMPRESA, attribute, value`` for register rows whose ID a company has."""
    own = companies.select("nif", "NameProposed", "isPYME", F.col("UsedNames").alias("theirs"))
    met = link_by_id(register.select("ID_EMPRESA", "nif", "UTE", "UsedNames"), own)
    facts = _melt(met, "ID_EMPRESA", _facts(F.col("nif")) | {"UTE": F.col("UTE")})
    names = met.select("ID_EMPRESA", F.explode(F.concat(_known("UsedNames"), _known("theirs"))).alias("value")).select(
        "ID_EMPRESA", F.lit("UsedNames").alias("attribute"), "value"
    )
    return facts.unionByName(names).distinct()


def found_by_alias(register: DataFrame, companies: DataFrame) -> DataFrame:
    """The same through a shared name.

    Company values are reduced to a distinct set per alias before the join, so an alias
    used by many companies contributes each of its values once per register row.
    """
    mine = register.select("ID_EMPRESA", "nif", "UTE", F.explode("UsedNames").alias("alias")).filter("alias <> ''")
    theirs = companies.select("*", F.explode("UsedNames").alias("alias")).filter("alias <> ''")
    per_alias = _melt(theirs, "alias", _facts(valid_or_null(normalise_id(F.col("nif"))))).distinct()
    known = keep_shared(mine, theirs)
    named = F.struct(F.lit("UsedNames").alias("attribute"), F.col("alias").alias("value"))
    own_id = F.struct(F.lit("nif").alias("attribute"), valid_or_null(F.col("nif")).alias("value"))
    flag = F.struct(F.lit("UTE").alias("attribute"), F.col("UTE").cast("string").alias("value"))
    own = known.select("ID_EMPRESA", F.inline(F.array(named, own_id, flag))).filter(F.col("value").isNotNull())
    met = known.select("ID_EMPRESA", "alias").distinct().join(per_alias, "alias")
    return met.select("ID_EMPRESA", "attribute", "value").unionByName(own).distinct()


def keep_shared(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    return mine.join(theirs.select("alias").distinct(), "alias", "left_semi")


def link_register(register: DataFrame, companies: DataFrame) -> RegisterLinks:
    """Match by ID first, then the rest by alias; both tiers merged as distinct values.

    ``companies``: nif, UsedNames (array), NameProposed, isPYME.
    """
    by_id = stage(found_by_id(register, companies), "found-by-id")
    rest = register.join(by_id.select("ID_EMPRESA").distinct(), "ID_EMPRESA", "left_anti")
    by_alias = stage(found_by_alias(rest, companies), "found-by-alias")
    values = by_id.withColumn("tier", F.lit("id")).unionByName(by_alias.withColumn("tier", F.lit("alias")))
    found = values.select("ID_EMPRESA").distinct()
    return RegisterLinks(values, found, register.join(found, "ID_EMPRESA", "left_anti"))


def value_sets(values: DataFrame) -> DataFrame:
    """``ID_EMPRESA, attribute, value``: the value sets, one row for each member."""
    return values.select("ID_EMPRESA", "attribute", "value").distinct()


def consistency(values: DataFrame) -> DataFrame:
    """One row per found register row: whether every attribute has at most one value, and those values.

    Decided from the smallest and largest value of each attribute, so no set is built.
    """
    aggs = []
    for name in ATTRIBUTES:
        own = F.when(F.col("attribute") == name, F.col("value"))
        aggs += [F.min(own).alias(f"{name}_lo"), F.max(own).alias(f"{name}_hi")]
    spread = values.groupBy("ID_EMPRESA").agg(*aggs)
    fits = F.lit(True)
    for name in ATTRIBUTES:
        fits = fits & F.coalesce(F.col(f"{name}_lo") == F.col(f"{name}_hi"), F.lit(True))
    return spread.select(
        "ID_EMPRESA",
        fits.alias("consistent"),
        *[F.when(fits, F.col(f"{name}_lo")).alias(name) for name in ATTRIBUTES],
    )


def match_quality(register: DataFrame, found: DataFrame) -> DataFrame:
    """Register rows by outcome and ID quality, and how many invalid IDs of the missed ones can be corrected."""
    hit = found.select("ID_EMPRESA").distinct().withColumn("_hit", F.lit(True))
    outcome = F.when(F.col("_hit"), F.lit("found")).otherwise(F.lit("not_found"))
    marked = register.join(hit, "ID_EMPRESA", "left").withColumn("outcome", outcome)
    null_id, valid = F.col("nif").isNull(), F.coalesce("valid_nif", F.lit(False))
    return marked.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(null_id).alias("null_ids"),
        F.count_if(valid).alias("valid_ids"),
        F.count_if(~valid).alias("invalid_ids"),
        F.count_if(~valid & correct_id(F.col("nif")).isNotNull()).alias("correctable_ids"),
    )
