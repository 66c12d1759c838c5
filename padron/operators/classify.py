"""Tell temporary consortia from companies, and decode what a CIF says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.functions.tax_id import VALID, cif_code, id_type
from padron.functions.text import leading_segment
from padron.sources.lookups import entity_letters, provinces

# Fixed value: wording that marks a consortium.
CONSORTIUM = r"(?iU)\b(u\.?t\.?e|union temporal empresas|uniones temporales de empresas)\b"


def names_consortium(c: Column) -> Column:
    return F.coalesce(c.rlike(CONSORTIUM), F.lit(False))


def is_consortium(any_name: Column, id_: Column, legal_form: Column, description: Column) -> Column:
    """A used name, the ID's first letter, the legal form or the description says so."""
    return (
        any_name
        | F.coalesce(id_.startswith("u"), F.lit(False))
        | names_consortium(F.lower(legal_form))
        | names_consortium(F.lower(description))
    )


def decode_cif(df: DataFrame, column: str = "ID") -> DataFrame:
    """Adds ``Province, CompanyType, CompanyDescription``; all null for an ID that is no valid CIF.

    The two lookups are fixed tables of 17 and 85 rows.
    """
    spark = df.sparkSession
    code = F.when(cif_code(F.col(column)) == VALID, F.col(column))
    letters = entity_letters(spark).select(
        F.col("letter").alias("_letter"),
        leading_segment(F.col("forms"), ",").alias("CompanyType"),
        F.col("description").alias("CompanyDescription"),
    )
    places = provinces(spark).select(F.col("code").alias("_code"), F.col("province").alias("Province"))
    return (
        df.withColumn("_cif", code)
        .withColumn("_letter", F.substring("_cif", 1, 1))
        .withColumn("_code", F.substring("_cif", 2, 2))
        .join(F.broadcast(letters), "_letter", "left")
        .join(F.broadcast(places), "_code", "left")
        .drop("_cif", "_letter", "_code")
    )


def with_id_type(df: DataFrame, column: str = "ID", name: str = "NIFtype") -> DataFrame:
    return df.withColumn(name, id_type(F.col(column)))
