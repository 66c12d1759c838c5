"""From raw tenders to the company table, and from there to a register."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.operators.mentions import decode_flag, tender_mentions
from padron.plans.company_table import CompanyTables, company_tables
from padron.sources.tables import tender_lists

PARTY = ["ID", "Name", "SMEAwardedIndicator", "CityName", "PostalZone"]


def raw_mentions(tenders: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Nested tender rows -> one row per winner, with ``ord``: tender and place in its list.

    ``levels`` together identify a tender. Party columns the source lacks are null.
    """
    lists = tender_lists(tenders, list(levels))
    party = [c for c in PARTY if c in lists.columns]
    mentions = decode_flag(tender_mentions(lists, party))
    for column in PARTY:
        if column not in party:
            mentions = mentions.withColumn(column, F.lit(None).cast("string"))
    return mentions.withColumn("ord", F.struct("identifier", "pos"))


def companies_from_tenders(tenders: DataFrame, levels: Sequence[str]) -> CompanyTables:
    return company_tables(raw_mentions(tenders, levels))


def register_companies(tables: CompanyTables) -> DataFrame:
    """The company table as ``link_register`` reads it: one row for each company and used name."""
    named = tables.companies.join(tables.used_names, "NIF")
    return named.select(
        F.col("NIF").alias("nif"), F.array("used_name").alias("UsedNames"), F.col("Name").alias("NameProposed"), "isPYME"
    )
