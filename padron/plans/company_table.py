"""Company and consortium tables from tender mentions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.functions.text import squash_space
from padron.operators.classify import decode_cif, is_consortium, names_consortium, with_id_type
from padron.operators.mentions import clean_mentions
from padron.operators.resolve import attach_golden_id, id_summary, mention_groups, replaced_ids
from padron.operators.survivorship import by_length, leading_segment
from padron.sources.staging import stage
from padron.sources.tables import write_table

COLUMNS = [
    "NIF",
    "FullName",
    "Name",
    "Province",
    "NIFtype",
    "CompanyType",
    "CompanyDescription",
    "isPYME",
]

#: Tasks of the cleaning for each core, so that a last round of few tasks is short.
TASKS_PER_CORE = 4


@dataclass(frozen=True)
class CompanyTables:
    """``companies`` and ``consortia``: one row per NIF, at any size.

    ``tenders``: one row per mention, NIF, id_tender and its place (ID, Name_norm, ord).
    """

    companies: DataFrame
    consortia: DataFrame
    tenders: DataFrame
    used_names: DataFrame


def associations(mentions: DataFrame) -> DataFrame:
    """Distinct raw (ID, Name) with everything later steps need, already aggregated.

    Names are cleaned here, once per distinct pair instead of once per mention.
    """
    known = mentions.filter(F.col("ID").isNotNull() & F.col("Name").isNotNull()).withColumns(
        {"_city": squash_space(F.col("CityName")), "_zone": squash_space(F.col("PostalZone"))}
    )
    pairs = known.groupBy(F.col("ID").alias("raw_id"), F.col("Name").alias("raw_name")).agg(
        F.count(F.lit(1)).alias("count"),
        F.min("ord").alias("ord"),
        F.bool_and(F.coalesce("SMEAwardedIndicator", F.lit(False))).alias("isPYME"),
        F.min("_city").alias("city_lo"),
        F.max("_city").alias("city_hi"),
        F.min("_zone").alias("zone_lo"),
        F.max("_zone").alias("zone_hi"),
    )
    # cleaning costs much more than the bytes of a pair tell, and tasks sized by bytes are hardly more than there are cores
    # (in the order of the grouping the keys would be dealt as they are where the number of tasks is the same)
    n = TASKS_PER_CORE * mentions.sparkSession.sparkContext.defaultParallelism
    named = pairs.repartition(n, "raw_name", "raw_id").withColumns({"ID": F.col("raw_id"), "Name": F.col("raw_name")})
    return clean_mentions(named, keep=["raw_id", "raw_name", "city_lo", "city_hi", "zone_lo", "zone_hi"])


def _variants(pairs: DataFrame) -> DataFrame:
    """One row per ID and name without legal form, over all spellings; what follows reads these, not the spellings.

    ``ord`` is compared in a struct, where null comes first as it does in ``_proposed``.
    """
    return pairs.groupBy("ID", "Name_proc", "Name_norm").agg(
        F.sum("count").alias("count"),
        F.min(F.struct("ord"))["ord"].alias("ord"),
        F.min(by_length(F.col("Name"))).alias("longest"),
        F.bool_and("isPYME").alias("isPYME"),
        F.bool_or(names_consortium(F.col("Name"))).alias("named_consortium"),
        F.min("city_lo").alias("city_lo"),
        F.max("city_hi").alias("city_hi"),
        F.min("zone_lo").alias("zone_lo"),
        F.max("zone_hi").alias("zone_hi"),
    )


def _golden_table(assigned: DataFrame) -> DataFrame:
    """One row per golden ID from ``_variants`` with their ``golden_id``.

    ``Name`` is the most frequent name without legal form; ties go to the first in
    (ID, key, input) order.
    """
    first = F.min(F.struct("ID", "Name_norm", "ord"))
    named = assigned.groupBy("golden_id", "Name_proc").agg(
        F.sum("count").alias("count"),
        first.alias("first"),
        F.min("longest").alias("longest"),
        F.bool_and("isPYME").alias("isPYME"),
        F.bool_or("named_consortium").alias("named_consortium"),
        F.min("city_lo").alias("city_lo"),
        F.max("city_hi").alias("city_hi"),
        F.min("zone_lo").alias("zone_lo"),
        F.max("zone_hi").alias("zone_hi"),
    )
    best = F.min(F.struct((-F.col("count")).alias("n"), "first", F.col("Name_proc").alias("name")))
    longest = F.array_min(F.array(F.min("longest"), F.min(by_length(F.col("Name_proc")))))
    return named.groupBy("golden_id").agg(
        best["name"].alias("Name"),
        longest["value"].alias("FullName"),
        F.bool_and("isPYME").alias("isPYME"),
        F.bool_or(F.col("named_consortium") | names_consortium(F.col("Name_proc"))).alias("named_consortium"),
        F.when(F.min("city_lo") == F.max("city_hi"), F.max("city_hi")).alias("City"),
        leading_segment(F.when(F.min("zone_lo") == F.max("zone_hi"), F.max("zone_hi")), ".").alias("PostalCode"),
        F.sum("count").alias("n_mentions"),
    )


def company_tables(mentions: DataFrame) -> CompanyTables:
    """Golden companies and consortia.

    ``mentions``: ID, Name, id_tender (text), SMEAwardedIndicator (boolean), CityName,
    PostalZone and ``ord``, a unique input position.

    Only the first aggregate and the tender lists touch every mention.
    """
    cleaned = stage(associations(mentions), "associations")
    pairs = cleaned.filter(F.col("ID").isNotNull() & F.col("Name_norm").isNotNull())
    variants = stage(_variants(pairs), "variants")
    ids = stage(id_summary(mention_groups(variants, weight="count").drop("first")), "ids")
    replaced = replaced_ids(ids)
    assigned = attach_golden_id(pairs, replaced)
    table = _golden_table(attach_golden_id(variants, replaced)).withColumnRenamed("golden_id", "NIF")
    decoded = with_id_type(decode_cif(table, "NIF"), "NIF")
    companies = stage(decoded, "companies")
    kind = is_consortium(
        F.col("named_consortium"), F.col("NIF"), F.col("CompanyType"), F.col("CompanyDescription")
    )
    return CompanyTables(
        companies=companies.drop("named_consortium"),
        consortia=companies.filter(kind).drop("named_consortium"),
        tenders=tender_rows(mentions, assigned),
        used_names=used_name_rows(assigned),
    )


def tender_rows(mentions: DataFrame, assigned: DataFrame) -> DataFrame:
    """``NIF, id_tender, ID, Name_norm, ord``: the tenders of each golden company, one row per mention.

    Sorted by (ID, Name_norm, ord) the rows of a company are its list of tenders.
    """
    keys = ["raw_id", "raw_name"]
    rows = mentions.select(F.col("ID").alias("raw_id"), F.col("Name").alias("raw_name"), "id_tender", "ord")
    own = assigned.select(*keys, F.col("golden_id").alias("NIF"), "ID", "Name_norm")
    return rows.join(own, keys).select("NIF", squash_space(F.col("id_tender")).alias("id_tender"), "ID", "Name_norm", "ord")


def used_name_rows(assigned: DataFrame) -> DataFrame:
    """Every name a golden company was seen under, one row each."""
    both = F.explode(F.array("Name", "Name_proc"))
    return assigned.select(F.col("golden_id").alias("NIF"), both.alias("used_name")).distinct()


def output_columns(table: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The published column set; ``City`` and ``PostalCode`` can be asked for."""
    return table.select(*COLUMNS, *extra)


def write_company_tables(
    tables: CompanyTables,
    folder: str,
    companies: str = "companies.parquet",
    consortia: str = "consortia.parquet",
    tenders: str = "tenders.parquet",
) -> None:
    """Companies, consortia (one row per NIF) and their tenders as Parquet under ``folder``."""
    write_table(output_columns(tables.companies), f"{folder}/{companies}")
    write_table(output_columns(tables.consortia), f"{folder}/{consortia}")
    write_table(tables.tenders, f"{folder}/{tenders}")
