"""Golden records, survivorship and the company table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.catalogue.fixtures import (
    FULL_MENTIONS_SQL,
    MENTIONS_SQL,
    TENDERS_SQL,
    cif_text_sql,
    mentions,
    province_sql,
    raw_mentions,
    raw_tenders,
    table,
)
from padron.catalogue.registry import query
from padron.operators.mentions import clean_mentions_once
from padron.operators.resolve import (
    first_per_key,
    flag_repeated,
    golden_records,
    id_summary,
    mention_groups,
    mention_items,
    regroup_items,
    rejected_mentions,
    unify_repeated,
    unique_pairs,
)
from padron.operators.survivorship import (
    first_seen_mode,
    flag_consensus,
    mode_value,
    unanimous,
    unanimous_code,
    value_frequency,
    weighted_mode,
)
from padron.plans.chain import companies_from_tenders
from padron.plans.company_table import company_tables, output_columns
from padron.sources.staging import stage

GROUPS_SQL = f"""
{MENTIONS_SQL},
groups AS (SELECT "ID", "Name_norm", count(*) AS "count", min(ord) AS first FROM mentions GROUP BY "ID", "Name_norm")
"""
SETTLED_SQL = f"""
{GROUPS_SQL},
id_ranked AS (
  SELECT *, count(*) OVER (PARTITION BY "ID") AS n_groups, sum("count") OVER (PARTITION BY "ID") AS total,
         row_number() OVER (PARTITION BY "ID" ORDER BY "count" DESC, length("Name_norm") DESC, "Name_norm") AS place
  FROM groups),
by_id AS (SELECT "ID", "Name_norm", CAST(total AS BIGINT) AS "count", n_groups, 'id' AS settled FROM id_ranked WHERE n_groups > 1 AND place = 1),
name_ranked AS (
  SELECT "ID", "Name_norm", count(*) OVER (PARTITION BY "Name_norm") AS n_groups, sum("count") OVER (PARTITION BY "Name_norm") AS total,
         row_number() OVER (PARTITION BY "Name_norm" ORDER BY "count" DESC, length("ID") DESC, "ID") AS place
  FROM id_ranked WHERE n_groups = 1),
by_name AS (
  SELECT "ID", "Name_norm", CAST(total AS BIGINT) AS "count", n_groups, CASE WHEN n_groups > 1 THEN 'name' ELSE 'alone' END AS settled
  FROM name_ranked WHERE place = 1)
"""


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mention_groups(mentions(spark, sf_dir))


@query(
    f"""
    WITH {MENTIONS_SQL}
    SELECT "ID", "Name_norm", count(*) OVER g AS n, min(ord) OVER g AS first, ord, l_orderkey FROM mentions WINDOW g AS (PARTITION BY "ID", "Name_norm")
    """
)
def q_group_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mentions(spark, sf_dir)
    items = mention_items(rows, "l_orderkey")
    return mention_groups(rows).withColumnRenamed("count", "n").join(items, ["ID", "Name_norm"])


@query(
    f"""
    WITH {MENTIONS_SQL}
    SELECT "ID", "Name_norm", ord, l_orderkey FROM mentions
    """
)
def q_regroup_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regroup_items(mention_items(mentions(spark, sf_dir), "l_orderkey"), ["ID"], "l_orderkey", ["Name_norm", "ord"])


@query(
    f"""
    WITH {GROUPS_SQL}
    SELECT "ID", "Name_norm", "count" AS n, count(*) OVER (PARTITION BY "ID") > 1 AS id_repeated,
           count(*) OVER (PARTITION BY "Name_norm") > 1 AS name_repeated FROM groups
    """
)
def q_flag_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_repeated(_groups(spark, sf_dir)).select(
        "ID", "Name_norm", F.col("count").alias("n"), "id_repeated", "name_repeated"
    )


@query(
    f"""
    WITH {GROUPS_SQL}
    SELECT "ID", "Name_norm", n FROM (
      SELECT "ID", "Name_norm", "count" AS n, count(*) OVER (PARTITION BY "ID") AS a, count(*) OVER (PARTITION BY "Name_norm") AS b FROM groups)
    WHERE a = 1 AND b = 1
    """
)
def q_unique_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique_pairs(_groups(spark, sf_dir)).select("ID", "Name_norm", F.col("count").alias("n"))


@query(
    f"""
    WITH {MENTIONS_SQL}
    SELECT "ID", "Name_norm" AS name FROM (
      SELECT "ID", "Name_norm", row_number() OVER (PARTITION BY "ID" ORDER BY count(*) DESC, length("Name_norm") DESC, "Name_norm") AS place
      FROM mentions GROUP BY "ID", "Name_norm") WHERE place = 1
    """
)
def q_mode_survivor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mode_value(mentions(spark, sf_dir), ["ID"], "Name_norm").withColumnRenamed("Name_norm", "name")


@query(f'WITH {SETTLED_SQL} SELECT "ID", "Name_norm", "count" AS n, n_groups FROM by_id')
def q_unify_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    unified = unify_repeated(_groups(spark, sf_dir), "ID", "Name_norm")
    return unified.select("ID", "Name_norm", F.col("count").alias("n"), "n_groups")


@query(f"""WITH {SETTLED_SQL} SELECT "ID", "Name_norm", "count" AS n, n_groups FROM by_name WHERE settled = 'name'""")
def q_unify_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names repeated among the IDs that have one name only."""
    single = id_summary(_groups(spark, sf_dir)).filter("n_groups = 1").drop("n_groups")
    return unify_repeated(single, "Name_norm", "ID").select("ID", "Name_norm", F.col("count").alias("n"), "n_groups")


@query(
    f"""
    WITH {SETTLED_SQL}
    SELECT "ID", "Name_norm", "count" AS n, n_groups, settled FROM by_id
    UNION ALL SELECT "ID", "Name_norm", "count", n_groups, settled FROM by_name
    """
)
def q_golden_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = stage(id_summary(_groups(spark, sf_dir)), "ids")
    return golden_records(ids).select("ID", "Name_norm", F.col("count").alias("n"), "n_groups", "settled")


@query(
    f"""
    WITH {MENTIONS_SQL}
    SELECT "ID", "Name_norm" AS name, round(n / total, 9) AS share FROM (
      SELECT "ID", "Name_norm", count(*) AS n, sum(count(*)) OVER (PARTITION BY "ID") AS total,
             row_number() OVER (PARTITION BY "ID" ORDER BY count(*) DESC, min(ord), "Name_norm") AS place
      FROM mentions GROUP BY "ID", "Name_norm") WHERE place = 1
    """
)
def q_proposed_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = first_seen_mode(mentions(spark, sf_dir), ["ID"], "Name_norm", F.col("ord"))
    return best.select("ID", F.col("Name_norm").alias("name"), F.round("share", 9).alias("share"))


@query(f'WITH {MENTIONS_SQL} SELECT "Name_norm" AS name, count(*) AS freq FROM mentions GROUP BY 1')
def q_global_name_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_frequency(mentions(spark, sf_dir), "Name_norm").withColumnRenamed("Name_norm", "name")


@query(
    f"""
    WITH {MENTIONS_SQL},
    local AS (SELECT "ID", "Name_norm", count(*) AS n, min(ord) AS first FROM mentions GROUP BY "ID", "Name_norm"),
    overall AS (SELECT "Name_norm", count(*) AS everywhere FROM mentions GROUP BY "Name_norm"),
    scored AS (
      SELECT "ID", "Name_norm", n, everywhere, sum(n) OVER (PARTITION BY "ID") AS total, sum(everywhere) OVER (PARTITION BY "ID") AS spread,
             row_number() OVER (PARTITION BY "ID" ORDER BY CAST(n AS DOUBLE) / everywhere DESC, first, "Name_norm") AS place
      FROM local JOIN overall USING ("Name_norm"))
    SELECT "ID", "Name_norm" AS name, round((CAST(n AS DOUBLE) / total) / (CAST(everywhere AS DOUBLE) / spread), 6) AS score
    FROM scored WHERE place = 1
    """
)
def q_weighted_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = weighted_mode(mentions(spark, sf_dir), ["ID"], "Name_norm", F.col("ord"))
    return best.select("ID", F.col("Name_norm").alias("name"), F.round("score", 6).alias("score"))


VOTES_SQL = """
votes AS (
  SELECT o_custkey AS c, o_orderstatus = 'F' OR (CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice > 5000 END) AS flag,
         CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS city,
         CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus || CASE WHEN o_custkey % 2 = 0 THEN '.0' ELSE '' END END AS zone
  FROM orders)
"""


def _votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    known = F.when(key % 3 != 0, F.col("o_totalprice") > 5000)
    suffix = F.when(F.col("o_custkey") % 2 == 0, F.lit(".0")).otherwise(F.lit(""))
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c"),
        ((status == "F") | known).alias("flag"),
        F.when(key % 4 != 0, status).alias("city"),
        F.when(key % 2 == 0, F.concat(status, suffix)).alias("zone"),
    )


@query(f"WITH {VOTES_SQL} SELECT c, bool_and(coalesce(flag, false)) AS flag FROM votes GROUP BY c")
def q_flag_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _votes(spark, sf_dir).groupBy("c").agg(flag_consensus(F.col("flag")).alias("flag"))


@query(f"WITH {VOTES_SQL} SELECT c, CASE WHEN count(DISTINCT city) = 1 THEN max(city) END AS city FROM votes GROUP BY c")
def q_unanimous_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _votes(spark, sf_dir).groupBy("c").agg(unanimous(F.col("city")).alias("city"))


@query(f"WITH {VOTES_SQL} SELECT c, CASE WHEN count(DISTINCT zone) = 1 THEN split_part(max(zone), '.', 1) END AS zone FROM votes GROUP BY c")
def q_unanimous_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _votes(spark, sf_dir).groupBy("c").agg(unanimous_code(F.col("zone")).alias("zone"))


@query(
    f"""
    WITH {MENTIONS_SQL}
    SELECT "ID", ord, l_returnflag FROM (
      SELECT "ID", ord, l_returnflag, row_number() OVER (PARTITION BY "ID" ORDER BY ord, k, l_returnflag) AS place FROM mentions) WHERE place = 1
    """
)
def q_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mentions(spark, sf_dir).select("ID", "ord", "k", "l_returnflag")
    return first_per_key(rows, "ID", "ord").select("ID", "ord", "l_returnflag")


@query(
    f"""
    WITH {FULL_MENTIONS_SQL}
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE l_partkey NOT IN (SELECT l_partkey FROM full_mentions)
    """
)
def q_rejected_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_mentions_once(raw_mentions(spark, sf_dir))
    return rejected_mentions(cleaned).select("ord.*")


COMPANY_TABLE_SQL = f"""
{FULL_MENTIONS_SQL},
pairs AS (
  SELECT "ID", "Name_norm", count(*) AS n FROM full_mentions GROUP BY "ID", "Name_norm"),
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY "ID") AS n_names FROM pairs),
golden AS (
  SELECT "ID", CASE WHEN n_names > 1 THEN "ID" ELSE first_value("ID") OVER (
    PARTITION BY n_names > 1, "Name_norm" ORDER BY n DESC, length("ID") DESC, "ID") END AS nif
  FROM ranked),
golden_ids AS (SELECT DISTINCT "ID", nif FROM golden),
assigned AS (
  SELECT g.nif, m.* FROM full_mentions m JOIN golden_ids g ON g."ID" = m."ID"),
proposed AS (
  SELECT nif, name FROM (
    SELECT nif, "Name_proc" AS name, row_number() OVER (PARTITION BY nif ORDER BY count(*) DESC,
      min(struct_pack(a := "ID", b := "Name_norm", c := l_orderkey, d := l_linenumber, e := l_partkey, f := l_suppkey))) AS place
    FROM assigned GROUP BY nif, "Name_proc") WHERE place = 1),
longest AS (
  SELECT nif, name FROM (
    SELECT nif, name, row_number() OVER (PARTITION BY nif ORDER BY length(name) DESC, name) AS place
    FROM (SELECT nif, "Name" AS name FROM assigned UNION SELECT nif, "Name_proc" FROM assigned)) WHERE place = 1),
attributes AS (
  SELECT nif, bool_and(coalesce(flag, false)) AS pyme, CASE WHEN count(DISTINCT city) = 1 THEN max(city) END AS city,
         CASE WHEN count(DISTINCT zone) = 1 THEN split_part(max(zone), '.', 1) END AS zone, count(*) AS n,
         bool_or("Name" LIKE '% u.t.e.') AS joint,
         string_agg(id_tender, '|' ORDER BY "ID", "Name_norm", l_orderkey, l_linenumber, l_partkey, l_suppkey) AS tenders
  FROM assigned GROUP BY nif),
final AS (
  SELECT a.nif AS "NIF", l.name AS "FullName", p.name AS "Name", a.pyme AS "isPYME", a.city AS "City", a.zone AS "PostalCode",
         a.n AS n_mentions, a.tenders AS id_tender, joint OR left(a.nif, 1) = 'u' AS consortium,
         CASE WHEN left(a.nif, 1) IN ('b', 'u') THEN 'CIF' ELSE 'DNI' END AS "NIFtype",
         CASE left(a.nif, 1) WHEN 'b' THEN 's.l.' WHEN 'u' THEN 'u.t.e.' END AS "CompanyType",
         CASE left(a.nif, 1) WHEN 'b' THEN 'Sociedades de responsabilidad limitada' WHEN 'u' THEN 'Uniones Temporales de Empresas' END AS "CompanyDescription",
         CASE WHEN left(a.nif, 1) IN ('b', 'u') THEN substr(a.nif, 2, 2) END AS code
  FROM attributes a JOIN longest l USING (nif) JOIN proposed p USING (nif))
"""
SHOWN = f"""
"NIF", "FullName", "Name", "NIFtype", "CompanyType", "CompanyDescription", "isPYME", "City", "PostalCode", n_mentions, {province_sql("code")} AS "Province"
"""


@query(f"WITH {COMPANY_TABLE_SQL} SELECT {SHOWN} FROM final")
def q_company_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output_columns(company_tables(raw_mentions(spark, sf_dir)).companies, ("City", "PostalCode", "n_mentions"))


@query(f"WITH {COMPANY_TABLE_SQL} SELECT {SHOWN} FROM final WHERE consortium")
def q_consortium_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output_columns(company_tables(raw_mentions(spark, sf_dir)).consortia, ("City", "PostalCode", "n_mentions"))


@query(
    f"""
    WITH {COMPANY_TABLE_SQL}
    SELECT nif AS "NIF", "ID", "Name_norm", l_orderkey, l_linenumber, l_partkey, l_suppkey, id_tender FROM assigned
    """
)
def q_company_tenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    tenders = company_tables(raw_mentions(spark, sf_dir)).tenders
    return tenders.select("NIF", "ID", "Name_norm", "ord.*", "id_tender")


@query(
    f"""
    WITH {COMPANY_TABLE_SQL}
    SELECT "NIF", "FullName", "Name", {province_sql("code")} AS "Province", "NIFtype", "CompanyType", "CompanyDescription", "isPYME" FROM final
    """
)
def q_company_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output_columns(company_tables(raw_mentions(spark, sf_dir)).companies)


@query(f"""WITH {FULL_MENTIONS_SQL}, {COMPANY_TABLE_SQL.split(FULL_MENTIONS_SQL)[1].lstrip().lstrip(",")}
    SELECT DISTINCT nif AS "NIF", name AS used_name FROM (SELECT nif, "Name" AS name FROM assigned UNION SELECT nif, "Name_proc" FROM assigned)""")
def q_entity_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return company_tables(raw_mentions(spark, sf_dir)).used_names


@query(
    f"""
    WITH {TENDERS_SQL},
    seen AS (
      SELECT c + i AS k, count(*) AS n_mentions, bool_and(NOT no_flag AND i % 2 = 0) AS pyme, bool_or(NOT no_city) AS placed
      FROM winners WHERE NOT no_id AND NOT short AND (c + i) % 100 NOT IN (69, 89) AND c + i > 0 GROUP BY 1)
    SELECT {cif_text_sql("'b'", "k")} AS "NIF", 'empresa ' || k AS "FullName", 'empresa ' || k AS "Name",
           {province_sql("lpad(CAST(k % 100 AS VARCHAR), 2, '0')")} AS "Province", 'CIF' AS "NIFtype", 's.l.' AS "CompanyType",
           'Sociedades de responsabilidad limitada' AS "CompanyDescription", pyme AS "isPYME",
           CASE WHEN placed THEN 'city ' || (k % 9) END AS "City", n_mentions
    FROM seen
    """
)
def q_tenders_to_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way from nested tenders to the company table."""
    tables = companies_from_tenders(raw_tenders(spark, sf_dir, valid_ids=True), ["level", "entry"])
    return output_columns(tables.companies, ("City", "n_mentions"))
