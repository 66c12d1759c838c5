"""Register linkage, snapshots and data-quality reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.catalogue.fixtures import (
    REGISTER_SQL,
    dni_text,
    dni_text_sql,
    known_companies,
    raw_register,
    table,
)
from padron.catalogue.registry import query
from padron.frames import union_all
from padron.operators.quality import (
    duplicate_report,
    duplicate_share,
    forward_fill,
    key_is_unique,
    new_rows,
    null_profile,
    snapshot_diff,
    split_consistent,
    value_counts,
)
from padron.plans.register import (
    consistency,
    found_by_alias,
    found_by_id,
    link_by_id,
    link_register,
    match_quality,
    merged_valid_ids,
    standardise_register,
    value_sets,
)
from padron.sources.register import BAD_ID, MALFORMED, NO_ID, scan_register
from padron.sources.staging import checkpoint_root, stage

FOUND_SQL = f"""
{REGISTER_SQL},
by_id AS (
  SELECT r."ID_EMPRESA", unnest([
    struct_pack(attribute := 'nif', value := r.nif), struct_pack(attribute := 'company', value := r.nif),
    struct_pack(attribute := 'NameProposed', value := k."NameProposed"), struct_pack(attribute := 'isPYME', value := CAST(k."isPYME" AS VARCHAR)),
    struct_pack(attribute := 'UTE', value := CAST(r."UTE" AS VARCHAR))]) AS fact
  FROM register r JOIN known_companies k ON k.nif = r.nif),
by_id_names AS (
  SELECT r."ID_EMPRESA", ra.alias FROM register r JOIN known_companies k ON k.nif = r.nif JOIN register_aliases ra ON ra."ID_EMPRESA" = r."ID_EMPRESA"
  UNION SELECT r."ID_EMPRESA", ca.alias FROM register r JOIN company_aliases ca ON ca.nif = r.nif),
id_values AS (
  SELECT DISTINCT "ID_EMPRESA", fact.attribute AS attribute, fact.value AS value FROM by_id WHERE fact.value IS NOT NULL
  UNION SELECT "ID_EMPRESA", 'UsedNames', alias FROM by_id_names),
by_alias AS (
  SELECT ra."ID_EMPRESA", unnest([
    struct_pack(attribute := 'nif', value := CASE WHEN ra.valid_nif THEN ra.nif END), struct_pack(attribute := 'nif', value := ca.nif),
    struct_pack(attribute := 'company', value := ca.nif), struct_pack(attribute := 'NameProposed', value := ca."NameProposed"),
    struct_pack(attribute := 'isPYME', value := CAST(ca."isPYME" AS VARCHAR)), struct_pack(attribute := 'UTE', value := CAST(ra."UTE" AS VARCHAR)),
    struct_pack(attribute := 'UsedNames', value := ra.alias)]) AS fact
  FROM register_aliases ra JOIN company_aliases ca ON ca.alias = ra.alias
  WHERE ra."ID_EMPRESA" NOT IN (SELECT "ID_EMPRESA" FROM id_values)),
alias_values AS (
  SELECT DISTINCT "ID_EMPRESA", fact.attribute AS attribute, fact.value AS value FROM by_alias WHERE fact.value IS NOT NULL),
all_values AS (SELECT *, 'id' AS tier FROM id_values UNION ALL SELECT *, 'alias' FROM alias_values)
"""


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    register = stage(standardise_register(raw_register(spark, sf_dir)), "register")
    return register, known_companies(spark, sf_dir)


@query(
    f"""
    WITH {REGISTER_SQL}
    SELECT "ID_EMPRESA", empresa_proc || ' s.l.' AS empresa, empresa_proc, nif, valid_nif, CASE WHEN valid_nif THEN 'DNI' END AS nif_type, "UTE",
           empresa_proc || '|' || empresa_proc || ' s.l.' AS used
    FROM register
    """
)
def q_register_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    register = standardise_register(raw_register(spark, sf_dir))
    return register.select(
        "ID_EMPRESA", "empresa", "empresa_proc", "nif", "valid_nif", "nif_type", "UTE", F.array_join("UsedNames", "|").alias("used")
    )


@query(
    f"""
    WITH {REGISTER_SQL}
    SELECT "ID_EMPRESA", r.nif, "NameProposed", "isPYME", "UTE" FROM register r JOIN known_companies k ON k.nif = r.nif
    """
)
def q_link_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    register, firms = _inputs(spark, sf_dir)
    joined = link_by_id(register.select("ID_EMPRESA", "nif", "UTE"), firms.drop("UsedNames"))
    return joined.select("ID_EMPRESA", "nif", "NameProposed", "isPYME", "UTE")


@query(f'WITH {FOUND_SQL} SELECT "ID_EMPRESA", attribute, value FROM id_values')
def q_found_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found_by_id(*_inputs(spark, sf_dir))


@query(f'WITH {FOUND_SQL} SELECT "ID_EMPRESA", attribute, value FROM alias_values')
def q_link_by_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    register, firms = _inputs(spark, sf_dir)
    matched = register.join(firms.select("nif"), "nif", "left_semi").select("ID_EMPRESA")
    return found_by_alias(register.join(matched, "ID_EMPRESA", "left_anti"), firms)


@query(f'WITH {FOUND_SQL} SELECT "ID_EMPRESA", attribute, value, tier FROM all_values')
def q_register_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_register(*_inputs(spark, sf_dir)).values


@query(
    f"""
    WITH {FOUND_SQL}
    SELECT DISTINCT "ID_EMPRESA", attribute, value FROM all_values
    """
)
def q_collect_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_sets(link_register(*_inputs(spark, sf_dir)).values)


@query(
    f"""
    WITH {FOUND_SQL},
    sizes AS (SELECT "ID_EMPRESA", attribute, count(DISTINCT value) AS n, min(value) AS value FROM all_values WHERE attribute <> 'UsedNames' GROUP BY 1, 2)
    SELECT "ID_EMPRESA", max(n) <= 1 AS consistent,
           CASE WHEN max(n) <= 1 THEN max(CASE WHEN attribute = 'nif' THEN value END) END AS nif,
           CASE WHEN max(n) <= 1 THEN max(CASE WHEN attribute = 'company' THEN value END) END AS company,
           CASE WHEN max(n) <= 1 THEN max(CASE WHEN attribute = 'NameProposed' THEN value END) END AS "NameProposed",
           CASE WHEN max(n) <= 1 THEN max(CASE WHEN attribute = 'isPYME' THEN value END) END AS "isPYME",
           CASE WHEN max(n) <= 1 THEN max(CASE WHEN attribute = 'UTE' THEN value END) END AS "UTE"
    FROM sizes GROUP BY "ID_EMPRESA"
    """
)
def q_register_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consistency(link_register(*_inputs(spark, sf_dir)).values)


@query(
    f"""
    WITH {FOUND_SQL}
    SELECT "ID_EMPRESA", nif FROM register WHERE "ID_EMPRESA" NOT IN (SELECT "ID_EMPRESA" FROM all_values)
    """
)
def q_register_not_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_register(*_inputs(spark, sf_dir)).not_found.select("ID_EMPRESA", "nif")


@query(
    f"""
    WITH {FOUND_SQL}
    SELECT CASE WHEN "ID_EMPRESA" IN (SELECT "ID_EMPRESA" FROM all_values) THEN 'found' ELSE 'not_found' END AS outcome, count(*) AS n_rows,
           count(*) FILTER (nif IS NULL) AS null_ids, count(*) FILTER (coalesce(valid_nif, false)) AS valid_ids,
           count(*) FILTER (NOT coalesce(valid_nif, false)) AS invalid_ids, CAST(0 AS BIGINT) AS correctable_ids
    FROM register GROUP BY 1
    """
)
def q_match_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    register, firms = _inputs(spark, sf_dir)
    return match_quality(register, link_register(register, firms).found)


@query(
    f"""
    SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN {dni_text_sql("c_custkey")}
      ELSE array_to_string(list_sort([{dni_text_sql("c_custkey")}, {dni_text_sql("c_custkey + 7")}]), '|') END AS ids FROM customer
    """
)
def q_merge_valid_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    other = F.when(key % 2 == 0, F.when(key % 4 == 0, dni_text(key)).otherwise(F.lit("x99"))).otherwise(dni_text(key + 7))
    pairs = table(spark, sf_dir, "customer").select("c_custkey", dni_text(key).alias("x"), F.upper(other).alias("y"))
    return pairs.select("c_custkey", F.array_join(merged_valid_ids(F.col("x"), F.col("y")), "|").alias("ids"))


@query(
    """
    WITH facts AS (
      SELECT o_custkey AS c, list_distinct(list(o_orderstatus)) AS statuses,
             list_distinct(list(CASE WHEN o_orderkey % 5 > 0 THEN o_orderpriority[:1] END)) AS priorities FROM orders GROUP BY o_custkey)
    SELECT c, CASE WHEN len(statuses) <= 1 AND len(priorities) <= 1 THEN statuses[1] END AS status,
           CASE WHEN len(statuses) <= 1 AND len(priorities) <= 1 THEN priorities[1] END AS priority, len(statuses) <= 1 AND len(priorities) <= 1 AS consistent
    FROM facts
    """
)
def q_consistency_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of at most three statuses and five priorities per customer."""
    known = F.when(F.col("o_orderkey") % 5 > 0, F.substring("o_orderpriority", 1, 1))
    facts = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c")).agg(
        F.collect_set("o_orderstatus").alias("status"), F.collect_set(known).alias("priority")
    )
    fits, others = split_consistent(facts, ["status", "priority"])
    missing = F.lit(None).cast("string")
    return fits.withColumn("consistent", F.lit(True)).unionByName(
        others.select("c", missing.alias("status"), missing.alias("priority"), F.lit(False).alias("consistent"))
    )


SNAPSHOT_SQL = """
recent AS (SELECT o_custkey AS "NIF", count(*) AS n FROM orders WHERE o_orderdate >= DATE '1997-06-01' GROUP BY 1),
earlier AS (SELECT o_custkey AS "NIF", count(*) AS n FROM orders WHERE o_orderdate < DATE '1997-06-01' GROUP BY 1)
"""


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    count = F.count(F.lit(1)).alias("n")
    recent = orders.filter(day >= F.to_timestamp(F.lit("1997-06-01"))).groupBy(F.col("o_custkey").alias("NIF")).agg(count)
    earlier = orders.filter(day < F.to_timestamp(F.lit("1997-06-01"))).groupBy(F.col("o_custkey").alias("NIF")).agg(count)
    return recent, earlier


@query(
    f"""
    WITH {SNAPSHOT_SQL}
    SELECT coalesce(r."NIF", e."NIF") AS "NIF", r.n, e.n AS n_old, CASE WHEN e."NIF" IS NULL THEN 'left_only' WHEN r."NIF" IS NULL THEN 'right_only' ELSE 'both' END AS "_merge"
    FROM recent r FULL JOIN earlier e ON r."NIF" = e."NIF"
    """
)
def q_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_diff(*_snapshots(spark, sf_dir), "NIF")


@query(f'WITH {SNAPSHOT_SQL} SELECT * FROM recent WHERE "NIF" NOT IN (SELECT "NIF" FROM earlier)')
def q_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_rows(*_snapshots(spark, sf_dir), "NIF")


@query(
    """
    SELECT count(*) FILTER (lang = 'xx' OR n_chars < 500) AS lang, count(*) FILTER (source = 'src0') AS source,
           count(*) FILTER (doc_id % 3 = 0) AS doc_id FROM documents
    """
)
def q_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    holes = docs.select(
        F.when(F.col("n_chars") >= 500, F.col("lang")).alias("lang"),
        F.when(F.col("source") != "src0", F.col("source")).alias("source"),
        F.when(F.col("doc_id") % 3 != 0, F.col("doc_id")).alias("doc_id"),
    )
    return null_profile(holes)


NAMED_SQL = "SELECT p_partkey, CASE WHEN p_size > 5 THEN p_name || ' ' || p_type || ' ' || p_size END AS name FROM part"


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("p_size") > 5, F.concat_ws(" ", "p_name", "p_type", F.col("p_size").cast("string")))
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))


@query(f"WITH n AS ({NAMED_SQL}) SELECT * FROM n WHERE name IN (SELECT name FROM n GROUP BY name HAVING count(*) > 1)")
def q_duplicate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_report(_sized(spark, sf_dir), "name")


@query(
    f"""
    WITH n AS ({NAMED_SQL}), d AS (SELECT count(*) AS c FROM n WHERE name IN (SELECT name FROM n GROUP BY name HAVING count(*) > 1))
    SELECT c AS duplicated, (SELECT count(*) FROM n) AS total, round(c / (SELECT count(*) FROM n) * 100, 9) AS share_pct FROM d
    """
)
def q_duplicate_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_share(_sized(spark, sf_dir), "name").withColumn("share_pct", F.round("share_pct", 9))


@query("SELECT p_name, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name")
def q_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return value_counts(lines.join(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey"), "p_name")


@query("SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_keys, count(*) = count(DISTINCT l_orderkey) AS is_unique FROM lineitem")
def q_key_is_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_is_unique(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query(
    """
    SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS) OVER (
      PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM events
    """
)
def q_forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank values take the last sign-up value before them."""
    known = F.when(F.col("event_type") == "signup", F.col("value"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id", known.alias("value"))
    return forward_fill(events, "user_id", "event_id", "value").select("event_id", "user_id", "value")


# --- register files --------------------------------------------------------------------

# What a file calls the columns, and how lines go wrong by customer key.
FILE_NAMES = {"Id. empresa": "ID_EMPRESA", "N.I.F.": "NIF", "Razón social": "NOMBRE", "¿UTE?": "UTE"}
SCAN_SQL = f"""
cells AS (
  SELECT c_custkey AS c, 'Firma ' || c_custkey || ', S.L.' AS "NOMBRE",
         CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN lpad(CAST(c_custkey AS VARCHAR), 8, '0') ELSE upper({dni_text_sql("c_custkey")}) END AS "NIF",
         CASE c_custkey % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'N' END AS "UTE"
  FROM customer),
judged AS (
  SELECT format, cells.*, CASE WHEN format = 'csv' AND c % 11 IN (4, 7) THEN '{MALFORMED}' WHEN c % 11 = 9 THEN '{BAD_ID}' WHEN c % 11 = 10 THEN '{NO_ID}' END AS reason
  FROM cells, (VALUES ('csv'), ('parquet')) AS f(format))
"""


def _register_files(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The register as a CSV folder with broken lines and as Parquet; in both some IDs are wrong."""
    c = F.col("ID_EMPRESA")
    wrong = F.when(c % 11 == 9, F.concat(F.lit("x"), c.cast("string"))).when(c % 11 != 10, c.cast("string"))
    cells = raw_register(spark, sf_dir).select(c.alias("key"), wrong.alias("Id. empresa"), F.col("NIF").alias("N.I.F."), F.col("NOMBRE").alias("Razón social"), F.col("UTE").alias("¿UTE?"))
    paths = {kind: f"{checkpoint_root(spark)}/register-{uuid.uuid4().hex}" for kind in ("csv", "parquet")}
    cells.drop("key").withColumn("remarks", F.lit("none")).write.parquet(paths["parquet"])
    line = F.concat_ws(";", *[F.coalesce(F.col(f"`{name}`"), F.lit("")) for name in FILE_NAMES])
    k = F.col("key")
    lines = cells.select(F.when(k % 11 == 4, F.concat(line, F.lit(";more"))).when(k % 11 == 7, F.substring_index(line, ";", 2)).otherwise(line).alias(";".join(FILE_NAMES)))
    # one cell for each line, written as it is
    lines.write.option("header", True).option("sep", "\x01").option("quote", "").option("emptyValue", "").csv(paths["csv"])
    return paths


@query(
    f"""
    WITH {SCAN_SQL}
    SELECT format, c AS "ID_EMPRESA", "NIF", "NOMBRE", "UTE", CAST(NULL AS VARCHAR) AS reason, CAST(1 AS BIGINT) AS n FROM judged WHERE reason IS NULL
    UNION ALL SELECT format, NULL, NULL, NULL, NULL, reason, count(*) FROM judged WHERE reason IS NOT NULL GROUP BY format, reason
    """
)
def q_register_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read from both kinds of files, and how many were set aside for what."""
    found = []
    for kind, path in _register_files(spark, sf_dir).items():
        scan = scan_register(spark, path, kind, FILE_NAMES)
        own = F.lit(kind).alias("format")
        found.append(scan.rows.select(own, "*", F.lit(1).cast("long").alias("n")))
        found.append(scan.reasons().select(own, "reason", "n"))
    return union_all(found)
