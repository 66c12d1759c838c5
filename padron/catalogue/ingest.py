"""Sources, sinks and list cells."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.catalogue.fixtures import PARTY, TENDERS_SQL, raw_tenders, table
from padron.catalogue.registry import query
from padron.functions.cells import fill_missing, flag_from_letter, parse_text_cell, tidy_items
from padron.functions.text import leading_segment
from padron.operators.mentions import (
    decode_flag,
    filter_aligned,
    filter_keyed,
    pad_lists,
    tender_mentions,
)
from padron.operators.quality import sample_rows
from padron.sources.lookups import expand_codes
from padron.sources.staging import checkpoint_root
from padron.sources.tables import (
    composite_key,
    flatten_columns,
    is_party_column,
    read_lookup,
    read_sources,
    read_words,
    select_columns,
    tender_lists,
    write_table,
    write_terms,
)

ID_TEXT = "lower('b' || lpad(CAST(c + i AS VARCHAR), 8, '0'))"
WINNER_COLUMNS = f"""
  'T' || o AS id_tender, CAST(i AS INTEGER) AS pos, {ID_TEXT} AS "ID", 'empresa ' || (c + i) AS "Name",
  CASE WHEN NOT no_city THEN 'city ' || ((c + i) % 9) END AS "CityName"
"""


def _scratch(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def _lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tender_lists(raw_tenders(spark, sf_dir), ["level", "entry"])


def _text(*columns: str):
    """Arrays as text, so both engines print them alike; a null item is shown as ~."""
    return [F.array_join(c, "|", "~").alias(c) for c in columns]


@query(
    """
    SELECT 'part' AS source, p_partkey AS "key", p_name AS name, p_retailprice AS amount, CAST(NULL AS INTEGER) AS nation FROM part
    UNION ALL SELECT 'customer', c_custkey, c_name, c_acctbal, c_nationkey FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL, s_nationkey FROM supplier
    """
)
def q_union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = {name: f"{sf_dir}/{name}.parquet" for name in ("part", "customer", "supplier")}
    both = read_sources(spark, paths)
    return both.select(
        "source",
        F.coalesce("p_partkey", "c_custkey", "s_suppkey").alias("key"),
        F.coalesce("p_name", "c_name", "s_name").alias("name"),
        F.coalesce("p_retailprice", "c_acctbal").alias("amount"),
        F.coalesce("c_nationkey", "s_nationkey").alias("nation"),
    )


@query(
    """
    SELECT o_orderpriority AS "level", o_orderkey AS entry, o_totalprice AS "ContractFolderStatus.TenderResult.Amount",
           o_orderkey % 4 = 0 AS no_flag
    FROM orders
    """
)
def q_flatten_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_columns(raw_tenders(spark, sf_dir))
    below = "ContractFolderStatus.TenderResult."
    return flat.select(
        "level",
        "entry",
        F.col(f"`{below}Amount`").alias(f"{below}Amount"),
        F.col(f"`{below}SMEAwardedIndicator`").isNull().alias("no_flag"),
    )


@query(
    """
    SELECT ' T' || o_orderkey || ' ' AS tender, 1 + o_orderkey % 3 - CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS n_names,
           o_orderkey % 7 = 0 AS no_id
    FROM orders
    """
)
def q_select_by_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    party = select_columns(flatten_columns(raw_tenders(spark, sf_dir)), is_party_column, {"id": "id_tender"})
    return party.select(F.col("id_tender").alias("tender"), F.size("Name").cast("long").alias("n_names"), (F.col("ID") == "nan").alias("no_id"))


@query("SELECT o_orderkey AS entry, o_orderpriority || '/' || o_orderkey || '/nan' AS identifier FROM orders")
def q_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_tenders(spark, sf_dir)
    missing = F.lit(None).cast("string")
    return raw.select("entry", composite_key([F.col("level"), F.col("entry"), missing]).alias("identifier"))


@query(
    """
    SELECT lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') AS code, count(*) AS n, min(c_name) AS first_name
    FROM customer GROUP BY 1
    """
)
def q_lookup_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0").alias("code")
    path = _scratch(spark, "lookup")
    table(spark, sf_dir, "customer").select(code, "c_name").write.option("sep", ";").option("header", True).csv(path)
    return read_lookup(spark, path, ["code", "c_name"]).groupBy("code").agg(
        F.count(F.lit(1)).alias("n"), F.min("c_name").alias("first_name")
    )


@query(
    """
    SELECT term, count(*) AS n FROM (
      SELECT unnest(string_split(replace(replace(text, chr(10), ' '), chr(13), ' '), ' ')) AS term FROM documents)
    WHERE term <> '' GROUP BY term
    """
)
def q_wordlist_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "[ \n\r]")).alias("term"))
    path = _scratch(spark, "words")
    docs.filter("term <> ''").select(F.concat("term", F.lit("  ")).alias("value")).write.text(path)
    return read_words(spark, path).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def q_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "roundtrip")
    write_table(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), path)
    return spark.read.parquet(path)


@query("SELECT DISTINCT lower(c_mktsegment) || ' ' || (c_custkey % 50) AS term FROM customer")
def q_terms_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    term = F.concat(F.lower("c_mktsegment"), F.lit(" "), (F.col("c_custkey") % 50).cast("string"))
    path = _scratch(spark, "terms")
    write_terms(table(spark, sf_dir, "customer").select(term.alias("term")).distinct(), path)
    return read_words(spark, path)


@query(
    """
    SELECT o_orderkey AS entry, CASE WHEN o_orderkey % 5 = 0 THEN '~' ELSE array_to_string(
      list_transform(range(1 + o_orderkey % 3), lambda i: 'City ' || ((o_custkey + i) % 9)), '|') END AS cities
    FROM orders
    """
)
def q_fill_missing_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    cities = F.col("ContractFolderStatus.TenderResult.WinningParty.CityName")
    return raw_tenders(spark, sf_dir).select("entry", F.array_join(fill_missing(cities), "|", "~").alias("cities"))


@query(
    """
    SELECT o_orderkey AS entry, CASE WHEN o_orderkey % 7 = 0 THEN '~' ELSE array_to_string(
      list_transform(range(1 + o_orderkey % 3), lambda i: 'B' || lpad(CAST(o_custkey + i AS VARCHAR), 8, '0')), '|') END AS ids,
      CASE WHEN o_orderkey % 4 = 0 THEN '~' WHEN o_orderkey % 3 = 0 THEN 'True' WHEN o_orderkey % 3 = 1 THEN 'true|false'
           ELSE 'true|false|true' END AS flags
    FROM orders
    """
)
def q_parse_list_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = F.col("ContractFolderStatus.TenderResult")
    return raw_tenders(spark, sf_dir).select(
        "entry",
        F.array_join(parse_text_cell(result["WinningParty"]["ID"]), "|", "~").alias("ids"),
        F.array_join(parse_text_cell(result["SMEAwardedIndicator"]), "|", "~").alias("flags"),
    )


@query(
    """
    SELECT o_orderkey AS entry, CASE WHEN o_orderkey % 11 = 0 AND o_orderkey % 3 = 0 THEN '~' ELSE array_to_string(list_transform(
      range(1 + o_orderkey % 3 - CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END), lambda i: 'empresa ' || (o_custkey + i)), '|') END AS names
    FROM orders
    """
)
def q_list_trim_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.col("ContractFolderStatus.TenderResult.WinningParty.Name")
    return raw_tenders(spark, sf_dir).select("entry", F.array_join(tidy_items(names), "|", "~").alias("names"))


@query(
    """
    SELECT o_orderpriority || '/' || o_orderkey AS identifier, 'T' || o_orderkey AS id_tender FROM orders
    WHERE o_orderkey % 7 <> 0 AND NOT (o_orderkey % 11 = 0 AND o_orderkey % 3 = 0)
    """
)
def q_filter_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_keyed(_lists(spark, sf_dir)).select("identifier", F.get("id_tender", 0).alias("id_tender"))


@query(
    """
    SELECT 'T' || o_orderkey AS id_tender, CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 1 + o_orderkey % 3 END AS n FROM orders
    WHERE o_orderkey % 11 <> 0
       OR (o_orderkey % 3 = 0) <> (o_orderkey % 7 = 0 AND o_orderkey % 4 = 0 AND o_orderkey % 5 = 0)
    """
)
def q_filter_aligned_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown lists do not count: a tender of which only one list is known is aligned."""
    return filter_aligned(_lists(spark, sf_dir), PARTY).select(
        F.get("id_tender", 0).alias("id_tender"), F.size("ID").cast("long").alias("n")
    )


@query(
    """
    SELECT 'T' || o_orderkey AS id_tender, CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 7 <> 0 THEN rtrim(repeat('~|', 1 + o_orderkey % 3), '|')
           WHEN o_orderkey % 4 = 0 THEN '~' WHEN o_orderkey % 3 = 0 THEN 'true' WHEN o_orderkey % 3 = 1 THEN 'true|false'
           ELSE 'true|false|true' END AS flags
    FROM orders
    """
)
def q_pad_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = pad_lists(_lists(spark, sf_dir), ["SMEAwardedIndicator"])
    return padded.select(
        F.get("id_tender", 0).alias("id_tender"), F.array_join("SMEAwardedIndicator", "|", "~").alias("flags")
    )


@query(
    f"""
    WITH {TENDERS_SQL}
    SELECT {WINNER_COLUMNS}, CASE WHEN NOT no_flag THEN i % 2 = 0 END AS "SMEAwardedIndicator"
    FROM winners WHERE NOT no_id AND NOT short
    """
)
def q_explode_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    mentions = tender_mentions(_lists(spark, sf_dir), PARTY)
    return decode_flag(mentions).select("id_tender", "pos", "ID", "Name", "CityName", "SMEAwardedIndicator")


@query(
    f"""
    WITH {TENDERS_SQL}
    SELECT {WINNER_COLUMNS} FROM winners WHERE NOT no_id AND NOT short AND n = 1
    """
)
def q_explode_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the tender id counted as a list, only tenders with one winner are left."""
    mentions = tender_mentions(_lists(spark, sf_dir), PARTY, strict=True)
    return mentions.select("id_tender", "pos", "ID", "Name", "CityName")


@query(
    """
    SELECT doc_id, count(*) AS n_tokens, count(DISTINCT token) AS n_distinct FROM (
      SELECT doc_id, unnest(string_split(text, ' ')) AS token FROM documents) GROUP BY doc_id
    """
)
def q_explode_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = table(spark, sf_dir, "documents").select("doc_id", F.explode_outer(F.split("text", " ")).alias("token"))
    return split.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_tokens"), F.count_distinct("token").alias("n_distinct")
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE l_returnflag WHEN 'A' THEN true WHEN 'R' THEN false END AS flag, CASE WHEN l_linestatus = 'O' THEN NULL ELSE false END AS sme
    FROM lineitem
    """
)
def q_flag_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    text = F.when(F.col("l_linestatus") == "O", F.lit("")).otherwise(F.lit("false"))
    decoded = decode_flag(lines.withColumn("SMEAwardedIndicator", text))
    return decoded.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        flag_from_letter(F.col("l_returnflag"), "A", "R").alias("flag"),
        F.col("SMEAwardedIndicator").alias("sme"),
    )


@query(
    """
    SELECT c_custkey, starts_with(c_name, 'Customer#00000000') AS early, contains(c_mktsegment, 'MACH') AS machines,
           regexp_matches(c_name, '7$') AS ends_in_7, c_nationkey IS NOT NULL AS has_nation
    FROM customer
    """
)
def q_string_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("c_name")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        name.startswith("Customer#00000000").alias("early"),
        F.col("c_mktsegment").contains("MACH").alias("machines"),
        name.rlike("7$").alias("ends_in_7"),
        F.col("c_nationkey").isNotNull().alias("has_nation"),
    )


@query("SELECT p_partkey, unnest([p_brand, p_type, CAST(p_size AS VARCHAR)]) AS code FROM part")
def q_lookup_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.concat_ws(",", "p_brand", "p_type", F.col("p_size").cast("string"))
    return expand_codes(table(spark, sf_dir, "part").select("p_partkey", codes.alias("codes")), "codes", "code")


@query("SELECT l_orderkey, l_linenumber, l_partkey, split_part(CAST(l_extendedprice AS VARCHAR), '.', 1) AS units FROM lineitem")
def q_leading_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", leading_segment(price, ".").alias("units")
    )


@query("SELECT event_id, user_id, value FROM events WHERE value IS NOT NULL AND event_type <> 'error'")
def q_dropna(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.when(F.col("event_type") != "error", F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", "user_id", known.alias("value")).dropna()


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE left(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey)), 8) < '19999999'
    """
)
def q_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the lines, the same ones at every run."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    return sample_rows(table(spark, sf_dir, "lineitem").select(*keys), keys, 0.1)
