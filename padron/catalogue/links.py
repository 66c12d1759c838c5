"""Consortium splitting, linking, members and link quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.catalogue.fixtures import COMPANIES_SQL, CONSORTIA_SQL, alike_sql, companies, consortia, table
from padron.catalogue.registry import query
from padron.functions.text import fold_accents, strip_boilerplate
from padron.operators.linkage import (
    assemble_stops,
    containment_join,
    distinctive_tokens,
    exclude_names,
    fuzzy_join,
    invert_edges,
    keep_names,
    token_overlap_join,
    words_of,
)
from padron.operators.quality import (
    coverage,
    evaluate_links,
    frequency_stoplist,
    link_examples,
    merged_counts,
    stops_of,
    token_counts,
    truth_links,
)
from padron.operators.splits import dictionary_hits, marker_table, split_consortium
from padron.plans.linking import company_links, consortium_members, link_by_split, link_by_tokens
from padron.sources.staging import stage

# --- splitting -------------------------------------------------------------------------

# The members as each way of writing a consortium leaves them.
PIECES_SQL = f"""
{CONSORTIA_SQL},
pieces AS (
  SELECT DISTINCT "FullName", unnest(CASE o % 6 WHEN 0 THEN [a, b] WHEN 1 THEN [a || ' s.l.', b || ' s.a.'] WHEN 2 THEN [a, b] WHEN 3 THEN [a, b]
    WHEN 4 THEN [a || ' s.l.u.', b || ' s.l.'] ELSE [a, b] END) AS piece, unnest([1, 2]) AS place
  FROM consortia)
"""


def _companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies known by their bare names, as the last way of writing a consortium needs."""
    return companies(spark, sf_dir).withColumn("FullName", F.col("Name"))


@query(
    f"""
    WITH {PIECES_SQL}
    SELECT "FullName", string_agg(piece, '|' ORDER BY piece) AS pieces FROM pieces GROUP BY "FullName"
    """
)
def q_split_consortium(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = split_consortium(consortia(spark, sf_dir), "FullName", _companies(spark, sf_dir))
    return split.select("FullName", F.array_join(F.array_sort("pieces"), "|").alias("pieces"))


# Every company has a legal form of its own, which no written list knows.
OWN_FORMS_SQL = f"""
{CONSORTIA_SQL},
formed AS (SELECT DISTINCT a.k AS ka, b.k AS kb FROM partners JOIN companies a ON a.k = lo JOIN companies b ON b.k = hi)
"""


@query(
    f"""
    WITH {OWN_FORMS_SQL}
    SELECT a."Name" || ' q' || ka || '. ' || b."Name" || ' q' || kb || '. u.t.e.' AS "FullName",
           a."Name" || ' q' || ka || '.|' || b."Name" || ' q' || kb || '.' AS pieces
    FROM formed JOIN companies a ON a.k = ka JOIN companies b ON b.k = kb
    """
)
def q_split_by_company_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consortia cut at the legal forms of the company table, as many forms as companies."""
    firms = companies(spark, sf_dir).withColumn("CompanyType", F.concat(F.lit("Q"), F.col("k").cast("string"), F.lit(".")))
    form = lambda name: F.concat(name, F.lit(" q"), F.substring_index(name, " grupo", -1), F.lit("."))
    both = F.concat_ws(" ", form(F.col("a")), form(F.col("b")), F.lit("u.t.e."))
    joint = consortia(spark, sf_dir).select(both.alias("FullName"))
    split = split_consortium(joint, "FullName", markers=marker_table(firms))
    return split.select("FullName", F.array_join("pieces", "|").alias("pieces"))


# Hits in all six ways of writing a consortium; a name with a comma at its end is no word n-gram.
HITS_SQL = f"""
    WITH {CONSORTIA_SQL},
    texts AS (SELECT DISTINCT o, trim(replace(replace("FullName", ' ley 18/1982 de 26 de mayo', ''), 'u.t.e.', ' ')) AS t FROM consortia),
    w AS (SELECT o, list_filter(string_split(t, ' '), lambda x: x <> '') AS ws FROM texts),
    spans AS (SELECT o, ws, i, unnest(range(i, len(ws) + 1)) AS j FROM (SELECT o, ws, unnest(range(1, len(ws) + 1)) AS i FROM w))
    SELECT o, array_to_string(ws[i:j], ' ') AS gram FROM spans WHERE array_to_string(ws[i:j], ' ') IN (SELECT "Name" FROM companies)
"""


@query(HITS_SQL)
def q_ngram_dictionary_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = consortia(spark, sf_dir).select("o", strip_boilerplate(F.col("FullName")).alias("text"))
    return dictionary_hits(texts, "text", companies(spark, sf_dir), "Name").select("o", "gram")


@query(HITS_SQL)
def q_ngram_dictionary_join_all_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name under which the whole table was read before ``q_ngram_dictionary_join`` did."""
    return q_ngram_dictionary_join(spark, sf_dir)


# --- joins between names ---------------------------------------------------------------

ANTI_SQL = """
  SELECT p_partkey, p_name || ' ' || p_brand AS name FROM part
  WHERE p_name || ' ' || p_brand {} (SELECT p_name || ' ' || p_brand FROM part JOIN lineitem ON l_partkey = p_partkey WHERE l_quantity > 49)
"""


def _named_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    name = F.concat_ws(" ", "p_name", "p_brand")
    parts = table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))
    big = table(spark, sf_dir, "lineitem").filter("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return parts, parts.join(big, "p_partkey", "left_semi")


@query(ANTI_SQL.format("NOT IN"))
def q_anti_join_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exclude_names(*_named_parts(spark, sf_dir), "name")


@query(ANTI_SQL.format("IN"))
def q_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_names(*_named_parts(spark, sf_dir), "name")


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def q_id_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey").subtract(pending)


FOLDED_SQL = f"""
{CONSORTIA_SQL},
joint AS (SELECT DISTINCT "FullName" AS consortium FROM consortia),
names AS (SELECT "Name" AS company FROM companies)
"""


@query(
    f"""
    WITH {FOLDED_SQL}
    SELECT company, consortium FROM names JOIN joint ON contains(consortium, company)
    WHERE regexp_matches(consortium, '\\b' || regexp_escape(company) || '\\b')
    """
)
def q_phrase_containment_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = companies(spark, sf_dir).withColumnRenamed("Name", "company")
    joint = consortia(spark, sf_dir).withColumnRenamed("FullName", "consortium")
    return containment_join(names, "company", joint, "consortium")


# Words of the part names are in every other company's name; the stop list learns that
# from the counts.
STOPS_SQL = """
token_counts AS (
  SELECT term, count(*) AS n FROM (SELECT unnest(string_split("Name", ' ')) AS term FROM companies) WHERE length(term) > 3 GROUP BY term),
stops AS (SELECT term FROM token_counts WHERE n > (SELECT quantile_cont(n, 0.95) FROM token_counts) UNION SELECT 'widget')
"""


def _stops(names: DataFrame) -> DataFrame:
    tokens = distinctive_tokens(names, "company", None)
    return stage(frequency_stoplist(tokens, manual=["widget"]), "stops")


@query(f"WITH {COMPANIES_SQL}, {STOPS_SQL} SELECT term FROM stops")
def q_stoplist_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stops(companies(spark, sf_dir).withColumnRenamed("Name", "company"))


@query(f"WITH {COMPANIES_SQL}, {STOPS_SQL} SELECT term FROM stops")
def q_stoplist_from_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of three runs over different companies, each stored; the stop list of all."""
    state = None
    for run in range(3):
        part = companies(spark, sf_dir).filter(F.col("k") % 3 == run).withColumnRenamed("Name", "company")
        counts = token_counts(distinctive_tokens(part, "company", None))
        state = stage(counts if state is None else merged_counts(state, counts), f"run{run}")
    return stops_of(state, manual=["widget"])


TOKENS_SQL = f"""
{FOLDED_SQL}, {STOPS_SQL},
company_tokens AS (
  SELECT company, token FROM (SELECT company, unnest(string_split(company, ' ')) AS token FROM names)
  WHERE length(token) > 3 AND token NOT IN (SELECT term FROM stops)),
joint_tokens AS (
  SELECT DISTINCT consortium, unnest(regexp_split_to_array(lower(consortium), '[.,!?;:\\s()-]')) AS token FROM joint)
"""


@query(f"WITH {COMPANIES_SQL}, names AS (SELECT \"Name\" AS company FROM companies), {STOPS_SQL} SELECT company, token FROM (SELECT company, unnest(string_split(company, ' ')) AS token FROM names) WHERE length(token) > 3 AND token NOT IN (SELECT term FROM stops)")
def q_distinctive_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = companies(spark, sf_dir).withColumnRenamed("Name", "company")
    return distinctive_tokens(names, "company", _stops(names))


@query(f"WITH {TOKENS_SQL} SELECT DISTINCT company, consortium FROM company_tokens JOIN joint_tokens USING (token)")
def q_token_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = companies(spark, sf_dir).withColumnRenamed("Name", "company")
    joint = consortia(spark, sf_dir).withColumnRenamed("FullName", "consortium")
    tokens = stage(distinctive_tokens(names, "company", _stops(names)), "tokens")
    return token_overlap_join(tokens, "company", joint, "consortium")


LINKS_SQL = f"""
{TOKENS_SQL},
links AS (
  SELECT company, consortium FROM company_tokens JOIN joint_tokens USING (token)
  UNION SELECT company, consortium FROM names JOIN joint ON contains(consortium, company)
        WHERE regexp_matches(consortium, '\\b' || regexp_escape(company) || '\\b'))
"""


def _token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    firms = _companies(spark, sf_dir)
    stops = _stops(firms.withColumnRenamed("Name", "company"))
    return link_by_tokens(firms, consortia(spark, sf_dir), stops)


@query(f"WITH {LINKS_SQL} SELECT company, consortium FROM links")
def q_link_consortia(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _token_links(spark, sf_dir)


@query(
    f"""
    WITH {LINKS_SQL}
    SELECT "NIF", "FullName", company AS member FROM consortia LEFT JOIN links ON consortium = "FullName"
    """
)
def q_consortium_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    joint = consortia(spark, sf_dir).select("NIF", "FullName")
    links = stage(_token_links(spark, sf_dir), "links")
    return consortium_members(links, _companies(spark, sf_dir), joint)


@query(f"WITH {LINKS_SQL} SELECT company, consortium FROM links")
def q_company_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return company_links(_token_links(spark, sf_dir))


# --- fuzzy -----------------------------------------------------------------------------

# Names with a fault: one letter doubled, dropped or changed, by part key.
FAULTS_SQL = """
faulty AS (
  SELECT DISTINCT CASE p_partkey % 4 WHEN 0 THEN left(nm, 5) || substr(nm, 5) WHEN 1 THEN left(nm, 4) || substr(nm, 6)
                           WHEN 2 THEN left(nm, 6) || 'x' || substr(nm, 8) ELSE nm END AS piece
  FROM (SELECT p_partkey, p_name || ' compania grupo' || p_partkey AS nm FROM part)),
firms AS (SELECT p_name || ' compania grupo' || p_partkey AS company FROM part)
"""


def _firms(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key, F.concat("p_name", F.lit(" compania grupo"), key.cast("string")).alias("company")
    )


def _faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, kind = F.col("company"), F.col("p_partkey") % 4
    piece = (
        F.when(kind == 0, F.concat(F.substring(c, 1, 5), F.substr(c, F.lit(5))))
        .when(kind == 1, F.concat(F.substring(c, 1, 4), F.substr(c, F.lit(6))))
        .when(kind == 2, F.concat(F.substring(c, 1, 6), F.lit("x"), F.substr(c, F.lit(8))))
        .otherwise(c)
    )
    return _firms(spark, sf_dir).select(piece.alias("piece"))


@query(
    f"""
    WITH {FAULTS_SQL}, l AS (SELECT company AS a FROM firms), r AS (SELECT piece AS b FROM faulty)
    SELECT a AS company, b AS piece, ratio FROM ({alike_sql("l", "r")})
    """
)
def q_fuzzy_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_join(_firms(spark, sf_dir), "company", _faulty(spark, sf_dir), "piece")


SPLIT_LINKS_SQL = f"""
    WITH {PIECES_SQL}, l AS (SELECT "Name" AS a FROM companies), r AS (SELECT DISTINCT piece AS b FROM pieces),
    alike AS ({alike_sql("l", "r")})
    SELECT a AS company, "FullName" AS consortium, count(*) AS n_splits FROM alike JOIN pieces ON piece = b GROUP BY 1, 2
"""


@query(SPLIT_LINKS_SQL)
def q_link_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_by_split(_companies(spark, sf_dir), consortia(spark, sf_dir))


# --- edges, truth and quality ----------------------------------------------------------

TRUTH_SQL = f"""
{CONSORTIA_SQL},
truth AS (SELECT DISTINCT "FullName" AS consortium, unnest([a, b]) AS company FROM consortia)
"""


def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = F.explode(F.array("a", "b"))
    return consortia(spark, sf_dir).select(F.col("FullName").alias("consortium"), both.alias("company")).distinct()


def _methods(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    by_split = link_by_split(_companies(spark, sf_dir), consortia(spark, sf_dir))
    return {"split": by_split, "tokens": _token_links(spark, sf_dir), "truth": _truth(spark, sf_dir)}


@query(f"WITH {TRUTH_SQL} SELECT company, consortium FROM truth")
def q_truth_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truth_links(_truth(spark, sf_dir), "company", "consortium")


@query(
    f"""
    WITH {CONSORTIA_SQL}
    SELECT DISTINCT "FullName" AS consortium, unnest([a, b]) AS member FROM consortia
    """
)
def q_invert_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of two members for each consortium become one row for each of them."""
    lists = consortia(spark, sf_dir).select("FullName", F.array("a", "b").alias("members"))
    return invert_edges(lists, "FullName", "members", "member").withColumnRenamed("FullName", "consortium")


@query(
    f"""
    WITH {LINKS_SQL}, truth AS (SELECT DISTINCT "FullName" AS consortium, unnest([a, b]) AS company FROM consortia),
    totals AS (SELECT count(*) AS n FROM consortia)
    SELECT 'tokens' AS method, count(DISTINCT consortium) AS linked, any_value(n) AS consortia, round(count(DISTINCT consortium) * 100.0 / any_value(n), 6) AS coverage_pct FROM links, totals
    UNION ALL SELECT 'split', count(DISTINCT consortium), any_value(n), round(count(DISTINCT consortium) * 100.0 / any_value(n), 6) FROM ({SPLIT_LINKS_SQL}) AS s, totals
    UNION ALL SELECT 'truth', count(DISTINCT consortium), any_value(n), round(count(DISTINCT consortium) * 100.0 / any_value(n), 6) FROM truth, totals
    """
)
def q_link_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    joint = consortia(spark, sf_dir)
    return coverage(_methods(spark, sf_dir), "consortium", joint).withColumn("coverage_pct", F.round("coverage_pct", 6))


@query(
    f"""
    WITH {TRUTH_SQL}
    SELECT 'truth' AS method, company, consortium FROM truth
    WHERE company IN (SELECT DISTINCT company FROM truth ORDER BY company LIMIT 10)
    UNION ALL SELECT 'split', company, consortium FROM ({SPLIT_LINKS_SQL}) AS s
    WHERE company IN (SELECT DISTINCT company FROM ({SPLIT_LINKS_SQL}) AS s ORDER BY company LIMIT 10)
    UNION ALL SELECT 'tokens', company, consortium FROM (WITH {LINKS_SQL} SELECT * FROM links) AS t
    WHERE company IN (SELECT DISTINCT company FROM (WITH {LINKS_SQL} SELECT * FROM links) AS t ORDER BY company LIMIT 10)
    """
)
def q_link_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_examples(_methods(spark, sf_dir), "company", "consortium", 10)


@query(
    f"""
    WITH {LINKS_SQL}, truth AS (SELECT DISTINCT "FullName" AS consortium, unnest([a, b]) AS company FROM consortia),
    c AS (SELECT (SELECT count(*) FROM links JOIN truth USING (company, consortium)) AS hits, (SELECT count(*) FROM links) AS found,
                 (SELECT count(*) FROM truth) AS labelled)
    SELECT hits, found, labelled, round(hits / found, 9) AS "precision", round(hits / labelled, 9) AS recall FROM c
    """
)
def q_link_precision_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = evaluate_links(_token_links(spark, sf_dir), _truth(spark, sf_dir), "company", "consortium")
    return scored.withColumns({"precision": F.round("precision", 9), "recall": F.round("recall", 9)})


@query(
    """
    SELECT DISTINCT translate(lower(term), 'áéíóúÁÉÍÓÚòÒ', 'aeiouAEIOUoO') AS term FROM (
      SELECT unnest(string_split(text, ' ')) AS term FROM documents
      UNION ALL SELECT unnest(string_split(p_name, ' ')) FROM part)
    """
)
def q_distinct_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = words_of(table(spark, sf_dir, "documents"), "text")
    names = words_of(table(spark, sf_dir, "part"), "p_name")
    folded = fold_accents(F.lower("term")).alias("term")
    return texts.unionByName(names).select(folded).distinct()


@query(
    f"""
    WITH {COMPANIES_SQL}, {STOPS_SQL}
    SELECT DISTINCT term FROM (
      SELECT lower(unnest(string_split(p_name, ' '))) AS term FROM part
      UNION ALL SELECT lower(unnest(string_split(c_name, ' '))) FROM customer
      UNION ALL SELECT lower(r_name) FROM region UNION ALL SELECT lower(n_name) FROM nation
      UNION ALL SELECT lower(term) FROM stops)
    """
)
def q_assemble_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two name lists, two word lists and the frequency list in one table."""
    names = [(table(spark, sf_dir, "part"), "p_name"), (table(spark, sf_dir, "customer"), "c_name")]
    words = [table(spark, sf_dir, t).select(F.col(c).alias("term")) for t, c in (("region", "r_name"), ("nation", "n_name"))]
    return assemble_stops(names, words, _stops(companies(spark, sf_dir).withColumnRenamed("Name", "company")))
