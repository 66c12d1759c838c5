"""Entity-resolution inputs derived row by row from the test tables.

Each fixture has the same definition twice: a DataFrame here and a SQL text, so a
query's counterpart can start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.sources.lookups import ENTITY_LETTERS, PROVINCE_CODES


#: Rows of a table in one task, where its file is too small to be read in several.
ROWS_PER_TASK = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """The rows of a narrow table in as many tasks as their number asks for: names of a few bytes become rows of many."""
    return df.repartition(df.count() // ROWS_PER_TASK + 1)


# --- (ID, name) associations -----------------------------------------------------------
# Groups of ten parts: 0-2 share an ID under three names, 3-5 share a name under three
# IDs, 6 repeats the name of 0, the others are unambiguous.

PART_PAIRS_SQL = """
part_pairs AS (
  SELECT p.p_partkey AS k,
         CAST(CASE WHEN p.p_partkey % 10 < 3 THEN p.p_partkey - p.p_partkey % 10 ELSE p.p_partkey END AS BIGINT) AS n,
         CASE WHEN p.p_partkey % 10 < 3 THEN p.p_name || ' ' || (p.p_partkey % 10)
              WHEN p.p_partkey % 10 < 6 THEN 'shared ' || (p.p_partkey // 10)
              WHEN p.p_partkey % 10 = 6 THEN z.p_name || ' 0'
              ELSE p.p_name || ' ' || p.p_partkey END AS core
  FROM part p LEFT JOIN part z ON z.p_partkey = p.p_partkey - 6)
"""


def part_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), "p_name")
    part = dealt(named)
    earlier = named.select((F.col("k") + 6).alias("k"), F.col("p_name").alias("earlier"))
    m = F.col("k") % 10
    core = (
        F.when(m < 3, F.concat("p_name", F.lit(" "), m.cast("string")))
        .when(m < 6, F.concat(F.lit("shared "), F.expr("k div 10").cast("string")))
        .when(m == 6, F.concat("earlier", F.lit(" 0")))
        .otherwise(F.concat("p_name", F.lit(" "), F.col("k").cast("string")))
    )
    return part.join(earlier, "k", "left").select(
        "k", F.when(m < 3, F.col("k") - m).otherwise(F.col("k")).alias("n"), core.alias("core")
    )


MENTIONS_SQL = (
    PART_PAIRS_SQL
    + """,
mentions AS (
  SELECT CAST(n AS VARCHAR) AS "ID", core AS "Name_norm", l_orderkey * 10 + l_linenumber AS ord,
         l_orderkey, l_returnflag, l_linenumber, k
  FROM lineitem JOIN part_pairs ON l_partkey = k)
"""
)


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ID, Name_norm, ord and some line columns: one row per line item."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return lines.join(part_pairs(spark, sf_dir), F.col("l_partkey") == F.col("k")).select(
        F.col("n").cast("string").alias("ID"),
        F.col("core").alias("Name_norm"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"),
        "l_orderkey",
        "l_returnflag",
        "l_linenumber",
        "k",
    )


# --- tax IDs ---------------------------------------------------------------------------

DNI_LETTERS = "trwagmyfpdxbnjzsqvhlcke"


def cif_digits(n: Column) -> Column:
    """Seven digits with every two-digit province in turn, one number each."""
    return F.concat(F.lpad((n % 100).cast("string"), 2, "0"), F.lpad(F.floor(n / 100).cast("string"), 5, "0"))


def cif_digits_sql(n: str) -> str:
    return f"(lpad(CAST(({n}) % 100 AS VARCHAR), 2, '0') || lpad(CAST(({n}) // 100 AS VARCHAR), 5, '0'))"


def control_number(digits: Column) -> Column:
    d = [F.substring(digits, i, 1).cast("int") for i in range(1, 8)]
    twice = sum((F.floor(d[i] * 2 / 10) + d[i] * 2 % 10 for i in (2, 4, 6)), F.floor(d[0] * 2 / 10) + d[0] * 2 % 10)
    return ((10 - (d[1] + d[3] + d[5] + twice) % 10) % 10).cast("int")


def control_number_sql(digits: str) -> str:
    d = [f"CAST(substr({digits}, {i}, 1) AS INTEGER)" for i in range(1, 8)]
    twice = " + ".join(f"({d[i]} * 2) // 10 + ({d[i]} * 2) % 10" for i in (0, 2, 4, 6))
    return f"((10 - ({d[1]} + {d[3]} + {d[5]} + {twice}) % 10) % 10)"


def cif_text(letter: Column, n: Column) -> Column:
    """A CIF with a control that is right wherever a digit (or, for province 00, a letter) is right."""
    digits = cif_digits(n)
    number = control_number(digits)
    control = F.when(n % 100 == 0, F.substr(F.lit("jabcdefghi"), number + 1, F.lit(1))).otherwise(number.cast("string"))
    return F.concat(letter, digits, control)


def cif_text_sql(letter: str, n: str) -> str:
    digits = cif_digits_sql(n)
    number = control_number_sql(digits)
    return (
        f"({letter} || {digits} || CASE WHEN ({n}) % 100 = 0 THEN substr('jabcdefghi', {number} + 1, 1) "
        f"ELSE CAST({number} AS VARCHAR) END)"
    )


def dni_text(n: Column) -> Column:
    return F.concat(
        F.lpad((n + 1).cast("string"), 8, "0"), F.substr(F.lit(DNI_LETTERS), ((n + 1) % 23 + 1).cast("int"), F.lit(1))
    )


def dni_text_sql(n: str) -> str:
    return f"(lpad(CAST({n} + 1 AS VARCHAR), 8, '0') || substr('{DNI_LETTERS}', CAST(({n} + 1) % 23 + 1 AS INTEGER), 1))"


# --- full mentions ---------------------------------------------------------------------
# Raw spellings of the associations above: dirty names, formatted tax IDs, votes.

FULL_MENTIONS_SQL = (
    PART_PAIRS_SQL
    + f""",
known AS (
  SELECT k, n, core, CASE WHEN n % 3 = 1 THEN {dni_text_sql("n")}
                          WHEN n % 3 = 2 THEN {cif_text_sql("'u'", "n")}
                          ELSE {cif_text_sql("'b'", "n")} END AS nif,
         CASE WHEN n % 3 = 1 THEN 'DNI' WHEN n % 100 IN (69, 89) OR n = 0 THEN NULL ELSE 'CIF' END AS kind
  FROM part_pairs),
marked_mentions AS (
  SELECT nif AS "ID", kind, core AS "Name_proc",
         CASE WHEN l_linenumber % 4 = 0 THEN core
              WHEN n % 3 = 2 THEN core || ' u.t.e.' ELSE core || ' s.l.' END AS "Name",
         replace(core, ' ', '') AS "Name_norm",
         't' || l_orderkey AS id_tender, l_returnflag = 'A' AS flag,
         CASE WHEN l_linenumber % 3 > 0 THEN 'city ' || (k % 7) END AS city,
         lpad(CAST(k % 50 AS VARCHAR), 5, '0') || CASE WHEN k % 3 = 0 THEN '.0' ELSE '' END AS zone,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, n
  FROM lineitem JOIN known ON l_partkey = k),
full_mentions AS (SELECT * FROM marked_mentions WHERE kind IS NOT NULL),
all_mentions AS (SELECT * REPLACE (CASE WHEN kind IS NOT NULL THEN "ID" END AS "ID") FROM marked_mentions)
"""
)


def province_sql(code: str) -> str:
    """The province of a two-digit code."""
    whens = " ".join(f"WHEN {code} IN ({', '.join(repr(c.strip()) for c in codes.split(','))}) THEN '{name}'" for codes, name in PROVINCE_CODES)
    return f"CASE {whens} END"


def entity_sql(letter: str) -> str:
    """The description of an entity letter."""
    whens = " ".join(f"WHEN '{row[0].lower()}' THEN '{row[1]}'" for row in ENTITY_LETTERS)
    return f"CASE {letter} {whens} END"


def raw_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ID, Name, id_tender, SMEAwardedIndicator, CityName, PostalZone and ord, as a tender table would spell them."""
    n, k, line = F.col("n"), F.col("k"), F.col("l_linenumber")
    nif = F.when(n % 3 == 1, dni_text(n)).when(n % 3 == 2, cif_text(F.lit("u"), n)).otherwise(cif_text(F.lit("b"), n))
    known = part_pairs(spark, sf_dir).select("k", "n", "core", nif.alias("nif"))
    spelt = known.select(
        "k",
        "n",
        F.initcap("core").alias("core"),
        F.upper("nif").alias("plain"),
        F.concat(F.substring("nif", 1, 1), F.lit("-"), F.substring("nif", 2, 8)).alias("dashed"),
    )
    company_form = (
        F.when(line % 4 == 1, F.lit(", Sociedad Limitada")).when(line % 4 == 2, F.lit(" S. L.")).when(line % 4 == 3, F.lit(" SL"))
    )
    joint_form = (
        F.when(line % 4 == 1, F.lit(" U.T.E."))
        .when(line % 4 == 2, F.lit(" Union Temporal de Empresas"))
        .when(line % 4 == 3, F.lit(" ute"))
    )
    form = F.coalesce(F.when(n % 3 == 2, joint_form).otherwise(company_form), F.lit(""))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"
    )
    return lines.join(spelt, F.col("l_partkey") == k).select(
        F.when(line % 2 == 0, F.col("plain")).otherwise(F.col("dashed")).alias("ID"),
        F.concat("core", form).alias("Name"),
        F.concat(F.lit("t"), F.col("l_orderkey").cast("string")).alias("id_tender"),
        F.when(F.col("l_returnflag") == "A", F.lit(True))
        .when(F.col("l_returnflag") == "R", F.lit(False))
        .alias("SMEAwardedIndicator"),
        F.when(line % 3 > 0, F.concat(F.lit("city "), (k % 7).cast("string"))).alias("CityName"),
        F.concat(F.lpad((k % 50).cast("string"), 5, "0"), F.when(k % 3 == 0, F.lit(".0")).otherwise(F.lit(""))).alias("PostalZone"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("ord"),
    )


# --- tender tables with list cells -----------------------------------------------------
# One tender per order, with one to three winners; some cells are list texts, some are
# arrays, some are missing, some lists are one short.

TENDERS_SQL = """
tenders AS (
  SELECT o_orderkey AS o, o_custkey AS c, 1 + o_orderkey % 3 AS n, o_orderpriority,
         o_orderkey % 7 = 0 AS no_id, o_orderkey % 11 = 0 AS short, o_orderkey % 4 = 0 AS no_flag,
         o_orderkey % 5 = 0 AS no_city
  FROM orders),
winners AS (
  SELECT o, c, n, no_id, short, no_flag, no_city, unnest(range(n)) AS i FROM tenders)
"""


def _quoted(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(items, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))


def raw_tenders(spark: SparkSession, sf_dir: str, valid_ids: bool = False) -> DataFrame:
    """Nested tender table: level columns, ``id`` and the winning party's fields."""
    orders = table(spark, sf_dir, "orders")
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    n = (o % 3 + 1).cast("int")
    at = F.sequence(F.lit(0), n - 1)
    ids = F.transform(at, lambda i: F.concat(F.lit("B"), F.lpad((c + i).cast("string"), 8, "0")))
    if valid_ids:
        ids = F.transform(at, lambda i: cif_text(F.lit("B"), c + i))
    names = F.transform(at, lambda i: F.concat(F.lit(" Empresa "), (c + i).cast("string"), F.lit(" ")))
    flags = F.transform(at, lambda i: F.when(i % 2 == 0, F.lit("True")).otherwise(F.lit("False")))
    cities = F.transform(at, lambda i: F.concat(F.lit("City "), ((c + i) % 9).cast("string")))
    id_cell = F.when(o % 7 == 0, F.lit("nan")).when(n == 1, F.get(ids, 0)).otherwise(_quoted(ids))
    name_cell = F.when(o % 11 == 0, F.slice(names, F.lit(1), n - 1)).otherwise(names)
    flag_cell = F.when(o % 4 == 0, F.lit(None)).when(n == 1, F.get(flags, 0)).otherwise(
        F.concat(F.lit("["), F.array_join(flags, ", "), F.lit("]"))
    )
    city_cell = F.when(o % 5 == 0, F.transform(at, lambda i: F.lit(None).cast("string"))).otherwise(cities)
    party = F.struct(id_cell.alias("ID"), name_cell.alias("Name"), city_cell.alias("CityName"))
    result = F.struct(party.alias("WinningParty"), flag_cell.alias("SMEAwardedIndicator"), F.col("o_totalprice").alias("Amount"))
    return orders.select(
        F.col("o_orderpriority").alias("level"),
        o.alias("entry"),
        F.concat(F.lit(" T"), o.cast("string"), F.lit(" ")).alias("id"),
        F.struct(result.alias("TenderResult")).alias("ContractFolderStatus"),
    )


PARTY = ["ID", "Name", "CityName", "SMEAwardedIndicator"]


# --- companies and consortia -----------------------------------------------------------
# A company per part. A consortium per order, named after the companies of its lowest
# and highest part key, written in one of six ways.

COMPANIES_SQL = """
companies AS (
  SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS "NIF", p_name || ' grupo' || p_partkey AS "Name" FROM part)
"""
CONSORTIA_SQL = (
    COMPANIES_SQL
    + """,
partners AS (
  SELECT l_orderkey AS o, min(l_partkey) AS lo, max(l_partkey) AS hi FROM lineitem GROUP BY l_orderkey),
consortia AS (
  SELECT o, a."Name" AS a, b."Name" AS b, 'U' || o AS "NIF",
         CASE o % 6 WHEN 0 THEN a."Name" || ' - ' || b."Name" || ' u.t.e.'
                    WHEN 1 THEN a."Name" || ' s.l. ' || b."Name" || ' s.a.'
                    WHEN 2 THEN a."Name" || ' y ' || b."Name"
                    WHEN 3 THEN 'u.t.e. ' || a."Name" || ', ' || b."Name" || ' ley 18/1982 de 26 de mayo'
                    WHEN 4 THEN a."Name" || ',s.l.u. - ' || b."Name" || ' s.l.'
                    ELSE a."Name" || ' ' || b."Name" END AS "FullName"
  FROM partners JOIN companies a ON a.k = lo JOIN companies b ON b.k = hi)
"""
)


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    name = F.concat("p_name", F.lit(" grupo"), F.col("p_partkey").cast("string"))
    return part.select(F.col("p_partkey").alias("k"), F.col("p_partkey").cast("string").alias("NIF"), name.alias("Name"))


def consortia(spark: SparkSession, sf_dir: str) -> DataFrame:
    """o, NIF, FullName and the two members' names ``a`` and ``b``."""
    lines = table(spark, sf_dir, "lineitem")
    partners = lines.groupBy(F.col("l_orderkey").alias("o")).agg(F.min("l_partkey").alias("lo"), F.max("l_partkey").alias("hi"))
    named = companies(spark, sf_dir)
    low = named.select(F.col("k").alias("lo"), F.col("Name").alias("a"))
    high = named.select(F.col("k").alias("hi"), F.col("Name").alias("b"))
    a, b = F.col("a"), F.col("b")
    kind = F.col("o") % 6
    full = (
        F.when(kind == 0, F.concat(a, F.lit(" - "), b, F.lit(" u.t.e.")))
        .when(kind == 1, F.concat(a, F.lit(" s.l. "), b, F.lit(" s.a.")))
        .when(kind == 2, F.concat(a, F.lit(" y "), b))
        .when(kind == 3, F.concat(F.lit("u.t.e. "), a, F.lit(", "), b, F.lit(" ley 18/1982 de 26 de mayo")))
        .when(kind == 4, F.concat(a, F.lit(",s.l.u. - "), b, F.lit(" s.l.")))
        .otherwise(F.concat(a, F.lit(" "), b))
    )
    return partners.join(low, "lo").join(high, "hi").select(
        "o", F.concat(F.lit("U"), F.col("o").cast("string")).alias("NIF"), full.alias("FullName"), "a", "b"
    )


# --- city register ---------------------------------------------------------------------
# The register lists every customer; companies know two of every three by ID, and a
# further share only by name. Company 3 of each ten also answers to customer 4's name.

REGISTER_SQL = f"""
register AS (
  SELECT c_custkey AS "ID_EMPRESA", 'firma ' || c_custkey AS empresa_proc, c_custkey AS c,
         CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN lpad(CAST(c_custkey AS VARCHAR), 8, '0')
              ELSE {dni_text_sql("c_custkey")} END AS nif,
         CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey % 5 <> 1 END AS valid_nif,
         CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS "UTE"
  FROM customer),
known_companies AS (
  SELECT c_custkey AS c, {dni_text_sql("c_custkey")} AS nif, 'firma ' || c_custkey AS "NameProposed",
         c_custkey % 2 = 0 AS "isPYME"
  FROM customer WHERE c_mktsegment <> 'MACHINERY'),
company_aliases AS (
  SELECT c, nif, "NameProposed", "isPYME", "NameProposed" AS alias FROM known_companies
  UNION ALL SELECT c, nif, "NameProposed", "isPYME", "NameProposed" || ' s.l.' FROM known_companies
  UNION ALL SELECT c, nif, "NameProposed", "isPYME", 'firma ' || (c + 1) FROM known_companies WHERE c % 10 = 3),
register_aliases AS (
  SELECT "ID_EMPRESA", nif, valid_nif, "UTE", empresa_proc AS alias FROM register
  UNION ALL SELECT "ID_EMPRESA", nif, valid_nif, "UTE", empresa_proc || ' s.l.' FROM register)
"""


def raw_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    nif = F.when(c % 5 == 1, F.lpad(c.cast("string"), 8, "0")).when(c % 5 > 1, F.upper(dni_text(c)))
    return dealt(table(spark, sf_dir, "customer").select("c_custkey")).select(
        c.alias("ID_EMPRESA"),
        nif.alias("NIF"),
        F.concat(F.lit("Firma "), c.cast("string"), F.lit(", S.L.")).alias("NOMBRE"),
        F.when(c % 3 == 0, F.lit("S")).when(c % 3 == 1, F.lit("N")).alias("UTE"),
    )


def known_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    name = F.concat(F.lit("firma "), c.cast("string"))
    next_name = F.when(c % 10 == 3, F.concat(F.lit("firma "), (c + 1).cast("string")))
    return (
        dealt(table(spark, sf_dir, "customer").filter("c_mktsegment <> 'MACHINERY'").select("c_custkey"))
        .select(
            dni_text(c).alias("nif"),
            F.array_compact(F.array(name, F.concat(name, F.lit(" s.l.")), next_name)).alias("UsedNames"),
            name.alias("NameProposed"),
            (c % 2 == 0).alias("isPYME"),
        )
    )


# --- similarity ------------------------------------------------------------------------


def lcs_sql(a: str, b: str) -> str:
    """Longest common subsequence, row by row: the last row's last cell."""
    cells = f"""list_reduce(
      list_prepend([CAST(0 AS BIGINT)], list_transform(range(1, length({b}) + 1), lambda j: [CAST(j AS BIGINT)])),
      lambda acc, jj: list_append(acc, CASE WHEN substr({a}, CAST(cur[1] AS BIGINT), 1) = substr({b}, CAST(jj[1] AS BIGINT), 1)
                                       THEN prev[jj[1]] + 1 ELSE greatest(prev[jj[1] + 1], acc[jj[1]]) END))"""
    rows = f"""list_reduce(
      list_prepend(list_transform(range(length({b}) + 1), lambda z: 0),
                   list_transform(range(1, length({a}) + 1), lambda i: [CAST(i AS BIGINT)])),
      lambda prev, cur: {cells})"""
    return f"({rows})[length({b}) + 1]"


def ratio_sql(a: str, b: str) -> str:
    return f"CAST(round_even(200.0 * {lcs_sql(a, b)} / (length({a}) + length({b})), 0) AS INTEGER)"


def alike_sql(left: str, right: str) -> str:
    """Pairs (a, b) of two one-column tables whose ratio exceeds 95, all pairs compared."""
    return f"""
      SELECT * FROM (
        SELECT a, b, {ratio_sql("a", "b")} AS ratio FROM (
          SELECT a, b FROM {left} JOIN {right} ON abs(length(a) - length(b)) <= 9 * (length(a) + length(b)) // 200
          WHERE levenshtein(a, b) <= 9 * (length(a) + length(b)) // 200)) WHERE ratio > 95"""
