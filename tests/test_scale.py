"""One key with very many items gives the same kind of rows as a key with three."""

from pyspark.sql import functions as F

from padron.catalogue import fixtures
from padron.operators.linkage import distinctive_tokens
from padron.operators.quality import forward_fill, sample_rows
from padron.operators.resolve import mention_items, regroup_items
from padron.operators.splits import company_markers, split_consortium
from padron.plans.chain import register_companies
from padron.plans.company_table import CompanyTables, tender_rows
from padron.plans.register import found_by_id, link_register, standardise_register
from padron.sources.staging import checkpoint_root, drop_staged, stage


def test_items_of_a_hot_key_keep_their_order(spark):
    n = 300_000
    rows = spark.range(n).select(
        F.when(F.col("id") < 3, "small").otherwise("hot").alias("ID"), F.lit("x").alias("Name_norm"), F.col("id").alias("ord"), (F.col("id") * 7 % n).alias("item")
    )
    out = regroup_items(mention_items(rows, "item"), ["ID"], "item", ["Name_norm", "ord"])
    assert out.columns == ["ID", "Name_norm", "ord", "item"]
    assert out.filter("item <> ord * 7 % 300000").count() == 0
    assert {r.ID: r["count"] for r in out.groupBy("ID").count().collect()} == {"small": 3, "hot": n - 3}


def test_tenders_of_a_hot_company(spark):
    n = 50_000
    mentions = spark.range(n).select(
        F.when(F.col("id") < 3, "b1").otherwise("b2").alias("ID"), F.lit("acme").alias("Name"), F.concat(F.lit("t "), F.col("id").cast("string")).alias("id_tender"), F.col("id").alias("ord")
    )
    assigned = spark.createDataFrame([("b1", "acme", "g1", "b1", "acme"), ("b2", "acme", "g2", "b2", "acme")], "raw_id string, raw_name string, golden_id string, ID string, Name_norm string")
    counted = {r.NIF: r["count"] for r in tender_rows(mentions, assigned).groupBy("NIF").count().collect()}
    assert counted == {"g1": 3, "g2": n - 3}


def test_names_survive_a_company_without_names(spark):
    register = spark.createDataFrame([(1, "b1", ["acme"], True)], "ID_EMPRESA int, nif string, UsedNames array<string>, UTE boolean")
    firms = spark.createDataFrame([("b1", None, "Acme", True)], "nif string, UsedNames array<string>, NameProposed string, isPYME boolean")
    names = found_by_id(register, firms).filter("attribute = 'UsedNames'").collect()
    assert [r.value for r in names] == ["acme"]


def test_sample_does_not_depend_on_partitions(spark):
    rows = spark.range(10_000).select("id", (F.col("id") % 7).alias("x"))
    one, other = sample_rows(rows, ["id", "x"], 0.1), sample_rows(rows.repartition(13), ["id", "x"], 0.1)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))
    assert 850 < one.count() < 1150


def test_staged_tables_can_be_dropped(spark):
    held = stage(spark.range(3).toDF("x"), "kept")
    assert held.count() == 3 and checkpoint_root(spark) in held.inputFiles()[0].replace("file:///", "/").replace("file:", "")
    context = spark.sparkContext
    before = context.getCheckpointDir()
    context.setCheckpointDir(f"{before}/own")
    stage(spark.range(3), "dropped")
    folder = checkpoint_root(spark)
    drop_staged(spark)
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(context._jsc.hadoopConfiguration()).exists(path)
    context.setCheckpointDir(before)


def test_legal_forms_come_from_the_data(spark):
    firms = spark.createDataFrame([("acme", "kft."), ("bravo", "s.a."), ("zulu", None), ("ute", "u.t.e.")], "FullName string, CompanyType string")
    joint = spark.createDataFrame([("acme kft. bravo s.a.",)], "FullName string")
    assert "kft." in company_markers(firms) and "u.t.e." not in company_markers(firms)
    pieces = split_consortium(joint, "FullName", markers=company_markers(firms)).first().pieces
    assert pieces == ["acme kft.", "bravo s.a."]
    forms = spark.createDataFrame([("gmbhx",)], "CompanyType string")
    names = spark.createDataFrame([("norte gmbhx",)], "company string")
    assert [r.token for r in distinctive_tokens(names, "company", None, forms).collect()] == ["norte"]


def test_register_reads_the_company_table(spark):
    companies = spark.createDataFrame([("12345678z", "acme", True)], "NIF string, Name string, isPYME boolean")
    used = spark.createDataFrame([("12345678z", "acme"), ("12345678z", "acme s.l.")], "NIF string, used_name string")
    firms = register_companies(CompanyTables(companies, companies.limit(0), companies.limit(0), used))
    raw = spark.createDataFrame([(1, "12345678-Z", "Other", "N"), (2, None, "ACME, S.L.", "N"), (3, None, "None", "N")], "ID_EMPRESA int, NIF string, NOMBRE string, UTE string")
    links = link_register(standardise_register(raw), firms)
    names = {(r.ID_EMPRESA, r.value) for r in links.values.filter("attribute = 'company'").collect()}
    assert names == {(1, "12345678z"), (2, "12345678z")}
    assert [r.ID_EMPRESA for r in links.not_found.collect()] == [3]


def filled(rows):
    """The same row by row: rows are (group, order, label)."""
    out, last = [], {}
    for g, o, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0)):
        last[g] = x if x is not None else last.get(g)
        out.append((g, o, last[g]))
    return out


def test_fill_of_a_hot_group_with_a_sparse_order(spark):
    """Nanoseconds as order, nine tenths in one group, long gaps without a label."""
    start = 1_700_000_000_000_000_000
    rows = [("hot" if i % 10 else f"g{i % 70}", start + i * 7_919_000_003, f"v{i}" if i % 977 == 3 or i % 70 == 20 else None) for i in range(20_000)]
    rows += [(None, 5, None), (None, 6, "n"), (None, 7, None), ("hot", None, "first"), ("zz", None, None), ("a", None, "early"), ("a", 1, None)]
    df = spark.createDataFrame(rows, "grp string, at long, _part string").repartition(16)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = forward_fill(df, "grp", "at", "_part").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sorted(map(tuple, got), key=repr) == sorted(filled(rows), key=repr)


def test_a_hot_group_is_dealt_to_all_ranges(spark):
    df = spark.range(100_000).select(F.lit("hot").alias("g"), (F.col("id") * 1_000_000_007).alias("o"), F.when(F.col("id") == 0, "x").alias("label"))
    out = forward_fill(df, "g", "o", "label")
    assert out.filter("label = 'x'").count() == 100_000
    sizes = [r["count"] for r in df.repartitionByRange("g", "o").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]


def test_fill_of_nothing(spark):
    assert forward_fill(spark.createDataFrame([], "g string, o long, x string, y int"), "g", "o", "x").columns == ["g", "o", "x", "y"]
    assert forward_fill(spark.createDataFrame([], "g string, o long, x string"), "g", "o", "x").count() == 0


def test_a_small_file_of_many_customers_is_several_tasks(spark, tmp_path):
    """One file is one task when it is read; what the register is made of it is not."""
    n = 2 * fixtures.ROWS_PER_TASK + 1
    rows = spark.range(0, n, 1, 1).select(F.col("id").alias("c_custkey"), F.lit("BUILDING").alias("c_mktsegment"))
    rows.write.parquet(f"{tmp_path}/customer.parquet")
    for df in (fixtures.raw_register(spark, str(tmp_path)), fixtures.known_companies(spark, str(tmp_path))):
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == n and max(sizes) <= fixtures.ROWS_PER_TASK
