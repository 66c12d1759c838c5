from padron.catalogue.fixtures import ROWS_PER_TASK, part_pairs
from padron.plans import company_table
from padron.plans.company_table import associations, company_tables

SCHEMA = "id_tender string, ID string, Name string, SMEAwardedIndicator boolean, CityName string, PostalZone string, ord int"
ACME = "B28000008"


def spellings():
    ids = [ACME, ACME.lower(), "b-28000008", "B 28000008", "B.28000008"]
    names = ["Acme SL", "ACME, S.L.", "acme s. l.", "Acme Sociedad Limitada", "acme", "Acme, SL"]
    return [(f"t{n}", i, name, True, "madrid", "1", n) for n, (i, name) in enumerate((i, name) for i in ids for name in names)]


def test_spellings_are_summed_before_golden_ids(spark, monkeypatch):
    sizes, stage = {}, company_table.stage

    def counted(df, label):
        kept = stage(df, label)
        sizes[label] = kept.count()
        return kept

    monkeypatch.setattr(company_table, "stage", counted)
    tables = company_tables(spark.createDataFrame(spellings(), SCHEMA))
    (row,) = tables.companies.collect()
    assert (row.NIF, row.FullName, row.Name, row.n_mentions, row.City) == (ACME.lower(), "acme s.l.", "acme", 30, "madrid")
    assert tables.tenders.count() == 30 and tables.used_names.count() == 2
    assert sizes.pop("associations") == 30
    assert set(sizes.values()) == {1}


def test_names_of_one_key_tie_by_their_first_place(spark):
    data = [
        ("t1", ACME, "Sol Mar SL", True, None, None, 5),
        ("t2", ACME.lower(), "SolMar, S.L.", True, "x", None, 2),
        ("t3", "b-28000008", "SOL MAR", False, "x", "7.0", None),
        ("t4", ACME, "Solmar", True, None, "7.0", 9),
    ]
    (row,) = company_tables(spark.createDataFrame(data, SCHEMA).repartition(3)).companies.collect()
    # a place that is not known comes first
    assert (row.Name, row.FullName, row.isPYME, row.City, row.PostalCode) == ("sol mar", "sol mar s.l.", False, "x", "7")
    (row,) = company_tables(spark.createDataFrame([r for r in data if r[6]][:2], SCHEMA)).companies.collect()
    assert (row.Name, row.FullName) == ("solmar", "sol mar s.l.")


def test_cleaning_has_more_tasks_than_cores(spark):
    pairs = associations(spark.createDataFrame(spellings(), SCHEMA))
    assert pairs.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism


def test_cleaning_has_more_tasks_where_the_grouping_has_as_many(spark):
    was, n = spark.conf.get("spark.sql.shuffle.partitions"), company_table.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", n)
    try:
        assert associations(spark.createDataFrame(spellings(), SCHEMA)).rdd.getNumPartitions() == n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_a_small_file_of_many_parts_is_several_tasks(spark, tmp_path):
    n = 2 * ROWS_PER_TASK + 10
    spark.range(n).selectExpr("id AS p_partkey", "'bolt' AS p_name").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    pairs = part_pairs(spark, str(tmp_path))
    assert pairs.rdd.getNumPartitions() == 3
    assert pairs.count() == n
