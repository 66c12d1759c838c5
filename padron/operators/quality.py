"""Reports on keys, values and links."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from padron.frames import key_counts, union_all
from padron.sources.staging import stage

# Terms always added to the frequency stop list.
MANUAL_STOPS = [
    "UTE", "ute", "u.t.e.", "servicio", "servicios", "obras",
    "fundación", "información", "técnica", "proyectos", "y",
    "engineering", "architecture", "technology", "solutions", "infraestructuras", "inst", "contrucciones",
    "construccions", "office", "spain", "associacio", "formacio", "arquitectes", "gestio", "information",
    "international", "systems", "system", "excavacions", "facility", "partners", "consulting", "catalunya",
    "constr", "projects", "intelligence", "educatio", "systems", "electrodomesticos", "marketing",
    "extremadura", "networks", "estacionamientos", "management", "gipuzkoa", "coslada", "security", "project",
    "design", "studio", "security", "service", "avda", "serv", "trans", "quality", "group", "services",
    "asturias", "manteniments", "investment", "quality", "cantabria", "medioambientales", "sist", "energy",
    "rehabilitaciones", "bizkaia", "research", "enginyeria", "electronics", "solucions", "facilities",
    "music", "technologies", "portugalete",
]


def token_counts(tokens: DataFrame, token: str = "token") -> DataFrame:
    """``term, n``: the state of a stop list, which further runs can be added to (``merged_counts``)."""
    return tokens.groupBy(F.col(token).alias("term")).agg(F.count(F.lit(1)).alias("n"))


def merged_counts(*states: DataFrame) -> DataFrame:
    """The state of all tokens of several runs; in any order and grouping the same."""
    return union_all([s.select("term", "n") for s in states]).groupBy("term").agg(F.sum("n").alias("n"))


def stops_of(counts: DataFrame, percentile: float = 0.95, manual: Sequence[str] = MANUAL_STOPS) -> DataFrame:
    """Distinct ``term`` of a state: tokens counted above the percentile of all counts, and the manual terms.

    The percentile is exact. It comes from the histogram of the counts: few distinct
    counts, whatever the number of tokens.
    """
    spark = counts.sparkSession
    histogram = counts.groupBy("n").agg(F.count(F.lit(1)).alias("terms"))
    limit = histogram.agg(F.percentile("n", F.lit(percentile), F.col("terms"))).first()[0]
    frequent = counts.filter(F.col("n") > F.lit(limit)).select("term")
    given = spark.createDataFrame([(t,) for t in manual], "term string") if manual else None
    return (frequent if given is None else frequent.unionByName(given)).distinct()


def frequency_stoplist(
    tokens: DataFrame, token: str = "token", percentile: float = 0.95, manual: Sequence[str] = MANUAL_STOPS
) -> DataFrame:
    """``stops_of`` one run's tokens."""
    return stops_of(token_counts(tokens, token), percentile, manual)


def coverage(edges: Mapping[str, DataFrame], consortium: str, all_consortia: DataFrame) -> DataFrame:
    """Per method: distinct linked consortia, consortium rows, and their ratio in percent."""
    linked = union_all(
        [
            df.select(consortium).distinct().agg(F.count(consortium).alias("linked")).withColumn("method", F.lit(m))
            for m, df in edges.items()
        ]
    )
    total = all_consortia.count()
    return linked.select(
        "method",
        "linked",
        F.lit(total).cast("long").alias("consortia"),
        F.try_divide(F.col("linked") * 100.0, F.lit(total)).alias("coverage_pct"),
    )


def link_examples(edges: Mapping[str, DataFrame], company: str, consortium: str, n: int = 10) -> DataFrame:
    """First ``n`` companies by name per method with their consortia, one row for each link."""
    shown = []
    for method, df in edges.items():
        first = df.select(company).distinct().orderBy(company).limit(n)
        own = df.join(F.broadcast(first), company).select(company, consortium).distinct()
        shown.append(own.withColumn("method", F.lit(method)))
    return union_all(shown)


def evaluate_links(found: DataFrame, truth: DataFrame, company: str, consortium: str) -> DataFrame:
    """Precision and recall of links against labelled pairs, among the labelled consortia only."""
    keys = [company, consortium]
    labelled = truth.select(*keys).dropna().distinct()
    candidates = keep_labelled(found.select(*keys).distinct(), labelled, consortium)
    marked = candidates.withColumn("_f", F.lit(1)).join(labelled.withColumn("_t", F.lit(1)), keys, "full")
    return marked.agg(
        F.count(F.when(F.col("_f").isNotNull() & F.col("_t").isNotNull(), 1)).alias("hits"),
        F.count("_f").alias("found"),
        F.count("_t").alias("labelled"),
    ).withColumns(
        {
            "precision": F.try_divide(F.col("hits"), F.col("found")),
            "recall": F.try_divide(F.col("hits"), F.col("labelled")),
        }
    )


def keep_labelled(found: DataFrame, labelled: DataFrame, consortium: str) -> DataFrame:
    return found.join(labelled.select(consortium).distinct(), consortium, "left_semi")


def truth_links(pairs: DataFrame, company: str, consortium: str) -> DataFrame:
    """``company, consortium``: the consortia each company is labelled with, one row each."""
    return pairs.select(company, consortium).dropna().distinct()


def sample_rows(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """A repeatable sample of about ``share`` of the rows, chosen by a checksum of their keys.

    It does not depend on files or partitions; rows with equal keys stay together.
    """
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return df.filter(F.substring(F.md5(text), 1, 8) < f"{int(share * 16**8):08x}")


def forward_fill(df: DataFrame, group: str, order: str, column: str) -> DataFrame:
    """Fill a missing label from the last known one above it in the same group.

    A prefix scan over range partitions of (group, order): rows are dealt to ranges and
    written with the number of their range; each range fills its own rows; what a range's
    first group inherits is found from one row for each range. A group of any size, with
    an order of any density, is spread over as many ranges as it fills.

    Rows without a group form one group; rows without an order come first in theirs.
    Rows with equal order are filled in any order. Other columns pass through.
    """
    keys = [F.col(group).alias("_g"), F.col(order).alias("_o"), F.col(column).alias("_label")]
    ranges = df.select(*keys, F.struct(*df.columns).alias("_row")).repartitionByRange("_g", "_o")
    held = stage(ranges.withColumn("_part", F.spark_partition_id()), "ranges")

    place = lambda c: F.struct(F.col(c).isNotNull(), F.col(c))
    known = F.max_by("_label", F.when(F.col("_label").isNotNull(), place("_o")))
    ends = held.groupBy("_part", "_g").agg(known.alias("_last"))
    # from here on one row for each range: the group it ends with, and that group's last label so far
    ends = ends.groupBy("_part").agg(F.max_by(F.struct("_g", "_last"), place("_g")).alias("_end")).select("_part", "_end.*")
    so_far = Window.partitionBy("_g").orderBy("_part")
    ends = ends.withColumn("_carried", F.last("_last", ignorenulls=True).over(so_far))
    following = F.lead("_part").over(Window.orderBy("_part")).alias("_part")
    inherited = ends.select(following, F.col("_g").alias("_from"), "_carried").dropna(subset=["_part"])

    above = Window.partitionBy("_part", "_g").orderBy(F.asc_nulls_first("_o")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.last("_label", ignorenulls=True).over(above)
    filled = held.withColumn("_own", own).join(F.broadcast(inherited), "_part", "left")
    carried = F.when(F.col("_g").eqNullSafe(F.col("_from")), F.col("_carried"))
    label = F.coalesce("_own", carried)
    return filled.select(*[(label if c == column else F.col("_row")[c]).alias(c) for c in df.columns])


def null_profile(df: DataFrame) -> DataFrame:
    """One row: nulls per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def duplicate_report(df: DataFrame, key: str) -> DataFrame:
    """Rows whose known key occurs more than once, sorted by it."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return df.join(counts.select(key), key, "left_semi").orderBy(key)


def duplicate_share(df: DataFrame, key: str) -> DataFrame:
    """Rows with a repeated key and their share of all rows, from one grouping by key."""
    n = F.when(F.col(key).isNotNull() & (F.col("_n") > 1), F.col("_n")).otherwise(F.lit(0))
    return (
        key_counts(df, [key])
        .agg(F.sum(n).alias("duplicated"), F.sum("_n").alias("total"))
        .withColumn("share_pct", F.col("duplicated") / F.col("total") * 100)
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def key_is_unique(df: DataFrame, key: str) -> DataFrame:
    repeated = F.coalesce(F.max("_n"), F.lit(0)) <= 1
    return key_counts(df, [key]).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_keys"), repeated.alias("is_unique")
    )


def split_consistent(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose set columns hold at most one known value each (made scalar), and the others."""
    known = df.withColumns({c: F.array_compact(F.col(c)) for c in columns})
    fits: Column = F.lit(True)
    for c in columns:
        fits = fits & (F.size(c) <= 1)
    scalar = known.filter(fits).withColumns({c: F.get(F.col(c), 0) for c in columns})
    return scalar, known.filter(~fits)


def snapshot_diff(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Full outer join of two snapshots by key, with where each row occurs."""
    a = new.withColumn("_in_new", F.lit(True))
    b = old.withColumns({"_in_old": F.lit(True)})
    rename = {c: f"{c}_old" for c in old.columns if c != key}
    side = (
        F.when(F.col("_in_new") & F.col("_in_old"), F.lit("both"))
        .when(F.col("_in_new"), F.lit("left_only"))
        .otherwise(F.lit("right_only"))
    )
    return a.join(b.withColumnsRenamed(rename), key, "full").withColumn("_merge", side).drop("_in_new", "_in_old")


def new_rows(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    return new.join(old.select(key), key, "left_anti")
