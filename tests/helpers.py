from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one(spark, value, fn, kind="string"):
    """Result of a column function on one value."""
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("r")).first().r


def many(spark, values, fn, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [row.r for row in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
