"""URL filters: rules, and a character language-model ratio for what no rule decides.

URLs that a rule allows or blocks train two variable-order Markov models over characters.
An n-gram's conditional probability is interpolated with that of the next shorter
context. For each n-gram a table holds how much it moves the log-likelihood ratio of its
last character beyond the shorter n-gram, so the ratio of a URL is the sum over the
n-grams it has in the table: where a long context was never seen, the sum ends with the
longest that was. The ratio divided by the URL's length is compared with a threshold
calibrated on rule-decided URLs that the models were not trained on. Rules see host and
path, the models the whole URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.sources.staging import stage

#: Rules: host and path prefix, and verdict.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
ORDERS = 4
#: Pseudo-count given to the shorter context's probability.
PRIOR = 4.0
#: Characters that an unseen one is taken to be one of.
ALPHABET = 128
#: One of so many rule-decided URLs, by hash, is kept from training for the threshold.
FOLDS = 5
#: Rows of URLs in one task before they become n-grams, some 200 times as many.
URLS_PER_TASK = 4096


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null and for text without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = _lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def whole_url(url: Column) -> Column:
    """Everything from scheme to fragment, the host after ``://`` in lower case; empty for null."""
    parts = [F.regexp_extract(url, r"(?s)^(.*?://)([^/?#]*)(.*)$", k) for k in (1, 2, 3)]
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.concat(parts[0], _lower(parts[1]), parts[2])).otherwise(url), F.lit(""))


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def matching_rule(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits; null when none does."""
    found = None
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        site, _, prefix = rule.partition("/")
        fits = ((host == site) | host.endswith(f".{site}")) & path.startswith(f"/{prefix}")
        found = F.when(fits, F.lit(rule)) if found is None else found.when(fits, F.lit(rule))
    return found if found is not None else F.lit(None).cast("string")


def _verdict(rule: Column, rules: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for name, verdict in rules.items():
        out = F.when(rule == name, F.lit(verdict)).otherwise(out)
    return out


def _grams(urls: DataFrame, *columns: str) -> DataFrame:
    """One row for each n-gram of orders 1 to ORDERS of ``text``, which has a start mark."""
    text = F.concat(F.lit("\x02"), F.col("text"))
    places = F.sequence(F.lit(2), F.length(text))
    each = lambda i: F.transform(
        F.sequence(F.lit(1), F.least(i, F.lit(ORDERS))), lambda k: F.substr(text, i - k + 1, k)
    )
    grams = F.flatten(F.transform(places, each))
    return urls.filter("length(text) > 0").select(*columns, F.explode(grams).alias("gram"))


def gram_ratios(labelled: DataFrame) -> DataFrame:
    """gram, move: the log-likelihood ratio of accepted to rejected that each n-gram adds.

    ``labelled`` has text and accepted. Only n-grams seen in either class are listed.
    """
    counts = _grams(labelled, "accepted").groupBy("gram").agg(
        F.sum(F.col("accepted").cast("long")).alias("yes"), F.sum((~F.col("accepted")).cast("long")).alias("no")
    )
    counts = stage(counts, "grams").withColumn("n", F.length("gram"))
    # a context's count is the sum of what follows it, so that the shares add up to one
    context = F.expr("substring(gram, 1, n - 1)")
    totals = counts.groupBy("n", context.alias("context")).agg(F.sum("yes").alias("yes_all"), F.sum("no").alias("no_all"))
    table = None
    for n in range(1, ORDERS + 1):
        level = counts.filter(F.col("n") == n).withColumn("context", context).withColumn("shorter", F.expr("substring(gram, 2)"))
        level = level.join(totals.filter(F.col("n") == n).drop("n"), "context")
        if table is None:
            level = level.withColumn("p_yes", F.lit(1 / ALPHABET)).withColumn("p_no", F.lit(1 / ALPHABET))
        else:
            level = level.join(table.select(F.col("gram").alias("shorter"), F.col("q_yes").alias("p_yes"), F.col("q_no").alias("p_no")), "shorter")
        share = lambda c: (F.col(c) + PRIOR * F.col(f"p_{c}")) / (F.col(f"{c}_all") + PRIOR)
        level = level.select("gram", "p_yes", "p_no", share("yes").alias("q_yes"), share("no").alias("q_no"))
        level = stage(level, f"level{n}")
        move = F.log(F.col("q_yes") / F.col("q_no")) - F.log(F.col("p_yes") / F.col("p_no"))
        part = level.select("gram", move.alias("move"))
        ratios = part if table is None else ratios.union(part)
        table = level
    return ratios


def score_urls(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """text, score for each of the distinct texts of ``urls``: summed moves divided by the length."""
    scored = _grams(urls, "text").join(ratios, "gram").groupBy("text").agg(F.sum("move").alias("score"))
    return scored.select("text", (F.col("score") / F.length("text")).alias("score"))


def threshold(scores: DataFrame) -> DataFrame:
    """One row ``limit``: between the class means of ``score``, nearer to the narrower class.

    Null, which accepts everything, unless both classes are there.
    """
    by = lambda c, f: f(F.when(F.col("accepted") == c, F.col("score")))
    yes, no = by(True, F.avg), by(False, F.avg)
    s_yes = F.coalesce(by(True, F.stddev_samp), F.lit(0.0)) + 1e-6
    s_no = F.coalesce(by(False, F.stddev_samp), F.lit(0.0)) + 1e-6
    return scores.agg(((yes * s_no + no * s_yes) / (s_yes + s_no)).alias("limit"))


def judge_urls(pages: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score for every row of ``pages(page_id, url)``.

    Null urls and urls without ``://`` have an empty host and path and fit no rule. Urls
    without a scored n-gram, so null and empty ones, are allowed. Repeated rows get equal results; other
    columns are ignored; an empty table gives no rows.
    """
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    rows = stage(rows.withColumn("text", whole_url(F.col("url"))).drop("url"), "urls")
    ruled = rows.withColumn("ruled", _verdict(F.col("rule"), rules))
    labelled = ruled.filter("ruled IS NOT NULL").select("text", (F.col("ruled") == "allow").alias("accepted"))
    tasks = rows.count() // URLS_PER_TASK + 1
    left_out = F.pmod(F.xxhash64("text"), F.lit(FOLDS)) == 0
    ratios = gram_ratios(labelled.filter(~left_out).repartition(tasks))
    scores = stage(score_urls(rows.select("text").distinct().repartition(tasks), ratios), "scores")
    judged = labelled.join(scores, "text")
    # without URLs of both classes among those left out, all rule-decided ones have to do
    limits = [threshold(part).first()["limit"] for part in (judged.filter(left_out), judged)]
    limit = next((x for x in limits if x is not None), None)
    model = F.when(F.col("score") < F.lit(limit).cast("double"), "block").otherwise("allow")
    judged = ruled.join(scores, "text", "left")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", model).alias("verdict"), "score")
