"""Joins between company names and consortium names.

No join here compares all pairs: each one turns its predicate into keys whose equality
the predicate implies, joins on those keys, and checks the predicate on what is left.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.functions.cells import bind
from padron.functions.fuzzy import beats, edit_budget, lcs, ratio_from_lcs
from padron.functions.text import TOKEN_SEPARATORS, fold_accents, is_digits
from padron.operators.splits import EXTRA_MARKERS
from padron.sources.lookups import ENTITY_LETTERS
from padron.sources.staging import stage

# Further tokens that are never part of a company's own name.
OTHER_SEPARATORS = ["sl", "slu", "s.", "scclp", "-", "_", ",", "+", ".", ".,"]
MIN_TOKEN = 4


def exclude_names(df: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in ``others``; rows without a key stay."""
    return df.join(others.select(key).distinct(), key, "left_anti")


def keep_names(df: DataFrame, others: DataFrame, key: str) -> DataFrame:
    return df.join(others.select(key).distinct(), key, "left_semi")


# --- phrase containment ---------------------------------------------------------------


def _runs(c: Column) -> Column:
    """Alternating runs of word and non-word characters; ASCII text is spared the Unicode tables."""
    runs = lambda flags: F.regexp_extract_all(c, F.lit(rf"{flags}(\w+|\W+)"), F.lit(1))
    return F.when(c.rlike(r"[^\x00-\x7f]"), runs("(?U)")).otherwise(runs(""))


def _is_word(c: Column) -> Column:
    return c.rlike(r"(?U)^\w")


def _placed_runs(names: DataFrame) -> DataFrame:
    """``id, run, at`` of ``names(id, name)``: every run of word or of other characters with its place, from 1."""
    before = lambda runs, i: F.length(F.array_join(F.slice(runs, F.lit(1), i), ""))
    placed = bind(_runs(F.col("name")), lambda runs: F.transform(runs, lambda r, i: F.struct(r.alias("run"), (before(runs, i) + 1).alias("at"))))
    return names.select("id", F.inline(placed))


def _worded(c: Column) -> Column:
    return c.rlike(r"(?U)\w")


def _meeting_runs(own: DataFrame, joint: DataFrame) -> DataFrame:
    """The placed runs of ``joint`` on which a name can meet: words, and other runs that are whole names of ``own``."""
    runs = _placed_runs(joint)
    signs = own.filter(~_worded(F.col("name"))).select(F.col("name").alias("run"), F.lit(True).alias("_name"))
    return runs.join(signs, "run", "left").filter(_is_word(F.col("run")) | F.col("_name")).select("id", "run", "at")


def rarest_words(companies: DataFrame, runs: DataFrame) -> DataFrame:
    """``id, run, at``: of each company's words the one that the fewest consortium ``runs`` hold, and its place.

    A name without word characters stands for itself. A contained name brings all its
    words along, so names with a word that no consortium holds are left out.
    """
    words = _placed_runs(companies.filter(_worded(F.col("name")))).filter(_is_word(F.col("run")))
    signs = companies.filter(~_worded(F.col("name"))).select("id", F.col("name").alias("run"), F.lit(1).alias("at"))
    counts = runs.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    place = F.when(F.col("n").isNotNull(), F.struct("n", "run", "at"))
    best = words.unionByName(signs).join(counts, "run", "left").groupBy("id").agg(F.min(place).alias("best"), F.bool_and(F.col("n").isNotNull()).alias("all"))
    return best.filter("all").select("id", "best.run", "best.at")


#: Share of all names from which on a key counts as common.
COMMON = 1e-3


def without_common(df: DataFrame, key: str, wanted: DataFrame, names: DataFrame) -> DataFrame:
    """``df`` without the rows of common keys that ``wanted`` does not have, which need not be shuffled to a join.

    Common keys are those of more than ``COMMON`` of all ``names``: few, so they are looked
    up where the rows are.
    """
    least = names.count() * COMMON
    common = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > least).select(key)
    return df.join(F.broadcast(common.join(wanted.select(key), key, "left_anti")), key, "left_anti")


def numbered(df: DataFrame, column: str, label: str) -> DataFrame:
    """``id, name``: the distinct names, written, so that ids stay what they are."""
    names = df.select(F.col(column).alias("name")).filter("name <> ''").distinct()
    return stage(names.withColumn("id", F.monotonically_increasing_id()), label)


def _phrase_candidates(own: DataFrame, joint: DataFrame) -> DataFrame:
    """``c, u, start``: where in consortium ``u`` the name of company ``c`` would begin by its rarest word; each once."""
    runs = stage(_meeting_runs(own, joint), "runs")
    rarest = stage(rarest_words(own, runs), "rarest")
    met = rarest.withColumnsRenamed({"id": "c", "at": "c_at"}).join(without_common(runs, "run", rarest, joint).withColumnsRenamed({"id": "u", "at": "u_at"}), "run")
    return met.select("c", "u", (F.col("u_at") - F.col("c_at") + 1).alias("start")).filter("start > 0")


def _confirmed(candidates: DataFrame, own: DataFrame, joint: DataFrame, company: str, consortium: str) -> DataFrame:
    """The pairs of ``candidates(c, u, start)`` whose company stands at ``start``, or that have none; each once."""
    texts = candidates.join(own.select(F.col("id").alias("c"), F.col("name").alias("_c")), "c").join(joint.select(F.col("id").alias("u"), F.col("name").alias("_u")), "u")
    start, size = F.col("start"), F.length("_c")
    same = F.substr("_u", start, size) == F.col("_c")
    left = F.when(start > 1, F.substr("_u", start - 1, F.lit(1))).otherwise("")
    edge = lambda inner, outer: _is_word(inner) != _is_word(outer)
    bounded = edge(F.substring("_c", 1, 1), left) & edge(F.right("_c", F.lit(1)), F.substr("_u", start + size, F.lit(1)))
    # rows lie by u already: with it among the keys they are made distinct where they are
    return texts.filter(start.isNull() | (same & bounded)).select("c", "u", "_c", "_u").distinct().select(F.col("_c").alias(company), F.col("_u").alias(consortium))


def containment_join(
    companies: DataFrame, company: str, consortia: DataFrame, consortium: str
) -> DataFrame:
    """Pairs where the company's name stands between word boundaries inside the consortium's name.

    A contained name brings all its words along, so pairs meet on the company's rarest
    one, with ids and places; there the name is compared. A word that begins or ends half
    of the names is only used by names that have no other. Case counts. Empty names match
    nothing.
    """
    own, joint = numbered(companies, company, "phrases"), numbered(consortia, consortium, "joint-names")
    return _confirmed(_phrase_candidates(own, joint), own, joint, company, consortium)


# --- token overlap --------------------------------------------------------------------


def tokens(c: Column) -> Column:
    """Lower-case pieces between separators; none when the name has no separator."""
    return F.when(c.rlike(TOKEN_SEPARATORS), F.split(F.lower(c), TOKEN_SEPARATORS)).otherwise(
        F.array().cast("array<string>")
    )


def separator_terms(spark: SparkSession, types: DataFrame | None = None) -> DataFrame:
    """Legal forms and signs that are no names: the fixed ones, and those of ``types(CompanyType)``."""
    forms = [row[2].split(",")[0] for row in ENTITY_LETTERS if row[2]]
    terms = spark.createDataFrame([(t,) for t in sorted({*forms, *EXTRA_MARKERS, *OTHER_SEPARATORS})], "term string")
    if types is None:
        return terms
    return terms.unionByName(types.select(F.lower("CompanyType").alias("term")).dropna()).distinct()


def stop_terms(lists: Iterable[DataFrame], column: str = "term") -> DataFrame:
    """One distinct, accent-folded stop table from several lists."""
    folded = [df.select(fold_accents(F.col(column)).alias("term")) for df in lists]
    return reduce(DataFrame.unionByName, folded).distinct()


def assemble_stops(
    names: Iterable[tuple[DataFrame, str]], words: Iterable[DataFrame], frequent: DataFrame
) -> DataFrame:
    """The stop table: words of surname and given-name columns, word lists and the frequency list.

    ``words`` and ``frequent`` have a column ``term``; all terms come in lower case.
    """
    lists = [words_of(df, column) for df, column in names] + [*words, frequent]
    return stop_terms([df.select(F.lower("term").alias("term")) for df in lists])


def words_of(df: DataFrame, column: str) -> DataFrame:
    """Single words of multi-word entries, distinct."""
    return df.select(F.explode(F.split(column, " ")).alias("term")).distinct()


def distinctive_tokens(names: DataFrame, name: str, stops: DataFrame | None, types: DataFrame | None = None) -> DataFrame:
    """``name, token``: tokens longer than three characters, not numeric, not a stop term or a legal form."""
    exploded = names.select(name, F.explode(tokens(F.col(name))).alias("token")).filter(
        (F.length("token") >= MIN_TOKEN) & ~is_digits(F.col("token"))
    )
    distinct = exploded.distinct()
    terms = separator_terms(names.sparkSession, types)
    terms = terms if stops is None else stop_terms([terms, stops])
    return distinct.join(terms.withColumnRenamed("term", "token"), "token", "left_anti").select(name, "token")


def _token_candidates(company_tokens: DataFrame, joint: DataFrame) -> DataFrame:
    """``<company_tokens columns>, u``: consortia ``u`` that hold a token, each pair once."""
    held = F.filter(F.array_distinct(tokens(F.col("name"))), lambda t: F.length(t) >= MIN_TOKEN)
    found = joint.select(F.col("id").alias("u"), F.explode(held).alias("token"))
    return company_tokens.join(without_common(found, "token", company_tokens, joint), "token").drop("token").distinct()


def token_overlap_join(
    company_tokens: DataFrame, company: str, consortia: DataFrame, consortium: str
) -> DataFrame:
    """Pairs sharing at least one distinctive token."""
    joint = numbered(consortia, consortium, "joint-names")
    met = _token_candidates(company_tokens.select(company, "token").distinct(), joint)
    return met.join(joint.select(F.col("id").alias("u"), F.col("name").alias(consortium)), "u").select(company, consortium)


def phrase_or_token_join(
    companies: DataFrame, company: str, company_tokens: DataFrame, consortia: DataFrame, consortium: str
) -> DataFrame:
    """The pairs of ``containment_join`` and of ``token_overlap_join``, each once.

    Both give pairs of ids; texts are looked up for all of them together. The names of
    ``company_tokens`` are among those of ``companies``.
    """
    own, joint = numbered(companies, company, "phrases"), numbered(consortia, consortium, "joint-names")
    ids = own.select(F.col("id").alias("c"), F.col("name").alias(company))
    by_token = _token_candidates(company_tokens.select(company, "token").join(ids, company).select("c", "token").distinct(), joint)
    candidates = _phrase_candidates(own, joint).unionByName(by_token.withColumn("start", F.lit(None).cast("int")))
    return _confirmed(candidates, own, joint, company, consortium)


# --- fuzzy ----------------------------------------------------------------------------

def _identified(df: DataFrame, name: str) -> DataFrame:
    """Distinct names with ``id``, ``size`` and ``bag``: for each kind of character whether its count is odd."""
    distinct = df.select(F.col(name).alias("name")).filter("name <> ''").distinct()
    letters = F.expr("aggregate(sequence(1, length(name)), 0L, (s, i) -> s ^ shiftleft(1L, ascii(substr(name, i, 1)) & 63))")
    return distinct.select("name", F.xxhash64("name").alias("id"), F.length("name").alias("size"), letters.alias("bag"))


# Characters in rough order of frequency; dealing them out in turn gives classes of even weight.
CHARACTER_ORDER = " eaosrnidlctumpbgv.yqhfzj-0123456789ñxwkáéíóú,"
OTHER_CHARACTER = "¤"
# budget -> number of character classes; one key per choice of (classes - budget) of them
CHARACTER_CLASSES = {0: 1, 1: 3, 2: 5, 3: 6, 4: 7, 5: 7, 6: 8, 7: 9}
LARGE_BUDGET = len(CHARACTER_CLASSES)


def dropped_characters(budget: int) -> list[str]:
    """For each key of this budget, the characters it leaves out."""
    classes = CHARACTER_CLASSES[budget]
    dealt = [""] * classes
    for i, char in enumerate(OTHER_CHARACTER + CHARACTER_ORDER):
        lap, at = divmod(i, classes)
        dealt[at if lap % 2 == 0 else classes - 1 - at] += char
    return ["".join(out) for out in combinations(dealt, budget)]


def _character_keys(names: DataFrame) -> DataFrame:
    """Keys for budgets below ``LARGE_BUDGET``: the name without some character classes.

    With a budget of k insertions and deletions and m > k character classes, at least
    m - k classes are untouched, so two names within budget agree, in order, on the
    characters of some m - k classes.
    """
    table = [(b, i, drop) for b in CHARACTER_CLASSES for i, drop in enumerate(dropped_characters(b))]
    slots = names.sparkSession.createDataFrame(table, "budget int, slot int, dropped string")
    plain = F.regexp_replace("name", f"[^{CHARACTER_ORDER.replace('-', '')}\\-]", OTHER_CHARACTER)
    kept = F.expr("translate(_plain, dropped, '')")
    return (
        names.filter(F.col("budget") < LARGE_BUDGET)
        .withColumn("_plain", plain)
        .join(F.broadcast(slots), "budget")
        .select("id", "size", "bag", "budget", F.col("name").alias("text"), F.xxhash64("budget", "slot", kept).alias("key"))
    )


def _pair_slices(name: Column, budget: Column) -> Column:
    """Adjacent character pairs of a name dealt into ``4 * budget`` classes, in order within each."""
    classes = 4 * budget
    starts = F.filter(F.sequence(F.lit(1), F.length(name)), lambda i: i < F.length(name))
    dealt = F.transform(starts, lambda i: F.struct(F.substr(name, i, F.lit(2)).alias("pair")))
    dealt = F.transform(dealt, lambda p: F.struct(p["pair"].alias("pair"), F.pmod(F.crc32(p["pair"]), classes).alias("slot")))
    own = lambda k: F.transform(F.filter(dealt, lambda p: p["slot"] == k), lambda p: p["pair"])
    return F.transform(F.sequence(F.lit(0), classes - 1), lambda k: F.array_join(own(k), ""))


def _pair_keys(names: DataFrame) -> DataFrame:
    """Keys for larger budgets: the adjacent character pairs of one class, in order.

    One insertion or deletion changes at most three adjacent pairs, so of 4k classes at
    least k stay untouched. A name with fewer than k empty classes needs no key for
    them: one of its untouched classes holds something.
    """
    empty = F.size(F.filter("_slices", lambda s: s == ""))
    return (
        names.filter(F.col("budget") >= LARGE_BUDGET)
        .withColumn("_slices", _pair_slices(F.col("name"), F.col("budget")))
        .select("id", "size", "bag", "budget", empty.alias("_empty"), F.posexplode("_slices").alias("slot", "_s"))
        .filter((F.col("_s") != "") | (F.col("_empty") >= F.col("budget")))
        .select("id", "size", "bag", "budget", F.lit(None).cast("string").alias("text"), F.xxhash64("budget", "slot", "_s").alias("key"))
    )


def fuzzy_keys(names: DataFrame, threshold: int = 95) -> DataFrame:
    """``id, size, bag, budget, text, key`` such that two names scoring above the threshold share a key of their budget.

    A name gets the keys of every budget it can have with a partner of admissible length.
    ``text`` is the name; null for budgets from ``LARGE_BUDGET`` on, whose names are long.
    """
    size = F.col("size")
    rate = (199 - 2 * threshold) / 200
    shortest = F.floor(size * (1 - rate) / (1 + rate))
    longest = F.ceil(size * (1 + rate) / (1 - rate))
    budgets = F.sequence(edit_budget(size + shortest, threshold), edit_budget(size + longest, threshold))
    ranged = names.select("*", F.explode(budgets).alias("budget"))
    return _character_keys(ranged).unionByName(_pair_keys(ranged))


def fuzzy_candidates(a: DataFrame, b: DataFrame, threshold: int = 95) -> DataFrame:
    """``a, b``: ids of the pairs that share a key and may be within budget, each once.

    An edit changes whether the count of one character is odd, so the bags differ in no
    more bits than there are edits, and the Levenshtein distance never exceeds their
    count. Both are seen in the join, where names that share a key but little else end.
    """
    columns = ("id", "size", "bag", "budget", "text")
    side = lambda df, name: fuzzy_keys(df, threshold).select(*[F.col(c).alias(f"{name}_{c}") for c in columns], "key")
    budget = edit_budget(F.col("a_size") + F.col("b_size"), threshold)
    near = (F.abs(F.col("a_size") - F.col("b_size")) <= F.col("a_budget")) & (F.bit_count(F.col("a_bag").bitwiseXOR(F.col("b_bag"))) <= F.col("a_budget"))
    own = (F.col("a_budget") == F.col("b_budget")) & (F.col("a_budget") == budget)
    # beyond its last argument the distance is -1; texts are missing where names are long
    alike = F.expr("a_text IS NULL OR b_text IS NULL OR levenshtein(a_text, b_text, a_budget) >= 0")
    return side(a, "a").join(side(b, "b"), "key").filter(near & own & alike).select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct()


def fuzzy_join(
    left: DataFrame,
    left_name: str,
    right: DataFrame,
    right_name: str,
    threshold: int = 95,
) -> DataFrame:
    """Pairs of names whose similarity ratio exceeds ``threshold``, with the ratio.

    Candidates are pairs of 64-bit ids; texts meet only to be checked, so equal ids of
    different texts cost a check and no pair.
    """
    a, b = stage(_identified(left, left_name), "left-names"), stage(_identified(right, right_name), "right-names")
    texts = fuzzy_candidates(a, b, threshold).join(a.select(F.col("id").alias("a"), F.col("name").alias("_a")), "a")
    texts = texts.join(b.select(F.col("id").alias("b"), F.col("name").alias("_b")), "b")
    total = F.length("_a") + F.length("_b")
    # Levenshtein distance never exceeds the count of insertions and deletions
    pairs = texts.filter(F.levenshtein("_a", "_b") <= edit_budget(total, threshold)).withColumn("_lcs", lcs("_a", "_b"))
    return pairs.filter(beats(F.col("_lcs"), total, threshold)).select(
        F.col("_a").alias(left_name), F.col("_b").alias(right_name), ratio_from_lcs(F.col("_lcs"), total).alias("ratio")
    )


# --- edges ----------------------------------------------------------------------------


def invert_edges(links: DataFrame, company: str, consortia: str, consortium: str) -> DataFrame:
    """Company -> list of consortia becomes one (consortium, company) row per link."""
    return links.select(F.explode(consortia).alias(consortium), company).distinct()


