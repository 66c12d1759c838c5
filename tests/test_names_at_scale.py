"""Splitting, dictionary and similarity of names against the same done directly, and their hot cases."""

import random
import re

import pytest
from helpers import rows
from pyspark.sql import functions as F

from padron.functions.fuzzy import BLOCK, edit_budget, fuzzy_ratio, lcs, lcs_length
from padron.operators import linkage
from padron.operators.linkage import _identified, _placed_runs, containment_join, fuzzy_candidates, fuzzy_join, rarest_words
from padron.operators.quality import frequency_stoplist, merged_counts, stops_of, token_counts
from padron.operators.splits import default_markers, dictionary_hits, known_heads, marker_hits, marker_table, split_consortium


def frame(spark, values, column):
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


# --- similarity ------------------------------------------------------------------------

ALPHABETS = ["ab", "acme obras y .-", "ñáé漢字ß x", "a\U0001f600b"]


def texts(seed, n, longest):
    rng = random.Random(seed)
    return ["".join(rng.choice(rng.choice(ALPHABETS)) for _ in range(rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("longest", [20, BLOCK + 2, 3 * BLOCK])
def test_common_subsequence_equals_plain_python(spark, longest):
    pairs = list(zip(texts(1, 60, longest), texts(2, 60, longest), strict=True))
    pairs += [("a" * n, "a" * m) for n in (BLOCK - 1, BLOCK, BLOCK + 1, 2 * BLOCK) for m in (BLOCK - 1, BLOCK, 2 * BLOCK + 1)]
    pairs += [("", ""), ("", "a"), ("a", ""), (None, "a"), ("a", None)]
    got = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string").select("i", lcs(F.col("a"), F.col("b")).alias("n"))
    expected = {i: None if a is None or b is None else lcs_length(a, b) for i, (a, b) in enumerate(pairs)}
    assert {r.i: r.n for r in got.collect()} == expected


def test_ratio_of_two_columns(spark):
    df = spark.createDataFrame([("acme", "acme"), ("acme", "acne"), ("", ""), ("a", None)], "a string, b string")
    assert [r.r for r in df.select(fuzzy_ratio(F.col("a"), F.col("b")).alias("r")).collect()] == [100, 75, 100, None]


@pytest.mark.parametrize("threshold", [95, 85])
def test_fuzzy_join_of_random_names(spark, threshold):
    rng = random.Random(threshold)
    words = ["obras", "aguas", "norte", "sur", "s.l.", "hermanos", "y", "2000", "garcía"]
    left = sorted({" ".join(rng.choices(words, k=rng.randint(1, 9))) for _ in range(60)})

    def damaged(name):
        for _ in range(rng.randint(0, 2 + len(name) // 20)):
            at = rng.randrange(len(name) + 1)
            name = name[:at] + rng.choice(["", "x", "ob"]) + name[at + rng.randint(0, 1) :]
        return name

    right = sorted({damaged(n) for n in left for _ in range(3)} - {""})
    ratio = lambda a, b: round(200 * lcs_length(a, b) / (len(a) + len(b)))
    expected = sorted((a, b, ratio(a, b)) for a in left for b in right if ratio(a, b) > threshold)
    assert rows(fuzzy_join(frame(spark, left, "a"), "a", frame(spark, right, "b"), "b", threshold)) == sorted(expected, key=repr)
    assert expected


def test_candidates_of_names_that_share_common_words(spark):
    n = 1000
    common = "construcciones y servicios integrales "
    left = spark.range(n).select(F.concat(F.lit(common), F.lower(F.hex(F.xxhash64("id")))).alias("a"))
    right = left.select(F.regexp_replace("a", "servicios", "servicioss").alias("b"))
    met = fuzzy_candidates(_identified(left, "a"), _identified(right, "b"))
    assert n <= met.count() < n * n / 100
    assert fuzzy_join(left, "a", right, "b").count() == n


def test_candidates_are_within_the_edits_their_length_allows(spark):
    left = spark.range(3000).select(F.concat(F.lit("red ring grupo"), F.pmod(F.col("id") * 7919, F.lit(1000003)).cast("string")).alias("a"))
    a, b = _identified(left, "a"), _identified(left.select(F.col("a").alias("b")), "b")
    met = fuzzy_candidates(a, b).join(a.select(F.col("id").alias("a"), F.col("name").alias("x")), "a").join(b.select(F.col("id").alias("b"), F.col("name").alias("y")), "b")
    far = F.levenshtein("x", "y") > edit_budget(F.length("x") + F.length("y"))
    assert met.filter(far).limit(5).collect() == []
    assert met.count() >= 3000


# --- dictionary ------------------------------------------------------------------------


def test_heads_of_known_names(spark):
    got = {(r.level, r["head"]): sorted(r.lengths) for r in known_heads(frame(spark, ["a", "a b c", "a b d", "a b c d e"], "gram")).collect()}
    assert got == {(0, "a"): [1], (1, "a b"): [3], (2, "a b c d"): [5]}


def test_dictionary_hits_equal_all_spans(spark):
    rng = random.Random(8)
    word = lambda: rng.choice("abcdef")
    known = {" ".join(word() for _ in range(rng.randint(1, 9))) for _ in range(400)} | {" ".join("ab" * 250), ""}
    names = ["  ".join(word() for _ in range(rng.randint(0, 14))) for _ in range(60)] + [" ".join("ab" * 260), "", None]
    expected = []
    for k, name in enumerate(names):
        ws = (name or "").split()
        longest = 520 if k >= 60 else 14
        expected += [(k, i, " ".join(ws[i:j])) for i in range(len(ws)) for j in range(i + 1, min(len(ws), i + longest) + 1) if " ".join(ws[i:j]) in known]
    df = spark.createDataFrame(list(enumerate(names)), "k int, t string")
    got = dictionary_hits(df, "t", frame(spark, sorted(known), "n"), "n")
    assert rows(got, "k", "at", "gram") == sorted(expected, key=repr)


def test_one_long_known_name_lengthens_no_other_span(spark):
    """Without prefixes each text of 200 words would give 20,100 spans as soon as one known name has 500 words."""
    long = " ".join(f"w{i}" for i in range(500))
    names = spark.range(3000).select("id", F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(200)), lambda i: F.concat(F.lit("v"), i.cast("string"))), F.lit("acme")).alias("t"))
    got = dictionary_hits(names.unionByName(spark.createDataFrame([(-1, "x " + long)], "id long, t string")), "t", frame(spark, [long, "acme"], "n"), "n")
    assert got.filter("gram = 'acme' AND at = 200").count() == 3000
    assert [(r.id, r["at"]) for r in got.filter("gram <> 'acme'").collect()] == [(-1, 1)]


def test_dictionary_of_nothing(spark):
    names = frame(spark, ["acme obras"], "t")
    assert dictionary_hits(names, "t", frame(spark, [], "n"), "n").count() == 0
    assert dictionary_hits(names.limit(0), "t", frame(spark, ["acme"], "n"), "n").count() == 0


# --- markers ---------------------------------------------------------------------------


def direct_hits(text, markers):
    return sorted({(i + 1, -len(m)) for m in markers if m for i in range(len(text)) if text.startswith(m, i)})


def test_marker_hits_equal_direct_search(spark):
    rng = random.Random(4)
    markers = [*default_markers(), "x", "ab", "s.l.u,"]
    names = list({"".join(rng.choice(["s.l", ".", "u", ",", " ", "a", "b", "x", "s.coop", "soc", "-", "é"]) for _ in range(rng.randint(0, 25))) for _ in range(150)})
    got = {r.key: [tuple(h) for h in r.hits] for r in marker_hits(frame(spark, names, "t"), "t", "t", frame(spark, markers, "form")).collect()}
    assert got == {t: direct_hits(t, markers) for t in names if direct_hits(t, markers)}


def cut_by_pattern(text, pattern):
    """Pieces by one alternation of all markers, as the written rules say it."""
    ends = re.findall(f"(.+?(?:{pattern}))", text)
    spaced = [re.sub(rf"\s*({pattern})$", r" \1", e) for e in ends]
    return [*spaced, re.sub(f"^(?:.+?(?:{pattern}))+", "", text)]


def test_split_equals_the_pattern_of_all_markers(spark):
    markers = [*default_markers(), "gmbh & co", "kft."]
    pattern = "|".join(re.escape(m) for m in sorted(markers, key=lambda m: (-len(m), m)))
    rng = random.Random(6)
    part = lambda: rng.choice(["acme", "norte 2", "obras", "s.l.", "s.a.u.", "kft.", "gmbh & co", "s.l", "sur"])
    names = sorted({" ".join(part() for _ in range(rng.randint(2, 7))) for _ in range(200)})
    got = {r.n: list(r.pieces) for r in split_consortium(frame(spark, names, "n"), "n", markers=markers).collect()}
    checked = 0
    for name in names:
        found = list(re.finditer(pattern, name))
        if not found or " y " in name or re.fullmatch(rf"(?:(?!{pattern}).)*(?:{pattern})", name):
            continue
        tidy = [re.sub(r"(?:\s|[-_ ,+]|(?<=\s)y|^y)+$", "", re.sub(r"^(?:[-_ ,+]|\s)+", "", p)) for p in cut_by_pattern(name, pattern) if len(p.strip()) > 1]
        assert got[name] == [p for p in tidy if p], name
        checked += 1
    assert checked > 50


def test_a_hundred_thousand_legal_forms(spark):
    firms = spark.range(100_000).select(F.concat(F.lit("acme"), "id").alias("FullName"), F.concat(F.lit("q"), "id", F.lit(".")).alias("CompanyType"))
    forms = marker_table(firms)
    assert forms.count() > 100_000
    joint = spark.range(0, 100_000, 100).select("id", F.concat(F.lit("norte q"), "id", F.lit(". sur q"), 99_999 - F.col("id"), F.lit(". este")).alias("FullName"))
    pieces = split_consortium(joint, "FullName", markers=forms)
    expected = F.concat(F.lit("norte q"), "id", F.lit(".|sur q"), 99_999 - F.col("id"), F.lit(".|este"))
    wrong = pieces.join(joint, "FullName").filter(F.array_join("pieces", "|") != expected)
    assert pieces.count() == 1000 and wrong.count() == 0


# --- containment and stop lists --------------------------------------------------------


def test_contained_names_that_share_their_first_word(spark):
    """Every name begins with one word; pairs meet on another."""
    n = 400
    names = spark.range(n).select("id", F.concat(F.lit("construcciones norte x"), "id", F.lit(" sa")).alias("c"))
    joint = names.select(F.concat(F.lit("ute construcciones sur - "), "c", F.lit(" y otros")).alias("u"))
    own, runs = (df.select(F.col(c).alias("name"), F.monotonically_increasing_id().alias("id")) for df, c in ((names, "c"), (joint, "u")))
    met = rarest_words(own, _placed_runs(runs))
    assert {r.run[0] for r in met.collect()} == {"x"} and met.count() == n
    assert containment_join(names, "c", joint, "u").count() == n


def test_stop_lists_of_runs_add_up(spark):
    rng = random.Random(2)
    tokens = [rng.choice("aaaabbbccdefgh") + rng.choice("xy") for _ in range(500)]
    runs = [frame(spark, tokens[a:b], "token") for a, b in ((0, 100), (100, 101), (101, 500))]
    a, b, c = map(token_counts, runs)
    whole = rows(frequency_stoplist(frame(spark, tokens, "token"), percentile=0.8, manual=["z"]))
    assert rows(stops_of(merged_counts(a, b, c), 0.8, ["z"])) == whole
    assert rows(stops_of(merged_counts(merged_counts(c, a), b), 0.8, ["z"])) == whole
    assert len(whole) > 2


def test_a_name_with_a_word_no_consortium_holds_meets_nothing(spark):
    """Such a name is contained nowhere; it used to be compared with every holder of its other words."""
    joint = spark.createDataFrame([(i, f"blue steel {i} ute") for i in range(50)], "id long, name string")
    own = spark.createDataFrame([(100, "blue steel 7"), (101, "blue steel 999"), (102, "--")], "id long, name string")
    runs = linkage._placed_runs(joint)
    assert [tuple(r) for r in linkage.rarest_words(own, runs).collect()] == [(100, "7", 12)]
    starts = linkage._phrase_candidates(own, joint)
    assert [tuple(r) for r in starts.collect()] == [(100, 7, 1)]


def test_phrase_or_token_join_is_both(spark):
    """Signs as names, accents, common words, repeated names and overlapping places."""
    names = ["blue", "a a", "--", "ñu", "x-", "steel works", "gone steel", "blue", ""]
    joint = ["a a a", "xa a a", "-- blue", "blue --", "el ñu", "ñus", "x- y", "steel works ute", "Blue", None, ""] + [f"common {i}" for i in range(2000)]
    own = spark.createDataFrame([(n,) for n in names], "company string")
    all_ = spark.createDataFrame([(n,) for n in joint], "consortium string")
    tokens = spark.createDataFrame([("steel works", "works"), ("gone steel", "steel"), ("blue", "blue")], "company string, token string")
    by_phrase = {tuple(r) for r in linkage.containment_join(own, "company", all_, "consortium").collect()}
    by_token = {tuple(r) for r in linkage.token_overlap_join(tokens, "company", all_, "consortium").collect()}
    both = [tuple(r) for r in linkage.phrase_or_token_join(own, "company", tokens, all_, "consortium").collect()]
    assert ("gone steel", "steel works ute") in by_token - by_phrase
    assert {("a a", "xa a a"), ("ñu", "el ñu"), ("steel works", "steel works ute")} <= by_phrase
    assert sorted(both) == sorted(by_phrase | by_token)
