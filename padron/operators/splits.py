"""Split a consortium's name into the names of its members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.functions.cells import strip
from padron.functions.text import strip_boilerplate, word_difference, words
from padron.sources.lookups import ENTITY_LETTERS
from padron.sources.staging import stage

# Spellings of legal forms that end a member's name.
EXTRA_MARKERS = [
    "s.l.p.", "s.l.p", "s.l.l.", "s.a.u.", "s.l.u.", "s.l.u", "s.l.u,",
    "slu", "s.l", "c.o.o.p.", "s.a", "sl.", "sccl", "s.coop.pequeña",
]
CONSORTIUM_FORM = "u.t.e."
DELIMITERS = "[-_,+]"


def default_markers() -> list[str]:
    """First legal form of each entity letter, without the consortium form, and the extra spellings."""
    forms = [row[2].split(",")[0] for row in ENTITY_LETTERS if row[2]]
    return sorted({*forms, *EXTRA_MARKERS} - {CONSORTIUM_FORM})


def company_markers(companies: DataFrame) -> list[str]:
    """``marker_table`` as a sorted list, for a caller who knows that it is short."""
    return sorted(row.form for row in marker_table(companies).collect())


def marker_table(companies: DataFrame) -> DataFrame:
    """``form``: the legal forms that occur in the company table and the extra spellings."""
    own = companies.select(F.lower("CompanyType").alias("form")).filter(~F.col("form").isin(CONSORTIUM_FORM, ""))
    return own.unionByName(_forms(companies.sparkSession, EXTRA_MARKERS)).distinct()


def _forms(spark: SparkSession, markers: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(m,) for m in markers], "form string")


# Characters by which markers are looked up before they are compared whole.
HEAD = 3


def _spaced(c: Column) -> Column:
    """White space in markers and texts is alike."""
    return F.regexp_replace(c, r"\s", " ")


def marker_hits(texts: DataFrame, key: str, text: str, forms: DataFrame) -> DataFrame:
    """``key, hits``: for each text, known by its key, in which a marker of ``forms(form)`` stands, every place.

    A hit is ``at`` (from 1) and ``less``, minus the marker's length: hits are sorted by
    place, longer ones first. Markers are a table and are found by joins: the characters
    at each place with the first characters of the markers, then the text of each length
    that markers with that beginning have.
    """
    known = forms.select(_spaced(F.col("form")).alias("form")).filter("form <> ''").distinct()
    heads = known.groupBy(F.substring("form", 1, HEAD).alias("head")).agg(F.collect_set(F.length("form")).alias("lengths"))
    heads = stage(heads, "heads")
    # the kinds of characters markers begin with, and HEAD sizes at most
    begins = heads.select(F.substring("head", 1, 1).alias("first"), F.length("head").alias("n")).distinct().collect()
    firsts, sizes = "".join(sorted({r.first for r in begins})), sorted({r.n for r in begins})
    plain = texts.select(F.col(key).alias("key"), _spaced(F.col(text)).alias("plain")).filter("plain <> ''")
    # one pass over the characters; looked up by place, each would be counted from the beginning of the text
    placed = plain.select("key", "plain", F.posexplode(F.split("plain", "")).alias("_before", "_first"))
    places = placed.filter(F.instr(F.lit(firsts), F.col("_first")) > 0).select("key", "plain", (F.col("_before") + 1).alias("at"))
    begun = places.select("*", F.explode(F.array(*[F.substr("plain", F.col("at"), F.lit(n)) for n in sizes]).cast("array<string>")).alias("head"))
    found = begun.join(heads, "head").select("key", "plain", "at", F.explode("lengths").alias("n"))
    found = found.select("key", "at", "n", F.substr("plain", F.col("at"), F.col("n")).alias("form"))
    hits = found.filter(F.length("form") == F.col("n")).join(known, "form", "left_semi")
    # a text's hits are bounded by its own length
    place = F.struct("at", (-F.col("n")).alias("less"))
    return hits.groupBy("key").agg(F.array_sort(F.collect_set(place)).alias("hits"))


def _cut_after(text: Column, start: Column, size: Column, hits: Column) -> Column:
    """"acme s.l. foo s.a." -> [acme s.l., foo s.a.], and what follows the last marker, of the part from ``start``."""
    end = start + size
    begin = F.struct(start.cast("int").alias("at"), F.array().cast("array<string>").alias("done"))
    tail = lambda s: F.concat(s["done"], F.array(F.substr(text, s["at"], end - s["at"])))

    def step(s: Column, h: Column) -> Column:
        name = F.regexp_replace(F.substr(text, s["at"], h["at"] - s["at"]), r"\s+$", "")
        piece = F.concat(name, F.lit(" "), F.substr(text, h["at"], -h["less"]))
        taken = F.struct((h["at"] - h["less"]).alias("at"), F.concat(s["done"], F.array(piece)).alias("done"))
        # at least one character stands before a marker, and it ends within the part
        return F.when((h["at"] > s["at"]) & (h["at"] - h["less"] <= end), taken).otherwise(s)

    return F.aggregate(hits, begin, step, tail)


def _trim_piece(c: Column) -> Column:
    edge = r"[-_ ,+]"
    bare = F.regexp_replace(c, rf"(?U)^(?:\s|{edge}|y(?=\s|{edge}|$))+", "")
    return F.regexp_replace(bare, rf"(?U)(?:\s|{edge}|(?<=\s|{edge}|^)y)+$", "")


def _tidy(pieces: Column) -> Column:
    kept = F.filter(pieces, lambda p: F.length(strip(p)) > 1)
    return F.filter(F.transform(kept, _trim_piece), lambda p: p != "")


def rule_pieces(texts: DataFrame, text: str, forms: DataFrame) -> DataFrame:
    """Adds ``_pieces``: the pieces by the written rules; null when none applies and a dictionary must decide.

    ``texts`` has a unique ``_id``.
    """
    c = F.col(text)
    none = F.array().cast("array<struct<at:int,less:int>>")
    hits = marker_hits(texts, "_id", text, forms).withColumnsRenamed({"key": "_id", "hits": "_hits"})
    marked = texts.join(hits, "_id", "left").withColumn("_hits", F.coalesce("_hits", none))
    # a delimiter right before a marker belongs to the marker
    before = F.transform("_hits", lambda h: h["at"] - 1)
    glued = F.array_distinct(F.filter(before, lambda i: (i > 0) & F.substr(c, i, F.lit(1)).rlike(DELIMITERS)))
    marked = marked.withColumn("_glued", glued)
    joined = F.aggregate("_glued", c, lambda t, i: F.overlay(t, F.lit(" "), i, F.lit(1)))
    over = lambda h: F.exists("_glued", lambda i: (h["at"] <= i) & (i < h["at"] - h["less"]))
    marked = stage(marked.withColumn("_joined", joined).withColumn("_hits", F.filter("_hits", lambda h: ~over(h))), "marked")
    # what can be new is a marker that holds one of the new spaces
    spaced = forms.filter(_spaced(F.col("form")).contains(" "))
    changed = marked.filter(F.size("_glued") > 0).select("_id", "_joined")
    new = marker_hits(changed, "_id", "_joined", spaced).withColumnsRenamed({"key": "_id", "hits": "_new"})
    whole = F.array_sort(F.array_union("_hits", F.coalesce("_new", none)))
    ready = marked.join(new, "_id", "left").withColumn("_hits", F.when(F.col("_new").isNull(), F.col("_hits")).otherwise(whole))
    # Fixed value: names of lots, which stay whole.
    protected = c.rlike(r"[a-zA-Z] - \d+ \S+|(?U:\b\w+\b) [a-zA-Z] - \d+")
    pieces = F.when(protected, F.array(c)).otherwise(_split_by_rules(F.col("_joined"), F.col("_hits")))
    return ready.select(*texts.columns, pieces.alias("_pieces"))


def _split_by_rules(text: Column, hits: Column) -> Column:
    marked = F.size(hits) > 0
    first = F.get(hits, 0)["at"]
    one_at_end = F.exists(hits, lambda h: (h["at"] == first) & (h["at"] - h["less"] == F.length(text) + 1))
    delimited = text.rlike(DELIMITERS)
    conjoined = text.rlike(r"(?U)\s+y\s+")
    by_delimiter = F.split(text, DELIMITERS)
    by_conjunction = F.split(text, r"(?U)\s+y\s+")
    at_end = F.when(delimited, by_delimiter).when(conjoined, by_conjunction).otherwise(F.array(text))
    begin = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<at:int,size:int>>").alias("parts"))
    add = lambda s, p: F.struct(
        (s["at"] + F.length(p) + 1).alias("at"),
        F.concat(s["parts"], F.array(F.struct(s["at"].alias("at"), F.length(p).alias("size")))).alias("parts"),
    )
    parts = F.aggregate(by_delimiter, begin, add, lambda s: s["parts"])
    inside = F.flatten(F.transform(parts, lambda p: _cut_after(text, p["at"], p["size"], hits)))
    unmarked = F.when(delimited, F.split(text, rf"(?U){DELIMITERS}|\s+y\s+")).when(conjoined, by_conjunction)
    return F.when(one_at_end, at_end).when(marked, inside).otherwise(unmarked)


def _span(ws: Column, start: Column, n: Column) -> Column:
    return F.array_join(F.slice(ws, start, n), " ")


def known_heads(known_names: DataFrame) -> DataFrame:
    """``level, head, lengths`` of ``known_names(gram)``: the first 2**level words of each name with at least so many.

    ``lengths`` are the numbers of words, below the next power of two, of the names with this head.
    """
    split = known_names.select(F.split("gram", " ").alias("ws")).withColumn("n", F.size("ws"))
    split = split.withColumn("top", F.floor(F.log2("n")).cast("int"))
    # the logarithm of an exact power must not fall below it
    split = split.withColumn("top", F.col("top") + (F.expr("shiftleft(1, top + 1)") <= F.col("n")).cast("int"))
    levels = split.select("ws", "n", "top", F.explode(F.sequence(F.lit(0), F.col("top"))).alias("level"))
    head = _span(F.col("ws"), F.lit(1), F.expr("shiftleft(1, level)"))
    own = F.when(F.col("level") == F.col("top"), F.col("n"))
    return levels.groupBy("level", head.alias("head")).agg(F.collect_set(own).alias("lengths"))


def dictionary_hits(names: DataFrame, text: str, dictionary: DataFrame, known: str) -> DataFrame:
    """Word n-grams of ``text`` that equal a known name: ``<names columns>, at, gram``.

    A chain of joins on prefixes: a span grows from 1 word to 2, 4, 8 ... only while its
    words begin some known name, and is written out only at the lengths that names with
    this beginning have. One very long known name lengthens no other span. ``at`` numbers
    the first word from 0; hits of one place come once for each length.
    """
    known_names = stage(dictionary.select(F.col(known).alias("gram")).filter("gram <> ''").distinct(), "known")
    heads = stage(known_heads(known_names), "heads")
    top = heads.agg(F.max("level")).first()[0]
    own = [F.col(c) for c in names.columns]
    split = names.select(F.struct(*own).alias("_own"), words(F.col(text)).alias("_ws"))
    spans = split.select("_own", "_ws", F.posexplode("_ws").alias("_at", "_head")).withColumn("_lengths", F.array().cast("array<int>"))
    for level in range((-1 if top is None else top) + 1):
        here = heads.filter(F.col("level") == level).select(F.col("head").alias("_head"), F.col("lengths").alias("_more"))
        # from the second level on a span that begins no longer name keeps the lengths it has, and a null head
        spans = spans.join(here, "_head", "inner" if level == 0 else "left")
        room = F.size("_ws") - F.col("_at") >= F.lit(2 << level)
        longer = F.when(F.col("_more").isNotNull() & room, _span(F.col("_ws"), F.col("_at") + 1, F.lit(2 << level)))
        lengths = F.concat("_lengths", F.coalesce("_more", F.array().cast("array<int>")))
        spans = spans.select("_own", "_ws", "_at", longer.alias("_head"), lengths.alias("_lengths"))
    ends = spans.select("_own", "_ws", "_at", F.explode("_lengths").alias("_n")).filter(F.size("_ws") - F.col("_at") >= F.col("_n"))
    grams = ends.select("_own", F.col("_at").alias("at"), _span(F.col("_ws"), F.col("_at") + 1, F.col("_n")).alias("gram"))
    return grams.join(known_names, "gram", "left_semi").select("_own.*", "at", "gram")


def split_consortium(
    names: DataFrame,
    name: str,
    dictionary: DataFrame | None = None,
    known: str = "FullName",
    markers: Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """One row per distinct ``name`` with its ``pieces`` (array of member names).

    ``markers`` are the legal forms that end a member's name: a list, or a table with a
    column ``form`` of any size. Names no written rule can split are looked up word by
    word in ``dictionary``: one hit keeps it and the remaining words, several hits are the
    members, none keeps the name whole.
    """
    forms = markers if isinstance(markers, DataFrame) else _forms(names.sparkSession, markers or default_markers())
    distinct = names.select(name).filter(F.col(name).isNotNull()).distinct()
    texts = distinct.select(name, strip_boilerplate(F.col(name)).alias("_text"), F.monotonically_increasing_id().alias("_id"))
    texts = stage(texts, "texts")
    ruled = rule_pieces(texts, "_text", forms)
    if dictionary is None:
        return ruled.select(name, _tidy(F.coalesce("_pieces", F.array("_text"))).alias("pieces"))
    ruled = stage(ruled, "ruled")
    open_names = ruled.filter(F.col("_pieces").isNull()).select(name, "_text")
    # a name's hits are n-grams of that one name, so the list is bounded by its own words
    hits = (
        dictionary_hits(open_names, "_text", dictionary, known)
        .groupBy(name)
        .agg(F.sort_array(F.collect_list(F.struct("at", "gram"))).alias("_hits"))
    )
    grams = F.transform("_hits", lambda h: h["gram"])
    first = F.get(grams, 0)
    looked_up = (
        F.when(F.col("_hits").isNull(), F.array("_text"))
        .when(F.size("_hits") == 1, F.array(first, word_difference(F.col("_text"), first)))
        .otherwise(grams)
    )
    resolved = open_names.join(hits, name, "left").withColumn("_pieces", looked_up).select(name, "_pieces")
    done = ruled.filter(F.col("_pieces").isNotNull()).select(name, "_pieces")
    return done.unionByName(resolved).select(name, _tidy(F.col("_pieces")).alias("pieces"))
