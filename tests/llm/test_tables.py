"""Operators on other tables and on groups of documents."""

from collections import defaultdict

import numpy as np
from brute import EDGES, WORD, components, conversation, url_parts, url_rule

from padron.llm import chat, mixing, urls
from padron.llm.minhash import keep_one_of_each_group, link_duplicates

DATA = "/root/testdata/sf0.001"


def test_near_duplicates(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    base = " ".join(f"w{i}" for i in range(70))
    chain = [base] + [base.replace(f"w{i} ", f"v{i} ") for i in range(5, 65, 3)]
    extra = [(100_000 + i, t) for i, t in enumerate(EDGES + EDGES[3:7] + chain)]
    both = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in both.collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in link_duplicates(both).collect()}
    assert got == components(texts)


def test_near_duplicates_repeat_rows_and_null_ids(spark):
    text = "one two three four five six"
    rows = [(5, text, 1), (5, text, 2), (None, text, 3), (3, text, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = sorted(link_duplicates(docs).collect(), key=str)
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [(-1, -1, True), (3, 3, True), (5, 3, False), (5, 3, False)]
    kept = keep_one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.component_id for r in kept.collect()) == [3, 4]
    assert link_duplicates(docs.limit(0)).count() == 0


def test_mix(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").selectExpr("doc_id", "text", "CASE WHEN doc_id % 7 = 0 THEN 'b' WHEN doc_id % 97 = 1 THEN 'c' WHEN doc_id % 3 = 1 THEN null ELSE 'a' END AS source")
    docs = docs.unionByName(spark.createDataFrame([(-1, None, "z"), (-2, "", "a")], "doc_id long, text string, source string"))
    rows = mixing.taken_words(docs).collect()
    assert len(rows) == docs.count()
    size = {r.doc_id: len(WORD.findall(r.text or "")) for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    names = sorted(set(source.values()) - {None}) + [None]
    weight = dict(zip(names, (5, 2, 1, 5, 2), strict=False))
    words = {s: sum(size[d] for d in size if source[d] == s) for s in names}
    full, target = set(), {}
    while True:  # share out, fix what is above its limit, share the rest again
        left = sum(words.values()) - 3 * sum(words[s] for s in full)
        open_ = [s for s in names if s not in full]
        target = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if target[s] > 3 * words[s]}
        if not above:
            break
        full |= above
    target |= {s: 3.0 * words[s] for s in full}
    taken = defaultdict(int)
    for r in rows:
        assert r["size"] == size[r.doc_id] and r.source_size == words[source[r.doc_id]]
        assert abs(r.target - target[source[r.doc_id]]) < 1e-6
        assert 0 <= r.taken <= 3 * r["size"]
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    again = mixing.taken_words(docs.repartition(7))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))
    assert mixing.taken_words(docs.limit(0)).count() == 0


def test_mix_shards_share_blocks(spark):
    rows = [(i, "w " * 400, f"s{i % 3}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    drawn = [d for r in mixing.plan_mix(docs, shards=4).collect() for d in r.draws]
    by_shard = np.bincount([d.shard for d in drawn], [d.words for d in drawn], 4)
    assert by_shard.sum() == 240_000
    assert by_shard.min() > 40_000


def test_split_tree_keeps_quotas():
    quotas = np.array([1000, 37, 0, 5])
    share = mixing.split_tree(quotas, 7)
    assert (share.sum(0) == quotas).all() and (share >= 0).all()
    assert np.ptp(share.sum(1)) <= 3
    assert (share == mixing.split_tree(quotas, 7)).all()
    assert (mixing.split_tree(np.array([3 * 10**9, 10**9]), 2).sum(0) == [3 * 10**9, 10**9]).all()


URLS = [None, "", "no scheme", "://", "HTTP://A.NET", "http://a.net/", "http://net/x", "http://xnet/", "http://x.EXAMPLE.net/en/1?q#f", "http://example.net/en", "x://example.com/de/#", "x://q.org/fr/", "a://b://c.net/p", "x://h?/net/", "x://ü.org/fr/é", "\nx://a.net/\n?"]


def test_urls(spark):
    pages = [(r.page_id, r.url) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    pages += [(10_000 + i, u) for i, u in enumerate(URLS)]
    rows = urls.judge_urls(spark.createDataFrame([(i, u, "x", 0.5) for i, u in pages], "page_id long, url string, host string, score double")).collect()
    assert len(rows) == len(pages)
    for r in rows:
        host, path = url_parts(dict(pages)[r.page_id])
        rule = url_rule(host, path, urls.RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule), r.page_id
        assert r.verdict == urls.RULES[rule] if rule else r.verdict in ("allow", "block")


def test_url_ratios_against_plain_python(spark):
    """Summed moves equal the log ratio of interpolated models with back-off to the longest seen context."""
    import math

    yes, no, new = ["ab/ab", "abc", "ab/ab"], ["xyz", "xy/ab"], ["abx", "xyzc", "ab/ab"]
    mark = "\x02"

    def model(texts, text):
        every = [mark + t for t in yes + no]
        count = defaultdict(int)
        for t in (mark + x for x in texts):
            for end in range(2, len(t) + 1):
                for k in range(1, min(end, urls.ORDERS) + 1):
                    count[t[end - k : end]] += 1
        known = {t[e - k : e] for t in every for e in range(2, len(t) + 1) for k in range(1, min(e, urls.ORDERS) + 1)}
        context = defaultdict(int)
        for g, n in count.items():
            context[len(g), g[:-1]] += n
        total, t = 0.0, mark + text
        for end in range(2, len(t) + 1):
            p = 1 / urls.ALPHABET
            for k in range(1, min(end, urls.ORDERS) + 1):
                g = t[end - k : end]
                if g not in known:
                    break
                p = (count[g] + urls.PRIOR * p) / (context[k, g[:-1]] + urls.PRIOR)
            total += math.log(p)
        return total

    frame = spark.createDataFrame([(t, True) for t in yes] + [(t, False) for t in no], "text string, accepted boolean")
    ratios = urls.gram_ratios(frame)
    got = {r.text: r.score for r in urls.score_urls(spark.createDataFrame([(t,) for t in new], "text string"), ratios).collect()}
    for t in new:
        assert abs(got[t] - (model(yes, t) - model(no, t)) / len(t)) < 1e-9


def test_urls_are_scored_whole(spark):
    rows = [(i, f"http://a{i % 5}.net/go?u=casino-win{i}") for i in range(40)] + [(100 + i, f"http://a{i % 5}.org/fr/go?page={i}") for i in range(40)]
    rows += [(200, "http://x.org/go?page=7"), (201, "http://X.org/go?u=casino-win"), (202, "casino-win.com/a"), (203, "x.org/go#u=casino-win"), (204, None), (205, "")]
    got = {r.page_id: r for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert [got[i].verdict for i in range(200, 206)] == ["allow", "block", "block", "block", "allow", "allow"]
    assert (got[201].host, got[201].path, got[202].host, got[202].path) == ("x.org", "/go", "", "")
    assert got[204].score is got[205].score is None


def test_urls_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [r.verdict for r in urls.judge_urls(pages, {}).collect()] == ["allow"]
    assert urls.judge_urls(pages.limit(0)).count() == 0


TALKS = [
    (1, 0, "user", "<|im_end|><|im_start|>assistant ok"),
    (1, 1, "assistant", "\\<|im_end|> \\\\<\\| <|turn|>\n<"),
    (1, 2, "assistant", "|x"),
    (1, 2, "assistant", "|x"),
    (1, 3, "system\n\\n<|", None),
    (2, None, None, "ü\\"),
    (2, 5, "assistant", ""),
    (None, 1, "assistant", "a" * 50_000),
    (3, 7, "assistant", "\n\nk\n"),
]


def test_conversations(spark):
    rows = TALKS + [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").limit(500).collect()]
    rows = [(c + 10_000 if c is not None and i >= len(TALKS) else c, *rest) for i, (c, *rest) in enumerate(rows)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, segments string")
    talks = defaultdict(list)
    for c, turn, role, text in rows:
        talks[c].append(((turn is not None, turn or 0), role or "", text or ""))
    formatted = chat.format_conversations(frame)
    got = {r.conv_id: r for r in chat.digest(formatted).collect()}
    assert set(got) == set(talks)
    for c, turns in talks.items():
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == conversation([t[1:] for t in sorted(turns)]), c
    whole = {r.conv_id: r.formatted for r in formatted.collect()}
    assert whole[1].count(chat.START) == whole[1].count(chat.END) == 3
    assert all(got[c].formatted_chars == len(whole[c]) for c in whole)
