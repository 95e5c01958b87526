"""The corpus operators against plain Python on small tables: nulls, empty texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from furlong.llm import bpe, decontamination, langid, resampling, rules, simhash, substring, token_counts, toxicity, url_filter
from furlong.llm.queries import QUERIES

WORDS = [a + b for a in ("th", "on", "re", "be", "ka", "lu", "mi") for b in ("er", "ing", "at", "o", "es", "und")]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, d long, t int, fp string, words string"


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    passage, base = text(rng, 60), text(rng, 120)
    texts = [text(rng, rng.randint(1, 150)) for _ in range(25)] + [f"{text(rng, 20)} {passage} {text(rng, 20)}" for _ in range(6)]
    texts += [base] * 3 + [base + " extra", base.upper(), "Des. " * 40, "a\tb\n c ", "", " \n ", None, None, "x", "ab cd", text(rng, 3000)]
    return [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[5]), (None, None)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    # Columns named like the operators' own.
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 1, "x", "y") for i, t in corpus], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def split(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.mark.parametrize("hot", [1, 50_000])
def test_substrings(docs, corpus, hot):
    seen = Counter(tuple(w[k : k + 35]) for _, t in corpus for w in [split(t)] for k in range(len(w) - 34))
    want = []
    for i, t in corpus:
        w = split(t)
        gone = {j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(k, k + 35)}
        want.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring.remove_repeats(docs, hot=hot).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_fm_index_finds_repeated_windows():
    rng = random.Random(1)
    for _ in range(60):
        segments = [[rng.randint(1, 3) for _ in range(rng.randint(4, 14))] for _ in range(rng.randint(1, 6))]
        width = rng.randint(2, 5)
        seen = Counter(tuple(s[i : i + width]) for s in segments for i in range(len(s) - width + 1))
        want = {(k, i) for k, s in enumerate(segments) for i in range(len(s) - width + 1) if seen[tuple(s[i : i + width])] > 1}
        bounds = np.concatenate(([0], np.cumsum([len(s) for s in segments])))
        found = substring.repeated(np.array([x for s in segments for x in s], np.uint64), bounds, width)
        assert {(int(k), i) for k, a, b in zip(*found, strict=True) for i in range(a, b + 1)} == want


def fingerprint(t):
    w = (t or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs, corpus):
    prints = [fingerprint(t) for _, t in corpus]
    parent = list(range(len(prints)))

    def find(a):
        return a if parent[a] == a else find(parent[a])

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                parent[find(a)] = find(b)
    low = {}
    for a, (i, _) in enumerate(corpus):
        low.setdefault(find(a), []).append(i)
    want = [(i, prints[a], min((x for x in low[find(a)] if x is not None), default=None)) for a, (i, _) in enumerate(corpus)]
    got = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.components(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_trees_miss_no_pair(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
    near = x[:200] ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (3, 200), dtype=np.uint64))
    every = np.unique(np.concatenate((x, near)))
    monkeypatch.setattr(simhash, "SHARD", 32)
    frame = spark.createDataFrame([(int(v),) for v in every.view(np.int64)], "fp long")
    root = {r.node: r.root for r in simhash.connected(simhash.links(frame)).collect()}
    signed = {int(v): int(np.uint64(v).view(np.int64)) for v in every}
    for a in every:
        for b in every[np.bitwise_count(every ^ a) <= 3]:
            assert root.get(signed[int(a)], signed[int(a)]) == root.get(signed[int(b)], signed[int(b)])


def test_encoding_equals_the_library(docs, corpus):
    import public_tokenizers as P
    import tiktoken

    ours = bpe.load(bpe.VOCABULARY)
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ours.ranks, special_tokens={})
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs).collect()]
    want = []
    for i, t in corpus:
        ids = theirs.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_joins_of_the_tree_stand(monkeypatch):
    import public_tokenizers as P
    import tiktoken

    ours = bpe.load(bpe.VOCABULARY)
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ours.ranks, special_tokens={})
    monkeypatch.setattr(bpe, "LEAF_CHARS", 8)
    rng = random.Random(3)
    parts = ["a", "the", "'ll", "'", " ", "  ", "\n", "\t", "é", "中", "12", "!", "🙂", "x" * 30, "ab" * 40, " " * 50, "\x1c", "\x85", "\xa0", " ", "²", "Ⅷ"]
    for _ in range(400):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        assert ours.encode(t) == theirs.encode_ordinary(t)
        assert ours.decode(ours.encode(t)) == t.encode()
    for t in ("a" * 5000, "the" * 3000, "é中" * 2000, "".join(rng.choice("eta") for _ in range(5000))):
        assert ours.encode(t) == theirs.encode_ordinary(t)


def test_token_counts(docs, corpus):
    ours = bpe.load(bpe.VOCABULARY)
    n = [len(ours.encode(t or "")) for _, t in corpus]
    sums = token_counts.suffix_sums(token_counts.length_histogram(docs)).persist()
    for r in sums.collect():
        assert r.n_docs == n.count(r.n_tokens) and r.docs_longer == sum(x > r.n_tokens for x in n)
        assert r.tokens_longer == sum(x for x in n if x > r.n_tokens) and r.truncated_total == sum(min(x, r.n_tokens) for x in n)
    limits = [1, 7, 100, 10**6]
    assert {r.limit: r.truncated_total for r in token_counts.total_at(sums, limits).collect()} == {k: sum(min(x, k) for x in n) for k in limits}
    assert token_counts.quantile(sums, 0.5).first()[0] == sorted(n)[-(-len(n) // 2) - 1]


def test_rules_base_counts(docs, corpus):
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rules.judge(docs, rules.fit(np.zeros(0, int), np.zeros(0, np.int32), np.zeros(0, int))).collect()]
    want = []
    for i, t in corpus:
        w, seen, dup = split(t), set(), 0
        for line in (t or "").split("\n"):
            if split(line):
                dup += line in seen
                seen.add(line)
        c = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        again = {j for k in range(len(w) - 4) if c[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
        want.append((i, len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t or ""), dup, len(again), len(w) < 10 or 100 * len(again) > 20 * len(w)))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_viterbi_takes_the_best_path():
    rng = np.random.default_rng(2)
    crf = rules.Crf(rng.normal(size=rules.N_FEATURES), rng.normal(size=(2, 2)))
    doc = np.repeat(np.arange(20), rng.integers(1, 7, 20))
    features = rng.integers(0, 1 << rules.N_FEATURES, len(doc)).astype(np.int32)
    label = crf.decode(doc, features)
    for d in range(20):
        e = crf.scores(features[doc == d])
        paths = [[(k >> i) & 1 for i in range(len(e))] for k in range(1 << len(e))]
        value = [sum(x for x, y in zip(e, p, strict=True) if y) + sum(crf.t[a, b] for a, b in zip(p, p[1:], strict=False)) for p in paths]
        assert label[doc == d].tolist() == paths[int(np.argmax(value))]


def test_lines_of_a_mixed_page_have_their_own_labels(spark):
    rng = np.random.default_rng(4)
    words = "the river ran slowly past old houses while people walked along its green bank and talked about their long day".split()
    prose = lambda: " ".join(rng.choice(words, 15)).capitalize() + "."
    menu = lambda: " | ".join(rng.choice(["Home", "Login", "Shop", "Help", "Cart"], 3))
    rows = [("\n".join(prose() for _ in range(6)), 1) for _ in range(40)] + [("\n".join(menu() for _ in range(6)), 0) for _ in range(40)]
    crf = rules.train(spark.createDataFrame(rows, "text string, label int"))
    page = "\n".join([*(menu() for _ in range(5)), *(prose() for _ in range(9)), *(menu() for _ in range(4))])
    _, _, block = next(rules.blocks(pa.array([page])))
    lines = rules.lines_of(block)
    assert crf.decode(lines.doc, lines.features).tolist() == [0] * 5 + [1] * 9 + [0] * 4
    texts = [page, rows[0][0], rows[-1][0], None, ""]
    got = rules.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), crf).orderBy("doc_id").collect()
    assert [r.kept for r in got] == [True, True, False, False, False]
    content = sum(len(x.split()) for x in page.split("\n")[5:14])
    assert got[0].content_share == pytest.approx(content / len(page.split()))


def test_kernel_is_the_sum_over_subsequences():
    from itertools import combinations

    a, b, p = "abacb", "aabc", 3
    want = sum(toxicity.DECAY ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1) for i in combinations(range(5), p) for j in combinations(range(4), p) if [a[x] for x in i] == [b[x] for x in j])
    codes, lengths = toxicity._codes([a])
    assert toxicity.kernel(codes, lengths, np.array([ord(c) for c in b], np.uint32), p)[0] == pytest.approx(want)


def test_urls(spark):
    at = lambda s: F.to_timestamp(F.lit(s))
    entries = spark.createDataFrame([("bad.org", "add", "2024-01-05"), ("bad.org", "remove", "2024-02-01"), ("bad.org", "remove", "2024-02-03"), ("x.bad.org", "add", "2024-03-01"), (None, "add", "2024-01-01"), ("bad.org", None, "2024-01-01"), ("bad.org", "add", None)], "pattern string, action string, day string").withColumn("at", F.to_timestamp("day"))
    pages = [("http://bad.org/a", "2024-01-04", False), ("http://BAD.org:80/a", "2024-01-05", True), ("https://x.bad.org?q", "2024-01-31", True), ("http://x.bad.org", "2024-02-01", False), ("http://x.bad.org", "2024-03-02", True), ("http://notbad.org", "2024-01-10", False), (None, "2024-01-10", False), ("http://bad.org", None, False), ("http://bad.org/a", "2024-01-04", False)]
    frame = spark.createDataFrame(pages, "url string, day string, want boolean").withColumn("fetched_at", F.to_timestamp("day")).withColumn("host", F.lit(1))
    got = url_filter.evaluate(frame, entries).collect()
    assert len(got) == len(pages) and all(r.blocked == r.want for r in got)
    assert url_filter.evaluate(frame, entries.where(at("2024-01-01").isNull())).where("blocked").isEmpty()


def test_hosts(spark):
    urls = {
        "http://user@bad.org/": "bad.org", "http://a:b@c@Bad.org:80/x@y": "bad.org", "http://[2001:DB8::1]:8080/a": "[2001:db8::1]", "https://bad.org./": "bad.org", "http://bad.org.:80": "bad.org",
        "http://bad.org\\x": "bad.org", " HTTP://bad.org?q=@z": "bad.org", "http:///a": "", "bad.org/a": "", "": "", None: "", "http://10.0.0.1/": "10.0.0.1", "http://@": "",
    }
    got = {r.url: r.host for r in spark.createDataFrame([(u,) for u in urls], "url string").select("url", url_filter.host_of("url").alias("host")).collect()}
    assert got == urls
    entries = spark.createDataFrame([("0.1", "add"), ("10.0.0.1", "add"), ("bad.org", "add")], "pattern string, action string").withColumn("at", F.to_timestamp(F.lit("2024-01-01")))
    pages = spark.createDataFrame([("http://10.0.0.1/", "10.0.0.1"), ("http://u@x.bad.org./", "bad.org"), ("http://9.0.0.1/", None), ("http://[2001:db8::1]/", None)], "url string, want string")
    assert all(r.pattern == r.want for r in url_filter.evaluate(pages.withColumn("fetched_at", F.to_timestamp(F.lit("2024-01-02"))), entries).collect())


def test_lcs():
    rng = np.random.default_rng(1)
    a = [rng.integers(0, 5, n).astype(np.uint64) for n in (1, 8, 64, 70, 30)]
    b = [rng.integers(0, 5, n).astype(np.uint64) for n in (0, 20, 90, 40, 1)]

    def plain(x, y):
        row = [0] * (len(y) + 1)
        for v in x:
            new = [0]
            for j, w in enumerate(y):
                new.append(row[j] + 1 if v == w else max(row[j + 1], new[-1]))
            row = new
        return row[-1]

    assert decontamination.common_length(a, b).tolist() == [plain(x.tolist(), y.tolist()) for x, y in zip(a, b, strict=True)]


def test_leaks(spark):
    rng = random.Random(8)
    rare = [f"{a}{b}{c}" for a in WORDS[:20] for b in WORDS[20:] for c in ("", "x", "q")]
    item = [" ".join(rng.choice(rare) for _ in range(30)) + ". " + " ".join(rng.choice(rare) for _ in range(6)) for _ in range(5)]
    clean = [" ".join(rng.choice(rare) for _ in range(rng.randint(5, 200))) for _ in range(60)]
    changed = item[1].split()
    for k in range(2, 36, 9):
        changed[k] = "other"
    texts = [*clean, f"{clean[0]} {item[0].upper()} {clean[1]}", f"{clean[2]} {' '.join(changed)}", None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame([*enumerate(item), (9, None), (10, ""), (None, "x")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontamination.leaks(frame, benchmark).collect()) == [(60, 0), (61, 1)]
    assert decontamination.leaks(frame, benchmark.limit(0)).isEmpty() and decontamination.leaks(frame.limit(0), benchmark).isEmpty()


def brute_force(texts, items):
    """Every passage of every text against every item by the words alone."""
    one = lambda t: next(decontamination._blocks(decontamination.pa.array([t])))[2].hash.copy()
    found = set()
    for i, item in enumerate(items):
        words = one(item)
        for d, w in enumerate(one(t) for t in texts):
            near = [w[max(0, a - len(words)) : a + 32 + len(words)] for a in range(0, max(1, len(w) - 16), 16)]
            share = decontamination.common_length([words] * len(near), near) / len(words)
            answer = decontamination.common_length([words[-8:]] * len(near), near) / len(words[-8:])
            if np.any((share >= 0.7) & (answer >= 0.5) | (share >= 0.55) & (answer >= 0.8)):
                found.add((d, i))
    return found


def planted(rng, vocabulary, sizes, edits, length):
    """Texts of which each holds an item with a share of its words changed, and the items."""
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [some(n) for n in sizes]
    texts = [some(length) + [rng.choice(vocabulary) if rng.random() < edit else w for w in item] + some(length) for edit in edits for item in items]
    return [" ".join(t) for t in texts], [" ".join(t) for t in items]


def found_leaks(spark, texts, items):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontamination.leaks(frame, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}


def test_leaks_of_common_words(spark):
    # Every word stands in nearly every document.
    texts, items = planted(random.Random(2), WORDS, [30, 24, 40, 30, 70], [0, 0.1, 0.2, 0.3, 0.4, 1, 1], 300)
    want = brute_force(texts, items)
    assert {(k, k) for k in range(5)} <= want and found_leaks(spark, texts, items) == want


@pytest.mark.parametrize("size", [14, 40])
def test_leaks_of_edited_items(spark, size):
    rare = [f"{a}{b}{c}" for a in WORDS for b in WORDS for c in ("", "x")]
    texts, items = planted(random.Random(size), rare, [size] * 40, [0, 0.15, 0.28], 60)
    want = brute_force(texts, items)
    assert len(want) > 90 and found_leaks(spark, texts, items) == want


def test_leaks_of_many_short_edited_items(spark):
    rng = random.Random(3)
    often = WORDS * 4 + [f"{a}{b}" for a in WORDS for b in WORDS[:12]]
    texts, items = planted(rng, often, [14] * 250, [0.28], 40)
    want = {(k, k) for k in range(250) if brute_force([texts[k]], [items[k]])}
    assert len(want) > 60 and want <= found_leaks(spark, texts, items)


def test_languages(spark, docs, empty):
    rng = random.Random(4)
    lang = {"en": ["the", "thing", "other", "with"], "de": ["nicht", "und", "schön", "zeit"]}
    rows = [(i, " ".join(rng.choice(lang[k]) for _ in range(30)), k) for i, k in enumerate(["en", "de"] * 40)]
    filters = langid.train(spark.createDataFrame([*rows, (99, None, "en"), (98, "the", None)], "doc_id long, text string, lang string"))
    asked = spark.createDataFrame([(1, "other thing the"), (2, "ZEIT UND schön"), (3, None), (4, ""), (5, "123 !?"), (6, "漢字")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(asked, filters).collect()}
    assert got[1][0] == "en" and got[2][0] == "de" and all(got[i] == ("und", 0.0) for i in (3, 4, 5)) and got[6] == ("de", 0.5)
    assert {r.lang_pred for r in langid.predict(asked, langid.train(empty)).collect()} == {"und"}


def test_rare_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "TRAIN_ROWS", 300)
    rng, letters = random.Random(6), "abcdefghijklmnopqrstuvwxyz"
    words = {f"l{k:02}": ["".join(rng.choice(letters) for _ in range(6)) for _ in range(12)] for k in range(70)}
    say = lambda k: " ".join(rng.choice(words[k]) for _ in range(12))
    rows = [(say(k), k) for i, k in enumerate(words) for _ in range(3000 if i == 0 else 9)]
    filters = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    asked = spark.createDataFrame([(i, say(k)) for i, k in enumerate(words)], "doc_id long, text string")
    assert [r.lang_pred for r in langid.predict(asked, filters).orderBy("doc_id").collect()] == list(words)


def test_resampling_keeps_the_share(docs, corpus):
    got = resampling.resample(docs, docs.where("doc_id < 10")).collect()
    cut = sorted((r.key for r in got), reverse=True)[-(-3 * len(corpus) // 4) - 1]
    assert len(got) == len(corpus) and all(r.kept == (r.key >= cut) for r in got)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_take_empty_tables(spark, tmp_path, name):
    for table in ("documents", "labels", "benchmark", "pages", "embeddings"):
        spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0


def test_toxicity_on_held_out_rows(spark):
    import corpus_pipeline  # noqa: F401

    got = QUERIES["op1_toxicity"](spark, "/root/testdata/sf0.01").where("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = got.join(labels, "doc_id").select("toxic", "score").collect()
    pos, neg = [r.score for r in rows if r.toxic == 1], [r.score for r in rows if r.toxic == 0]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg]) > 0.75


def test_filled_insults_keep_their_weight():
    marks = toxicity.Landmarks([f"{toxicity.HEAD}{w}{toxicity.TAIL}" for w in ("idiot", "moron", "scum", "imbecile")])
    forms = ["i.d.i.o.t", "m*o*r*o*n", "s.c.u.m", "i.m.b.e.c.i.l.e", "iiddiioott", "i-d-i-o-t!"]
    assert all(v is not None and v.max() > 0.9 for v in marks.vectors(forms))
    # Whatever has a common subsequence long enough has a value, however faint.
    faint = marks.vectors(["ixdxixoxt", "id*ot", "mxoxrxoxn"])
    assert all(v is not None and 0 < v.max() < 0.5 for v in faint)
    assert marks.vectors(["harmless"]) == [None]


def test_pipeline_stages_chain(spark):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (7, "", "en", "s", 0), (None, "the thing of the", "en", "s", 16), (None, "the thing of the", "en", "s", 16)], frame.schema)
    now = frame.union(odd)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, stage(spark, now, sf_dir).persist()
        assert now.columns == list(corpus_pipeline.COLUMNS) and 0 < now.count() <= before.count()
    assert now.where("text is null").isEmpty() and now.where("doc_id is null").count() <= 1
    last = corpus_pipeline.STAGES[-1][1](spark, now, sf_dir)
    assert last.count() == now.count()
