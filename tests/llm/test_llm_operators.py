"""The operators against plain versions, on small frames with the odd cases."""

import hashlib
import json
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetmill.llm import blocks, chat, common, decontamination, embedding_dedup, encoding, jaccard_join, packing, sharding, token_counts, token_files, toxicity, url_filter

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", str(r.randrange(50))]) for _ in range(n))


BASE = [prose(n, n) for n in (3, 4, 5, 8, 12, 20, 40, 60, 90, 150, 300)]
ODD = [None, "", "  \n ", "one", "One\ttwo", "%%% ###", "<|endoftext|> x<|startoftext|>", "É é ß ﬁ İ Σας", "a" * 5000, "x " * 3000]


def documents(spark, texts):
    rows = [(i, t, "own") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [(None, "null id", "own"), rows[3], rows[3]], "doc_id bigint, text string, n_tokens string")


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(1)
    near = []
    for t in BASE:
        for k in (0, 1, 2, 5):
            w = t.split()
            for _ in range(k):
                w[r.randrange(len(w))] = f"new{r.randrange(99)}"
            near.append(" ".join(w))
    near += [BASE[-1] + " tail", BASE[-1].upper(), BASE[5].replace(" ", "\n")]
    return documents(spark, ODD + near).cache()


def empty(df):
    return df.where("false")


@pytest.fixture(scope="module")
def word_library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(encoding.tokenizer_path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def byte_library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(encoding.tokenizer_path("byte_bpe_50k.json"))


def test_every_token_gives_itself(word_library, byte_library):
    """What the faster merge rests on, as the module says: all tokens that encode at all, of both vocabularies."""
    with open(encoding.tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    for token, i in vocabulary.items():
        if token.endswith("</w>"):
            assert [x.id for x in word_library.model.tokenize(token.removesuffix("</w>"))] == [i]
    with open(encoding.tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    for token, i in vocabulary.items():
        assert [x.id for x in byte_library.model.tokenize(token)] == [i]
    # A token without a word's end is inside words only: it is what its merges make of it, in a longer word.
    word = encoding.WordEncoder(encoding.tokenizer_path("word_bpe_49k.json"))
    signs = {s: bytes([b]) for b, s in encoding._byte_signs().items()}
    with open(encoding.tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as file:
        inner = [t for t in json.load(file)["model"]["vocab"] if not t.endswith("</w>") and all(c in signs for c in t)]
    for token in inner[::7]:
        raw = b"".join(signs[c] for c in token) + b"q"
        if raw.isalpha() and raw.isascii():
            assert word.word_ids(raw.decode().lower()) == word_library.encode(raw.decode().lower(), add_special_tokens=False).ids


def test_encoders_equal_the_library(word_library, byte_library):
    r = random.Random(3)
    made = ["".join(r.choice("abcdefgh éÉßñ.,;%0'’\n\t  <|>ÀΣ́中") for _ in range(r.randrange(80))) for _ in range(800)]
    texts = [t for t in ODD if t is not None] + BASE + made
    word = encoding.WordEncoder(encoding.tokenizer_path("word_bpe_49k.json"))
    byte = encoding.ByteEncoder(encoding.tokenizer_path("byte_bpe_50k.json"), encoding.tokenizer_path("byte_bpe_50k.tiktoken"))
    for text, ids in zip(texts, word.encode_batch(texts), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == word_library.encode(text, add_special_tokens=False).ids, text
        assert list(byte.encode(text)) == byte_library.encode(text, add_special_tokens=False).ids, text


def test_packing(spark, docs, byte_library):
    parts = packing.pieces(docs, encoding.tokenizer_path("byte_bpe_50k.json"), encoding.tokenizer_path("byte_bpe_50k.tiktoken"), length=256)
    out = packing.pack(parts, length=256, cell_pieces=20).collect()
    by_doc = {}
    for r in docs.select("doc_id", "text").distinct().collect():
        by_doc[r.doc_id] = byte_library.encode(r.text or "", add_special_tokens=False).ids + [0]
    for r in out:
        ids = np.array(by_doc[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(ids) == r.length <= 256 and zlib.crc32(ids.tobytes()) == r.ids_crc32
        assert r.piece == 0 or r.length == 256
    assert sum(r.length for r in out) == sum(len(by_doc[r.doc_id]) for r in docs.collect())
    at = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
        assert at[r.sequence_id] <= 256
    assert packing.pack(empty(parts)).count() == 0


def test_local_search_empties_bins():
    r = random.Random(5)
    for _ in range(30):
        sizes = [r.randrange(1, 101) for _ in range(80)]
        start = [[i] for i in range(80)]  # a poor packing
        before = sum(sizes[i] ** 2 for i in range(80))
        bins = packing.local_search(sizes, [list(b) for b in start], 100)
        assert sorted(i for b in bins for i in b) == list(range(80))
        fills = [sum(sizes[i] for i in b) for b in bins]
        assert max(fills) <= 100 and sum(f * f for f in fills) > before and len(bins) < 60
    assert len(packing.local_search([50, 50, 30, 70], [[0, 2], [1], [3]], 100)) == 2  # an exchange is needed
    assert packing.best_fit([]) == []
    big = [r.randrange(700, 1500) for _ in range(3000)]
    before = packing.best_fit(big, 2048)
    after = packing.local_search(big, before, 2048)
    assert sorted(i for b in after for i in b) == list(range(3000)) and len(after) <= len(before)
    assert max(sum(big[i] for i in b) for b in after) <= 2048


def brute_jaccard(rows, percent=85):
    sets = []
    for _, text in rows:
        w = [] if text is None else text.encode().lower().split()
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} or ({tuple(w)} if w else set()))
    group = common.Sets(len(rows))
    for a in range(len(rows)):
        for b in range(a):
            x = len(sets[a] & sets[b])
            if x and 100 * x >= percent * (len(sets[a]) + len(sets[b]) - x):
                group.join(a, b)
    ids = [i for i, _ in rows]
    least = {}
    for k in range(len(rows)):
        if ids[k] is not None:
            least[group.root(k)] = min(least.get(group.root(k), ids[k]), ids[k])
    return sorted(((ids[k], len(sets[k]), least.get(group.root(k)) if sets[k] else ids[k]) for k in range(len(rows))), key=str)


@pytest.mark.parametrize("percent", [85, 60])
def test_jaccard_components(spark, docs, percent):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = jaccard_join.jaccard_components(docs, percent=percent)
    assert sorted(map(tuple, got.collect()), key=str) == brute_jaccard(rows, percent)


def rooted(edges, ids):
    group = {i: i for i in ids}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in edges:
        group[max(root(a), root(b))] = min(root(a), root(b))
    return root


@pytest.mark.parametrize("frequent", [1000, 3])
def test_jaccard_pairs_and_lists_agree(spark, docs, frequent, monkeypatch):
    """Whatever the boundary and the order, all links are within candidate groups."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    every = jaccard_join.sketches(docs).withColumn("id", F.monotonically_increasing_id()).cache()
    marks = every.where("n > 0").dropDuplicates(["key"]).cache()
    marks.count()
    sets = {r.id: set(jaccard_join.shingles(r.text).tolist()) for r in marks.join(docs.select("text", *jaccard_join.text_hashes("text")).distinct(), ["t1", "t2"]).collect()}
    links = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    buckets = [r.bucket for r in jaccard_join.frequent(every).collect()]
    assert bool(buckets) == (frequent == 3)
    with common.Scratch(spark) as scratch:
        ordered = jaccard_join.ordered(marks, docs, buckets, scratch, "text", 4, 85).cache()
        assert ordered.where("cold < size(prefix)").isEmpty() == (frequent != 3)
        for bound in (0, 3, 16):
            for block in (256, 2):  # short lists, or all of them split
                root = rooted([(r.a, r.b) for r in jaccard_join.candidates(ordered, bound, scratch, block=block).collect()], sets)
                assert all(root(a) == root(b) for a, b in links)


@pytest.mark.parametrize("frequent", [1000, 5])
def test_jaccard_blocks(spark, monkeypatch, frequent):
    """A group of many blocks: copies of one text with some words changed each, and texts that share a passage only."""
    monkeypatch.setattr(jaccard_join.verified, "__defaults__", (85, 4, 7))
    monkeypatch.setattr(jaccard_join.candidates, "__defaults__", (85, 5))
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    base, r, texts = prose(120, 9).split(), random.Random(2), []
    for k in range(60):
        w = list(base)
        for _ in range(k % 7):
            w[r.randrange(len(w))] = f"w{k}x{r.randrange(9)}"
        texts.append((k, " ".join(w)))
    texts += [(100 + k, prose(60, 500 + k) + " " + " ".join(base[:40])) for k in range(30)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(texts, "doc_id bigint, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute_jaccard(texts)


def test_frequent_shingles_do_not_depend_on_tasks(spark, monkeypatch):
    r = random.Random(8)
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(k, passage + " " + " ".join(f"w{r.randrange(10**6)}" for _ in range(160))) for k in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = [sorted(x.bucket for x in jaccard_join.frequent(jaccard_join.sketches(docs.repartition(n))).collect()) for n in (2, 60)]
    assert found[0] == found[1] and len(found[0]) >= 37
    # Without the counters' help, the passage's lists are long: they are split, and no unit is above two blocks.
    marks = jaccard_join.sketches(docs).where("n > 0").withColumn("id", F.monotonically_increasing_id())
    units = []
    dealt = jaccard_join.dealt
    monkeypatch.setattr(jaccard_join, "dealt", lambda rows, group, block: units.append(dealt(rows, group, block)) or units[-1])
    with common.Scratch(spark) as scratch:
        sets = scratch.write(jaccard_join.ordered(marks, docs, [], scratch, "text", 4, 85), "sets")
        edges = jaccard_join.candidates(sets, 0, scratch, block=100).collect()
        lists = next(p for p in scratch.paths if p.endswith("-lists"))
        members = spark.read.parquet(lists).groupBy("s").agg(F.count("*").alias("n"), F.max("members").alias("members")).collect()
        assert units and max(x["count"] for x in units[0].groupBy("s", "i", "j").count().collect()) < 300
    assert not edges and max(x.members for x in members) == 1200


def test_blocks_join_what_links(spark):
    """Centres, core and rest: the same components as all pairs, on chains, stars and dense groups."""
    r = random.Random(7)
    values = [(g, g * 1000 + k, x) for g in range(4) for k, x in enumerate([r.randrange(40 if g < 2 else 400) for _ in range(90 if g else 6)])]

    def near(unit, a, b):
        x = unit.column("x").to_numpy()
        return abs(x[a][:, None] - x[b][None, :]) <= 2

    members = {g: sum(v[0] == g for v in values) for g in range(4)}
    rows = spark.createDataFrame([(*v, members[v[0]]) for v in values], "grp bigint, id bigint, x bigint, members bigint")
    with common.Scratch(spark) as scratch:
        root = rooted([(e.a, e.b) for e in blocks.linked(rows, ["grp"], near, scratch, 10).collect()], [v[1] for v in values])
    want = rooted([(v[1], w[1]) for v in values for w in values if v[0] == w[0] and v[1] < w[1] and abs(v[2] - w[2]) <= 2], [v[1] for v in values])
    assert all(root(v[1]) == want(v[1]) for v in values)


def test_jaccard_of_an_empty_table(spark, docs):
    assert jaccard_join.jaccard_components(empty(docs)).count() == 0


@pytest.mark.parametrize(
    "made",
    [
        lambda k: F.struct((k > 2).alias("last"), k.alias("own"), F.monotonically_increasing_id().alias("row")),  # parts without nulls
        lambda k: F.timestamp_seconds(k),
        lambda k: F.struct(F.array(F.timestamp_seconds(k)).alias("times")),
        lambda k: F.concat(F.lit("é"), k),
    ],
)
def test_jaccard_ids_of_any_type(spark, made):
    """The counters' rows have the ids' type as it comes: with its parts' nulls, and in the session's zone."""
    a, b = prose(60, 1), prose(60, 2)
    rows = [(0, a), (1, a + " more"), (2, b), (3, None), (4, b), (5, "")]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        docs = spark.createDataFrame(rows, "k bigint, text string").coalesce(1).select(made(F.col("k")).alias("doc_id"), "text")
        ids = [r.doc_id for r in docs.collect()]
        got = jaccard_join.jaccard_components(docs).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sorted((ids.index(r.doc_id), r.n_shingles, ids.index(r.component_id)) for r in got) == brute_jaccard(rows)


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(5, 5), (None, 3)]
    group = common.Sets(200)
    for a, b in edges:
        if a is not None:
            group.join(a, b)
    with common.Scratch(spark) as scratch:
        got = {x.id: x.component for x in common.components(spark.createDataFrame(edges, "a bigint, b bigint"), scratch).collect()}
    assert all(c == group.root(i) for i, c in got.items()) and set(got) == {i for a, b in edges if a is not None and a != b for i in (a, b)}


def test_token_counts(spark, docs, word_library):
    got = token_counts.token_counts(docs, encoding.tokenizer_path("word_bpe_49k.json"), limit=50)
    want = sorted((str(r.doc_id), len((r.text or "").encode()), n := len(word_library.encode(r.text or "", add_special_tokens=False).ids), n > 50) for r in docs.collect())
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect()) == want
    found = token_counts.frequent_words(docs, F.col("text"))
    assert "alpha" in found and found[0] == "x" and token_counts.frequent_words(docs, F.col("text"), 3) == found[:3]
    assert token_counts.token_counts(empty(docs), encoding.tokenizer_path("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("slice_windows", [1_000_000, 40])
def test_decontamination(spark, docs, slice_windows):
    items = [(1, BASE[6]), (2, BASE[5] + " unseen"), (10, "one"), (11, None), (None, BASE[7]), (12, "!!"), (2, BASE[9]), (13, "İ")]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = decontamination.contamination(docs, spark.createDataFrame(items, "item_id bigint, text string"), keep=["doc_id"], slice_windows=slice_windows).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.n_hit > 0) for r in found), key=str)
    assert got == sorted(decontamination.brute_force(rows, items), key=str)
    none = decontamination.contamination(docs, spark.createDataFrame([], "item_id bigint, text string"))
    assert none.where("n_hit > 0").count() == 0 and none.count() == docs.count()


def test_items_that_share_windows(spark):
    line = "this prompt line of ten words is shared by every item"
    items = [(k, f"{line} number {k}") for k in range(400)] + [(1000, "Yes"), (1001, "yes"), (1000, "yes yes")]
    rows = [(k, f"yes a {line} yes {'number 7' if k % 3 else ''} b yes") for k in range(60)] + [(99, "yes " * 500), (100, ""), (101, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.contamination(docs, bench, keep=["doc_id"]).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.n_hit > 0) for r in found), key=str)
    assert got == sorted(decontamination.brute_force(rows, items), key=str)
    # A document's hits are a row a distinct window, and items that share windows are listed once a set.
    with common.Scratch(spark) as scratch:
        cut = scratch.write(decontamination.windows(bench.select(F.col("item_id").cast("string").alias("item"), "text")), "windows")
        digest = [F.bit_xor(F.xxhash64("item")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "item")).alias("y"), F.count("*").alias("z")]
        once = cut.distinct().groupBy("size", "hash", "window").agg(*digest)
        lists = {frozenset(r.of) for r in decontamination._item_lists(cut, once).collect()}
    assert frozenset(str(k) for k in range(400)) in lists and len(lists) <= 403


def test_long_texts_and_clashing_columns_in_decontamination(spark):
    long = "word " * 300_000 + "a b c d e f g h i j"
    docs = spark.createDataFrame([(1, long, 5, "x"), (2, "", 6, "y")], "doc_id bigint, text string, n_hit int, size string")
    got = {r.doc_id: r for r in decontamination.contamination(docs, spark.createDataFrame([(1, "A b c d e f g h i j")], "item_id bigint, text string")).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].spans[0].low, got[1]["size"]) == (300_010, 10, 300_000, "x")
    assert (got[2].n_words, got[2].n_hit, got[2]["items"]) == (0, 0, [])


def test_spans_are_cut(spark):
    rows = spark.createDataFrame([(1, "Keep this, A b; c d. Then é more"), (2, None), (3, "a b c")], "doc_id bigint, text string")
    found = decontamination.contamination(rows, spark.createDataFrame([(1, "a B c D")], "item_id bigint, text string"))
    out = {r.doc_id: r.text for r in decontamination.without_spans(rows, found).collect()}
    assert out == {1: "Keep this, . Then é more", 2: None, 3: "a b c"}


def test_toxicity(spark):
    r = random.Random(8)
    rows = []
    for k in range(700):
        toxic = k % 5 == 0
        lines = [prose(12, 1000 + k * 10 + j) for j in range(1 + k % 6)]
        if toxic:
            lines[r.randrange(len(lines))] += f" you {r.choice(['rotten', 'nasty', 'vile'])} thing"
        rows.append((k, ". ".join(lines), int(toxic if r.random() > 0.03 else 1)))
    data = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    model = toxicity.fit(data.where("doc_id % 4 <> 2").select("text", "label"))
    out = {x.doc_id: x for x in toxicity.score(data, model).collect()}
    held = [k for k in out if k % 4 == 2]
    assert all((out[k].score >= 0.3) == (k % 5 == 0) for k in held)
    bad = next(k for k in held if k % 5 == 0)
    sentence = toxicity.sentences(out[bad].text)[out[bad].offending[0]]
    assert any(w in sentence for w in ("rotten", "nasty", "vile"))
    odd = toxicity.score(documents(spark, ODD), model, keep=["doc_id"]).collect()
    assert len(odd) == len(ODD) + 3 and all(0 <= x.score <= 1 for x in odd)
    assert toxicity.fit(empty(data).select("text", "label")) == toxicity.Model({}, -20.0, 0.0)
    assert toxicity.fit(data.where("label = 1").select("text", "label")).leak == 1.0


def test_toxicity_sample_is_bounded(spark):
    data = spark.createDataFrame([(k, "t") for k in range(50)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(50)] + [(1, None), (None, 1), (2, 1)], "doc_id bigint, label int")
    twice = data.unionByName(data).unionByName(data.withColumn("text", F.concat("text", "doc_id")))
    some = [sorted(map(tuple, toxicity.sample(d, labels, 10).collect())) for d in (twice, twice.repartition(3))]
    assert some[0] == some[1] and len(some[0]) == 10 and toxicity.sample(data, labels, 50, 7).count() == 7
    assert toxicity.sample(data, labels, 10).count() == 10 and toxicity.sample(data, labels).count() == 50


def test_url_filter(spark):
    urls = [None, "no scheme", "http://A.Example.ORG/es/1?x#y", "https://example.org/en/12", "http://x.com/fr/a", "http://x.com/de/3", "ftp://com", "http://com/de/", "http://notcom/de/", "http://net", "http://ex.net?q=://a.com/de/", "x://y://z.com/de/", "http://É.com/DE/1", "http://h.net/a/b/c/d/e/f/g"]
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)] + [(None, urls[2], "own"), (1, urls[1], "own")], "page_id bigint, url string, shape string")
    out = url_filter.judge(pages).collect()
    assert len(out) == len(urls) + 2 and {r["shape"] for r in out} == {"own"}
    by = {r.page_id: r for r in out}
    assert [(by[i].host, by[i].path, by[i].rule) for i in range(len(urls))] == [
        ("", "", None), ("", "", None), ("a.example.org", "/es/1", "example.org/es/"), ("example.org", "/en/12", "example.org/en/1"), ("x.com", "/fr/a", "com/fr/"), ("x.com", "/de/3", "com/de/"),
        ("com", "", None), ("com", "/de/", "com/de/"), ("notcom", "/de/", None), ("net", "", None), ("ex.net", "", None), ("y:", "//z.com/de/", None), ("É.com", "/DE/1", None), ("h.net", "/a/b/c/d/e/f/g", None),
    ]
    assert [by[i].verdict for i in (2, 3, 4, 5)] == ["block", "block", "allow", "block"]
    assert url_filter.judge(empty(pages)).count() == 0


def judged(spark, rows, **options):
    out = url_filter.judge(spark.createDataFrame(rows, "url string, bad int"), rules=(), labels=F.col("bad"), **options).collect()
    return {r.url: (r.verdict, r.template) for r in out}


def test_templates_are_learned_from_labels(spark):
    """Bad branches are told apart from good ones, like ones are merged, and numbers are wildcards."""
    rows = [(f"http://h.net/{s}/{k}", int(s in ("promo", "spam"))) for s in ("news", "blog", "promo", "spam") for k in range(9)] + [("http://h.net/about/1", None)]
    for url, (verdict, template) in judged(spark, rows).items():
        bad = "/promo/" in url or "/spam/" in url
        assert verdict == ("block" if bad else "allow"), url
        assert template == ("/*+/**" if bad else "/about/**" if "about" in url else "/*/**")


def test_few_labels_tell_branches_apart(spark):
    rows = [(f"http://h.net/{s}/{k}", label) for s, label in (("de", 1), ("fr", 0), ("en", None), ("es", None)) for k in range(3)]
    out = judged(spark, rows)
    assert {v for u, (v, _) in out.items() if "/de/" not in u} == {"allow"} and len({t for _, t in out.values()}) == 4
    # The bad branch by itself is rejected, whether its siblings have labels or not.
    only = judged(spark, [r for r in rows if r[1] != 0])
    assert all((v == "block") == ("/de/" in u) for u, (v, _) in only.items())


def test_variable_segments_are_wildcards(spark):
    """Many different segments are one wildcard; of them, a branch with many bad pages stays apart, at any depth."""
    rows = [(f"http://h.net/a/b/c/d/e/user{chr(97 + k // 26)}{chr(97 + k % 26)}/x{j}", 0 if j else None) for k in range(40) for j in range(3)]
    rows += [(f"http://h.net/a/b/c/d/e/pills/x{j}", 1) for j in range(20)]
    out = judged(spark, rows)
    assert all((v == "block") == ("/pills/" in u) for u, (v, _) in out.items())
    assert {t for u, (_, t) in out.items() if "user" in u} == {"/a/b/c/d/e/*/**"}


def test_hosts_without_labels_are_allowed(spark):
    rows = [(f"http://x.com/de/{k}", 1) for k in range(30)] + [("http://fresh.net/a", None), ("http://other.com/it/1", None), (None, None), ("none", None)]
    out = judged(spark, rows)
    assert all((v == "block") == (u is not None and "/de/" in u) for u, (v, _) in out.items())


def plain_templates(pages, max_children=24):
    """The tree by recursion: {(host, shape): template}; pages are (host, shape, bad)."""
    from math import lgamma, log

    def beta(b, g):
        return lgamma(b + 0.5) + lgamma(g + 0.5) - lgamma(b + g + 1)

    def factor(b, n, b_all, n_all):
        return beta(b, n - b) + beta(b_all - b, n_all - n - b_all + b) - beta(b_all, n_all - b_all) - beta(0, 0)

    def count(rows):
        return sum(r[2] or 0 for r in rows), sum(r[2] is not None for r in rows)

    out = {}

    def grow(rows, level, template):
        by = {}
        for r in rows:
            parts = r[1].split("/")
            by.setdefault(parts[level] if len(parts) > level else None, []).append(r)
        pb, pl = count(rows)
        mixed = 0 < pb < len(rows)
        side = {s: None if not count(g)[1] else count(g)[0] * pl > pb * count(g)[1] for s, g in by.items()}
        names = {}
        for s, g in by.items():
            b, n = count(g)
            same = [r for o, rs in by.items() if side[o] == side[s] and side[s] is not None for r in rs]
            variable = len(by) > max_children
            if variable:
                apart = factor(b, n, pb, pl) > log(len(by))
            else:
                apart = side[s] is None or sum(x == side[s] for x in side.values()) == 1 or factor(b, n, *count(same)) > 0
            names[s] = None if s is None else "**" if not mixed else s if apart else "*+" if side[s] and not variable else "*"
        for name in set(names.values()):
            inside = [r for s, g in by.items() if names[s] == name for r in g]
            path = template if name is None else f"{template}/{name}"
            if name is None or not mixed:
                out.update({(r[0], r[1]): path for r in inside})
            else:
                grow(inside, level + 1, path)

    for host in {p[0] for p in pages}:
        grow([p for p in pages if p[0] == host], 0, "")
    return out


def test_templates_equal_a_plain_tree(spark):
    r = random.Random(12)
    pages = []
    for k in range(600):
        host = r.choice(["one", "two", "three", ""])
        path = "/".join(r.choice(["en", "de", "x", "", "tag", "p<n>"] + (["w" + chr(97 + r.randrange(26)) + chr(97 + r.randrange(3))] * 6 if host == "two" else [])) for _ in range(r.randrange(1, 6)))
        pages.append((host, path, r.choice([None, None, int("de" in path or r.random() < 0.1)])))
    frame = spark.createDataFrame([(h, "/" + s, b) for h, s, b in pages], "host string, path string, bad int")
    for leaves in (20_000, 10, 0):  # by tasks, both ways, by shuffles
        with common.Scratch(spark) as scratch:
            got = {(x.host, x["shape"]): x.template for x in url_filter.templates(frame, scratch, task_leaves=leaves).collect()}
        assert got == plain_templates(pages)


def test_jobs_do_not_grow_with_depth(spark):
    sc, jobs = spark.sparkContext, []
    for depth in (5, 50, 5000):
        group = f"depth-{depth}"
        path = "http://h.org/" + "/".join(f"s{chr(97 + k % 26)}" for k in range(depth))
        sc.setJobGroup(group, group)
        rows = [(path + "/x", 1), (path + "/y", 0)]
        out = {r.url[-1]: r for r in url_filter.judge(spark.createDataFrame(rows, "url string, bad int"), rules=(), labels=F.col("bad"), weight=0.5).collect()}
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(group)))
        assert out["x"].template == out["x"].path and (out["x"].verdict, out["y"].verdict) == ("block", "allow")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] == jobs[2]


def test_url_columns_are_replaced(spark):
    pages = spark.createDataFrame([("http://a.org/x", "old", "old"), (None, "old", "old")], "url string, host string, verdict string")
    assert sorted((r.host, r.verdict) for r in url_filter.judge(pages).collect()) == [("", "allow"), ("a.org", "allow")]


def test_sharding(spark, docs):
    rows = docs.select("doc_id", "text", F.lit("own").alias("shard"), F.lit(1).alias("n"))
    for shards in (1, 3, 16):
        out = sharding.bounded_ring(rows, "doc_id", shards, tie=("text",)).collect()
        slots = {}
        for r in out:
            slots.setdefault(r.shard, []).append(r.slot)
        assert len(out) == docs.count()
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        sizes = [len(slots.get(s, [])) for s in range(shards)]
        assert max(sizes) - min(sizes) <= 1
    assert sharding.bounded_ring(empty(rows), "doc_id").count() == 0
    # One key with most of the rows, ranked in shares.
    hot = spark.range(500).select(F.when(F.col("id") > 99, F.col("id") - F.col("id")).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text"))
    out = sharding.bounded_ring(hot, "doc_id", 4, tie=("text",), share_rows=30).collect()
    assert sorted((r.shard, r.slot) for r in out) == [(s, k) for s in range(4) for k in range(125)]


def test_most_rows_stay_when_a_shard_comes(spark):
    rows = spark.range(4000).withColumnRenamed("id", "doc_id")
    a, b = ({r.doc_id: r.shard for r in sharding.bounded_ring(rows, "doc_id", n).collect()} for n in (8, 9))
    assert sum(a[k] != b[k] for k in a) < 0.45 * len(a)  # an even deal anew would move 8 of 9
    plain = {r.doc_id: r.shard for r in rows.join(sharding.ring(spark, 8), sharding._slot(F.lit("key"), "doc_id") == F.col("slot")).collect()}
    assert sum(a[k] == plain[k] for k in a) > 0.8 * len(a)


def test_deal_overflows_clockwise():
    out = sharding.deal([(0, 0, 10), (5, 1, 0), (9, 2, 2)], 3)
    assert out == [(0, 0, 0, 4, 0), (0, 1, 4, 8, 0), (0, 2, 8, 10, 0), (9, 2, 0, 2, 2)]


def test_token_files(spark, docs, word_library):
    shards = token_files.write_shards(docs, encoding.tokenizer_path("word_bpe_49k.json"), shard_tokens=500)
    got = sorted(token_files.read_back(shards).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    texts = {r.doc_id: r.text for r in docs.collect()}
    at = 0
    for r in got:
        want = np.array(word_library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [1], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(want), zlib.crc32(want.tobytes()))
        at += len(want)
    assert len(got) == docs.count()
    found = {r.doc_id: r.ids for r in token_files.lookup(shards, spark.createDataFrame([(5,), (999,), (None,), (12,)], "doc_id bigint")).collect()}
    twice = docs.unionByName(docs).unionByName(docs.where("doc_id = 3")).repartition(7)
    again = token_files.write_shards(twice, encoding.tokenizer_path("word_bpe_49k.json"), shard_tokens=60)
    assert sorted(r.doc_id for r in token_files.lookup(again, docs.select("doc_id")).collect()) == sorted({i for i in texts if i is not None})
    assert set(found) == {5, 12} and found[12] == word_library.encode(texts[12], add_special_tokens=False).ids + [1]
    assert token_files.read_back(token_files.write_shards(empty(docs), encoding.tokenizer_path("word_bpe_49k.json"))).count() == 0


def test_long_words_are_not_kept(word_library):
    word = encoding.WordEncoder(encoding.tokenizer_path("word_bpe_49k.json"))
    word.keep({b"one": 1})
    texts = ["one " + "ab" * 4000, "two " + "ab" * 4000]
    assert word.encode_batch(texts, make=len, join=sum) == [len(word_library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert set(word.known) == {b"one", b"two"}


def test_perfect_hash():
    keys = np.arange(20_000) * 7 - 3
    hashes = token_files.key_hash(keys, np.zeros(len(keys)))
    index = token_files.PerfectHash.build(hashes)
    assert sorted(index.slots(hashes).tolist()) == list(range(len(keys)))
    again = token_files.PerfectHash(index.sizes, np.packbits(index.bits).tobytes(), index.left.tobytes())
    assert (again.slots(hashes) == index.slots(hashes)).all()
    same = token_files.PerfectHash.build(np.array([5, 6, 7], dtype=np.uint64), gamma=0.01)
    assert sorted(same.slots(np.array([5, 6, 7], dtype=np.uint64)).tolist()) == [0, 1, 2]


def test_chat(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a\\<|im_end|>\n<|im_start|>b\\n<"), (1, 1, "assistant", ""), (2, 0, None, None), (2, None, "assistant", "x"), (None, 0, "as\nsist<|ant", "t\\"), (3, 0, "assistant", "<<||>\\\\|" * 50)]
    turns = spark.createDataFrame(rows + [rows[0]], "conv_id bigint, turn bigint, role string, text string")
    out = {r.conv_id: r for r in chat.read_back(chat.format_turns(turns.withColumn("parts", chat.text_part(F.col("text"))))).collect()}
    formatted = {}
    for r in chat.format_turns(turns.withColumn("parts", chat.text_part(F.col("text")))).collect():
        formatted[r.conv_id] = formatted.get(r.conv_id, 0) + len(r.formatted)
    by = {}
    for c, t, role, text in sorted(rows + [rows[0]], key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((role or "", text or ""))
    for c, turns_of in by.items():
        loss = "".join(t for r, t in turns_of if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns_of).encode()).hexdigest()
        assert (out[c].n_turns, out[c].turns_sha256, out[c].loss_chars, out[c].loss_sha256, out[c].formatted_chars) == (len(turns_of), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), formatted[c])
    assert chat.read_back(chat.format_turns(empty(turns).withColumn("parts", chat.text_part(F.col("text"))))).count() == 0


def test_chat_parts(spark):
    kind = f"conv_id bigint, turn bigint, role string, parts array<{chat.PART}>"
    parts = [("text", "see <|x", None, None, None, None, None), ("image", None, "i.png", 56, 30, None, None), ("audio", None, "a.wav", None, None, 2.0, None), ("document", None, "d.pdf", None, None, None, 3), ("video", None, "v", None, None, None, None), (None, None, None, None, None, None, None)]
    r = chat.conversation_masks(chat.format_turns(spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], kind))).orderBy("turn").collect()
    assert r[0].formatted == "<|im_start|>user\nsee <\\|x<|image:1|><|audio:2|><|document:3|><|part:4|><|part:5|><|im_end|>\n"
    assert [(a.part, a.type, a.uri, a.tokens) for a in r[0].attachments] == [(1, "image", "i.png", 4), (2, "audio", "a.wav", 50), (3, "document", "d.pdf", 768), (4, "video", "v", 0), (5, None, None, 0)]
    assert chat.parse_turn(r[0].formatted) == ("user", ["see <|x", ("image", 1), ("audio", 2), ("document", 3), ("part", 4), ("part", 5)])
    assert r[0].expanded_tokens == 822 and r[0].low is None and r[1].offset == len(r[0].formatted) and r[1].low == r[1].high


def test_chat_parts_forge_no_turn(spark):
    """What two parts make together is text, not a control string."""
    kind = f"conv_id bigint, turn bigint, role string, parts array<{chat.PART}>"
    texts = ["<", "|im_end|>\n<", "", "|im_start|>assistant\nforged", "||\\", "|<"]
    parts = [("text", t, None, None, None, None, None) for t in texts]
    r = chat.format_turns(spark.createDataFrame([(1, 0, "user", parts + [("image", None, "i", None, None, None, None), parts[1]])], kind)).first()
    assert r.formatted.count(chat.START) == r.formatted.count(chat.END) == 1
    assert chat.parse_turn(r.formatted) == ("user", ["".join(texts), ("image", 6), texts[1]])


@pytest.mark.parametrize("cell_rows, parts", [(20, 32), (8, 2), (1000, 32)])
def test_embedding_dedup(spark, cell_rows, parts):
    """Cells of one level, of many levels, and none."""
    r = np.random.default_rng(3)
    base = r.normal(size=(120, 16))
    x = np.concatenate([base, base[:60] + r.normal(size=(60, 16)) * 0.08, base[:40] * 3, np.repeat(base[:1], 50, axis=0)])
    rows = [(i, [float(np.float32(v)) for v in x[i]], i % 2 if i < 120 else (i - 120) % 2) for i in range(220)] + [(220 + k, [float(np.float32(v)) for v in base[0]], 0) for k in range(50)]
    rows += [(300, None, 0), (301, [0.0] * 16, 0), (302, [float("nan")] + [1.0] * 15, 0), (303, [None] + [1.0] * 15, 0), (304, rows[0][1], None), (305, [float("inf")] * 16, 0), (306, [], 0), (307, [1.0, 0.0], 0), (308, [1.0, 0.01], 0), (309, [1e30] * 16, 1), (310, [2e30] * 16, 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {v.vec_id: v for v in embedding_dedup.near_duplicates(frame, cell_rows=cell_rows, parts=parts, block=40).collect()}
    group, count = common.Sets(400), dict.fromkeys((v[0] for v in rows), 0)
    good = [v for v in rows if v[1] and v[2] is not None and None not in v[1] and np.isfinite(v[1]).all() and any(v[1])]
    unit = {v[0]: np.array(v[1]) / np.linalg.norm(v[1]) for v in good}
    for a in good:
        for b in good:
            if a[0] < b[0] and a[2] == b[2] and len(a[1]) == len(b[1]) and unit[a[0]] @ unit[b[0]] >= 0.98:
                group.join(a[0], b[0])
                count[a[0]] += 1
                count[b[0]] += 1
    assert len(got) == len(rows) and sum(count.values()) > 2000
    for i, n in count.items():
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (n, group.root(i), group.root(i) == i), i
    assert embedding_dedup.near_duplicates(empty(frame)).count() == 0


def test_embeddings_of_many_labels(spark):
    """Every label of enough vectors has cells, however many labels there are."""
    r = np.random.default_rng(5)
    rows = [(k * 10 + j, r.normal(size=4).tolist() if j < 8 else [1.0, float(j), 0.0, 0.0], f"label {k}") for k in range(100) for j in range(10)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string")
    got = {v.vec_id: v.n_links for v in embedding_dedup.near_duplicates(frame, cosine=0.9, cell_rows=2).collect()}
    unit = {v[0]: np.array(v[1]) / np.linalg.norm(v[1]) for v in rows}
    for k in range(100):
        for j in range(10):
            assert got[k * 10 + j] == sum(unit[k * 10 + j] @ unit[k * 10 + i] >= 0.9 for i in range(10) if i != j)
