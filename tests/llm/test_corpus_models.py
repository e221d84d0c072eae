"""Phrases, prefix tries and language-model scores against plain versions, with odd cases."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from fleetmill.llm import bloom, lm_score, phrases, prefix_trie, words


def brute_phrases(rows, least, longest=5, top=2000):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        t = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", t):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = {q[i:j] for q, m in found.items() for i in range(len(q)) for j in range(i + 2, len(q) + 1) if j - i < len(q) and m >= found[q[i:j]]}
        rows = []
        for p, a in found.items():
            if p not in inside:
                score, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return sorted(out)


TEXTS = [
    ("en", "a b c d e. a b c d e f; a b, c\ta  b c D E\nA b c d e"), ("en", "x x x x x x x x"), (None, "x x x x, the cat"), (None, "The cat\rthe cat"), ("und", "the cat é Éa é Éa é Éa"),
    ("fr", None), (None, ""), ("fr", " \t . , "), ("en", "a b c d e. a b c d e f; a b, c\ta  b c D E\nA b c d e"), ("en", "w\x00\x1fq w\x00\x1fq w\x00\x1fq y"),
]


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_phrases(spark, least):
    df = spark.createDataFrame(TEXTS, "lang string, text string")
    got = phrases.phrases(df.withColumn("rank", df.lang), least=least, top=9)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_phrases(TEXTS, least, top=9)


def test_phrases_of_empty_tables_and_few_words(spark):
    assert phrases.phrases(spark.createDataFrame([], "lang string, text string")).collect() == []
    assert phrases.phrases(spark.createDataFrame(TEXTS, "lang string, text string")).collect() == []


def test_phrases_of_long_texts_and_many_at_once(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK", 7)
    monkeypatch.setattr(phrases, "AT_ONCE", 5)
    monkeypatch.setattr(phrases, "KEPT_WORDS", 3)
    df = spark.createDataFrame(TEXTS, "lang string, text string").coalesce(1)
    assert sorted(map(tuple, phrases.phrases(df, least=2).collect())) == brute_phrases(TEXTS, 2)
    pieces = list(phrases._pieces(b"ab cd. e fghijklmnop q,r"))
    assert [w for own, _ in pieces for w in own] == b"ab cd e fghijklmnop q r".split()
    assert [int(a) for _, at in pieces for a in at] == [0, 1, 3, 4, 5, 7]


def test_parts_of_phrases_are_united_in_bounded_memory():
    """Every one of 200 tasks sends all 40,000 groups of a range: 192 MB, of which one copy is held."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    g = np.arange(40_000, dtype=np.uint64)
    rows = np.stack([g, g + np.uint64(1), g + np.uint64(2)], axis=1)

    def sent():
        for bucket in (0, 0, 3):
            for _ in range(100):
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([rows[::-1].tobytes()], pa.binary())], ["bucket", "rows"])

    tracemalloc.start()
    got = [b.to_pydict() for b in phrases.united(sent())]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == 2 and all(x["g"] == list(range(40_000)) and x["tail"][7] == 9 for x in got)
    assert peak < 80 << 20, peak


def test_phrases_of_a_megabyte(spark):
    text = "one two three " * 100_000 + "z" * 1_000_000
    got = phrases.phrases(spark.createDataFrame([("en", text)], "lang string, text string"))
    assert sorted(map(tuple, got.collect())) == brute_phrases([("en", text)], 100)


def test_phrase_scores_beyond_64_bits(spark):
    df = spark.sql("select 4000000000000L a, 90000000000000L n, 4000000000001L l, 4000000000003L r")
    e = "(cast(a as decimal(19,0)) * 1000 * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    assert df.selectExpr(e).first()[0] == 1000 * 4 * 10**12 * 9 * 10**13 // ((4 * 10**12 + 1) * (4 * 10**12 + 3))


def brute_trie(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    built = {}
    for v in own.values():
        v.sort(key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple((r, t) for _, _, r, t in own.get(c - c % 5, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, b in built.items():
        for d in range(len(b) + 1):
            members[b[:d]].append(c)
    children, leaves, saved = collections.Counter(p[:-1] for p in members if p), collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:d]] += not children[p]
    sha = lambda p, m: hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(p)))).encode()).hexdigest()
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p], sha(p, m)) for p, m in members.items())


def conversations(seed, n=60):
    rng = np.random.default_rng(seed)
    said = ["", "é", "yes", "no", None, "a longer text"]
    rows = []
    for c in rng.permutation(n * 3)[:n].tolist():
        kind = rng.integers(4)
        for t in range(rng.integers(0, 14)):
            text = said[t % 3] if kind < 2 else said[rng.integers(len(said))]
            rows.append((c, t, ["user", "assistant", None][t % 2 if kind else rng.integers(3)], text))
    return rows


@pytest.mark.parametrize(("seed", "block"), [(0, 1), (1, 4), (2, 64)])
def test_trie(spark, seed, block):
    rows = conversations(seed)
    rows += [(7, None, "user", "first"), (None, 0, "user", "nobody's")]
    rows += [(7, 50, "user", "again")] * 2 + [(500 + i, t, "user", f"long {t}") for i in range(3) for t in range(200)]
    turns = prefix_trie.turns_of(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("depth", prefix_trie.F.lit("x")))
    got = prefix_trie.trie(prefix_trie.shared_openings(turns), turns.select("conv_id").distinct(), block)
    want = brute_trie(rows)
    assert sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, *r[3:]) for r in got.collect()) == want


def test_trie_of_nothing(spark):
    empty = prefix_trie.turns_of(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string"))
    assert prefix_trie.trie(prefix_trie.shared_openings(empty), empty.select("conv_id").distinct()).collect() == []


def test_ends_across_ranges(spark):
    ids = [-5, 0, 3, 4095, 4096, 10_000, 1_000_000]
    got = prefix_trie.ends(spark.createDataFrame([("k", i) for i in ids] + [("j", 9)], "key string, conv_id bigint")).collect()
    assert {r.key: r.ends_sha256 for r in got} == {"k": hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest(), "j": hashlib.sha256(b"9").hexdigest()}


def test_bloom_levels(spark):
    rng = np.random.default_rng(1)
    h, levels = rng.integers(-(2**63), 2**63 - 1, 200_000), rng.integers(1, 9, 200_000)
    df = spark.createDataFrame(list(zip(h.tolist(), levels.tolist(), strict=True)), "h bigint, levels int")
    segments = bloom.segments_for(int(levels.sum()))
    rows = bloom.filled(df, segments)
    whole = bloom.read_slice(rows, 0, segments, segments)
    found = whole.levels(h.view(np.uint64))
    assert (found >= levels).all() and (found > levels).mean() < 0.03
    assert (whole.levels(rng.integers(0, 2**63, 100_000).astype(np.uint64)) > 0).mean() < 0.03
    parts = [bloom.read_slice(rows, k, k + 1, segments).levels(h.view(np.uint64)) for k in range(segments)]
    assert segments > 1 and (np.max(parts, axis=0) == found).all()


LM = [
    (1, "The cat sat on the mat. The cat sat"), (2, "the cat\x0bsat\ton THE mat \n"), (3, None), (4, ""), (5, "the cat sat on the mat. The cat sat"), (None, "é the É cat"),
    (6, "  \t "), (7, "unheard words only"), (8, "the cat sat on the dog"), (9, "w" * 100_000 + " the " + "cat sat " * 2000), (1, "The cat sat on the mat. The cat sat"),
]


def base_scores(rows):
    own = lambda t: (t or "").encode().lower().split() + [b" end"]
    c = collections.Counter(w for i, t in rows if i is not None and i != 8 for w in own(t))
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        w = own(t)
        out.append((-1 if i is None else i, len(w), sum(c[x] > 0 for x in w), n, round(math.fsum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)))
    return sorted(out)


def test_base_scores_and_tiers(spark):
    df = spark.createDataFrame(LM, "doc_id bigint, text string").withColumn("score", lm_score.F.lit("x")).withColumn("n", lm_score.F.col("doc_id"))
    train = lm_score.F.col("doc_id") != 8
    runs = [lm_score.scored(df, train, **how).collect() for how in ({}, {"tier": 3}, {"tier": 0})]
    assert all(runs[0][0].asDict().keys() == {"doc_id", "n", "n_tokens", "n_known", "train_tokens", "base_score", "score"} for _ in runs)
    for rows in runs:
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == base_scores(LM)
        assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    score = {r.doc_id: (r.score, r.base_score) for r in runs[0]}
    assert score[8][0] > score[8][1] and score[1] == score[1]


def test_scores_of_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert lm_score.scored(df, lm_score.F.lit(True)).collect() == []
    one = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    r = lm_score.scored(one, lm_score.F.lit(None).cast("boolean")).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_ngram_counts(spark, monkeypatch):
    rows = [t for _, t in LM if t]
    df = spark.createDataFrame([(t.encode(),) for t in rows], "text binary")
    got = lm_score.ngram_counts(df).collect()
    want = collections.Counter()
    for t in rows:
        w = ["<s>", *t.encode().lower().split(), "</s>"]
        for k in (1, 2, 3):
            want.update((k, tuple(w[i : i + k])) for i in range(len(w) - k + 1) if not (k == 1 and i == 0))
    assert sorted((r.k, r.n) for r in got) == sorted((k, n) for (k, _), n in want.items())
    monkeypatch.setattr(lm_score, "AT_ONCE", 7)
    monkeypatch.setattr(words, "CHUNK", 11)
    again = lm_score.ngram_counts(df.coalesce(1), bucket_bytes=500).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_scores_by_slices_and_held_out_texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/../sf0.01/documents.parquet").select("doc_id", "text")
    held = lm_score.F.col("doc_id") % 7 == 2
    one = {r.doc_id: r for r in lm_score.scored(docs, ~held).collect()}
    many = {r.doc_id: r for r in lm_score.scored(docs, ~held, slice_segments=1).collect()}
    assert all(abs(one[i].score - many[i].score) < 1e-9 and abs(one[i].base_score - many[i].base_score) < 1e-6 for i in one)
    out = [r for i, r in one.items() if i % 7 == 2]
    assert sum(r.score for r in out) > 0.97 * sum(r.base_score for r in out)  # both are negative
    assert sum(r.score > r.base_score for r in out) > 0.75 * len(out)
