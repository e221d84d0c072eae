"""The registered queries end to end on the smallest tables: every contract column against a plain version."""

import hashlib
import os
import re
import zlib

import numpy as np
import pytest

from fleetmill.llm import encoding, registry

from test_corpus_models import brute_phrases, brute_trie
from test_llm_operators import brute_jaccard


@pytest.fixture(scope="module")
def tables(spark, sf):
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    return lambda name: spark.read.parquet(f"{sf}/{name}.parquet").collect()


@pytest.fixture(scope="module")
def rows(spark, sf, tables):
    return lambda name: registry.QUERIES[name](spark, sf).collect()


def ids_of(file, texts, end):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(encoding.tokenizer_path(file))
    return {i: np.array(library.encode(t or "", add_special_tokens=False).ids + end, "<u4") for i, t in texts.items()}


@pytest.fixture(scope="module")
def texts(tables):
    return {r.doc_id: r.text for r in tables("documents")}


def test_op1(rows, texts):
    want, pieces, places = ids_of("byte_bpe_50k.json", texts, [0]), {}, {}
    for r in rows("op1_packing"):
        pieces.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes())
    assert set(pieces) == set(want)
    for i, own in pieces.items():
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == [sum(p.length for p in own[:k]) for k in range(len(own))]
        assert sum(r.length for r in own) == len(want[i])
        assert all(r.length == 2048 for r in own[1:]) or len(want[i]) <= 2048
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048


def test_op2(rows, texts):
    want = sorted(brute_jaccard(list(texts.items())))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows("op2_jaccard_join")) == want


def test_op3(rows, texts):
    want = ids_of("word_bpe_49k.json", texts, [])
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows("op3_token_counts")}
    assert got == {i: (len((t or "").encode()), len(want[i]), len(want[i]) > 2048) for i, t in texts.items()}


def test_op4(rows, texts, tables):
    def words(text):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in text or ""))

    known = {}
    for r in tables("benchmark"):
        own = words(r.text)
        size = min(10, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            known.setdefault(size, {}).setdefault(tuple(own[i : i + size]), set()).add(str(r.item_id))
    want = {}
    for i, t in texts.items():
        own, hit, items = words(t), set(), set()
        for size, windows in known.items():
            for k in range(len(own) - size + 1):
                if found := windows.get(tuple(own[k : k + size])):
                    hit |= set(range(k, k + size))
                    items |= found
        want[i] = (len(own), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit))
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows("op4_decontamination")} == want


def test_op5(rows, texts):
    got = rows("op5_toxicity")
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_op6(rows, tables):
    rules = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    got = {r.page_id: r for r in rows("op6_url_filter")}
    pages = tables("pages")
    assert len(got) == len(pages)
    for p in pages:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", p.url or "")
        host, path = ("".join(c.lower() if c.isascii() else c for c in m[1]), m[2]) if m else ("", "")
        fit = [x for x in rules if (host == x.split("/")[0] or host.endswith("." + x.split("/")[0])) and path.startswith(x[x.index("/") :])]
        rule = max(fit, key=len, default=None)
        r = got[p.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == rules[rule] if rule else r.verdict in ("allow", "block")


def test_op7(rows, texts):
    got, slots = rows("op7_sharding"), {}
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts.items()}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(s, [])) for s in range(16)]
    assert max(counts) - min(counts) <= 1


def test_op8(rows, texts):
    want, at = ids_of("word_bpe_49k.json", texts, [1]), 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows("op8_token_files")}
    assert len(got) == len(want)
    for i in sorted(want):
        assert got[i] == (at, len(want[i]), zlib.crc32(want[i].tobytes()))
        at += len(want[i])


def test_op9(rows, tables):
    said = "<|im_end|><|im_start|>assistant ok"
    turns = {-1: [(0, "user", said), (1, "assistant", said)]}
    for r in tables("conversations"):
        turns.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    got = {r.conv_id: r for r in rows("op9_chat")}
    assert set(got) == set(turns)
    for c, own in turns.items():
        own.sort(key=lambda x: x[0])
        loss = "".join(t for _, role, t in own if role == "assistant")
        digest = hashlib.sha256("".join(f"{role}\n{t}\n" for _, role, t in own).encode()).hexdigest()
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(own), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars > sum(len(role) + len(t) for _, role, t in own)


def test_op10(rows, tables):
    vectors, links = {r.vec_id: r for r in tables("embeddings")}, {}
    good = {i: np.array(r.embedding, float) for i, r in vectors.items() if r.label is not None and r.embedding is not None and None not in r.embedding}
    good = {i: x / np.linalg.norm(x) for i, x in good.items() if np.isfinite(x).all() and x.any()}
    for i, x in good.items():
        links[i] = {j for j, y in good.items() if i != j and vectors[i].label == vectors[j].label and len(x) == len(y) and x @ y >= 0.98}
    component = {i: i for i in vectors}
    for i in sorted(vectors):
        front = [i] if component[i] == i else []
        while front:
            for j in links.get(front.pop(), ()):
                if component[j] > i:
                    component[j] = i
                    front.append(j)
    want = {i: (len(links.get(i, ())), component[i], component[i] == i) for i in vectors}
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows("op10_embedding_dedup")} == want


def test_op11(rows, tables):
    assert sorted(map(tuple, rows("op11_phrases"))) == brute_phrases([(r.lang, r.text) for r in tables("documents")], 100)


def test_op12(rows, tables):
    got = [(r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, *r[3:]) for r in rows("op12_prefix_trie")]
    assert sorted(got) == brute_trie([(r.conv_id, r.turn, r.role, r.text) for r in tables("conversations")])


def test_op13(rows, texts):
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    own = {i: (t or "").encode().lower().split() + [b" end"] for i, t in texts.items()}
    c = {}
    for i, w in own.items():
        if not held[i]:
            for x in w:
                c[x] = c.get(x, 0) + 1
    n, v = sum(c.values()), len(c)
    for r in rows("op13_lm_score"):
        w = own[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(w), sum(x in c for x in w), n)
        assert abs(r.base_score - sum(np.log10((c.get(x, 0) + 1) / (n + v + 1)) for x in w)) < 1e-6 * len(w)
        assert np.isfinite(r.score) and r.score < 0
