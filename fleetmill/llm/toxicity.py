"""Toxicity by multiple-instance learning from document labels.

A document is a bag of sentences. A sentence's probability is logistic in the
words it holds, and a document's is the noisy-or of its sentences' and of a
leak: one minus the product of their complements. The leak stands for labels
that no sentence explains, so that long clean documents don't add up to toxic
ones. Words count if documents with them are toxic more often than by chance
(a Chernoff bound, corrected for the number of words). Weights and leak are
fitted to document labels alone (full-batch Adam with an L2 penalty) on at most
``sample_rows`` labelled documents, in one Spark task; scoring runs over all
documents with the weights broadcast, and names the sentences that speak
against a document.
"""

from __future__ import annotations

import re
from array import array
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sliced, table

#: Labelled documents that a model is fitted to, bytes of their texts, and words it may know: all are bounds.
SAMPLE_ROWS = 6_000
SAMPLE_BYTES = 200_000_000
MAX_WORDS = 60_000
#: A word must be in so many of the sample's documents, and its excess of toxic ones as unlikely as this over all words.
LEAST_DOCS = 4
CHANCE = 0.05
STEPS = 300
#: The weights' L2 penalty, and where it draws them: the words kept are signs of toxicity.
PENALTY = 0.05
PRIOR = 5.0
_SENTENCE = re.compile(r"[.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str | None) -> list[str]:
    """The sentences with at least one word; they end at . ! ? or a line's end."""
    return [] if text is None else [s for s in _SENTENCE.split(text) if _WORD.search(s)]


def features(sentence: str) -> set[str]:
    """The lower-cased words, and the beginnings of longer ones, which stand for their inflections."""
    words = set(_WORD.findall(sentence.lower()))
    return words.union([w[:4] + "*" for w in words if len(w) > 4], [w[:5] + "*" for w in words if len(w) > 5])


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> DataFrame:
    """(text, label): labelled documents, at most ``rows`` of ``size`` bytes together, picked by the hashes of id and text.

    ``labels`` has doc_id and label; a document with several labels has the
    largest. Rows that repeat id and text are one.
    """
    one = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    picked = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    hashes = [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")]
    docs = docs.where("text is not null")
    known = docs.select("doc_id", *hashes, F.octet_length("text").alias("n")).join(F.broadcast(picked), "doc_id").distinct()
    first = known.orderBy(F.xxhash64("doc_id"), "doc_id", "t1", "t2").limit(rows)
    upto = F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id", "t1", "t2").rowsBetween(Window.unboundedPreceding, 0))  # SAMPLE_ROWS rows
    chosen = first.withColumn("upto", upto).where(F.col("upto") <= size).select("doc_id", "t1", "t2", F.col("label").cast("int").alias("label"))
    return docs.select("doc_id", *hashes, "text").join(F.broadcast(chosen), ["doc_id", "t1", "t2"]).dropDuplicates(["doc_id", "t1", "t2"]).select("text", "label")


class Model(NamedTuple):
    weights: dict[str, float]
    bias: float
    leak: float


def fit(rows: DataFrame, steps: int = STEPS) -> Model:
    """The model of (text, label); without both labels it has no weights, and the rows' rate as leak (0 without rows)."""

    def train(frame):
        import pandas as pd

        model = _train(frame["text"].tolist(), frame["label"].tolist(), steps)
        return pd.DataFrame({"word": ["", " ", *model.weights], "weight": [model.bias, model.leak, *model.weights.values()]})

    out = rows.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(train, "word string, weight double").collect()  # at most MAX_WORDS + 2 rows
    weights = {r.word: r.weight for r in out}
    return Model(bias=weights.pop("", -20.0), leak=weights.pop(" ", 0.0), weights=weights)


def _train(texts: list[str], labels: list[int], steps: int) -> Model:
    import numpy as np

    y = np.array(labels, dtype=float)
    if not len(y) or y.min() == y.max():
        return Model({}, -20.0, float(y.mean()) if len(y) else 0.0)
    df: dict[str, list[int]] = {}
    for text, label in zip(texts, labels, strict=True):
        for w in features(text):
            n = df.setdefault(w, [0, 0])
            n[0] += 1
            n[1] += label
    often = sorted(w for w, (n, _) in df.items() if n >= LEAST_DOCS)
    n, k = (np.array([df[w][i] for w in often], dtype=float) for i in (0, 1))
    share, base = np.clip(k / n, 1e-9, 1 - 1e-9), y.mean()
    bound = -n * (share * np.log(share / base) + (1 - share) * np.log((1 - share) / (1 - base)))
    unlikely = (share > base) & (bound < np.log(CHANCE / max(1, len(often))))
    order = np.argsort(bound, kind="stable")[:MAX_WORDS]
    words = [often[i] for i in order if unlikely[i]]
    index = {w: i for i, w in enumerate(words)}
    sentence, feature, owner, n = array("i"), array("i"), array("i"), 0
    for d, text in enumerate(texts):
        for s in sentences(text):
            owner.append(d)
            for w in index.keys() & features(s):
                sentence.append(n)
                feature.append(index[w])
            n += 1
    sentence, feature, owner = (np.array(x, dtype=np.int32) for x in (sentence, feature, owner))
    # Parameters: the words' weights, the bias, and the leak's logit.
    x = np.append(np.full(len(words), PRIOR), [-8.0, -3.0])
    m, v = np.zeros(len(x)), np.zeros(len(x))
    for step in range(1, steps + 1):
        w, bias, leak = x[:-2], x[-2], 1 / (1 + np.exp(-x[-1]))
        z = np.bincount(sentence, w[feature], minlength=n) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        log_none = np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y)) + np.log1p(-leak)
        doc = np.clip(1 - np.exp(log_none), 1e-9, 1 - 1e-9)
        # The loss' slope in a logit of probability p: p for a clean document, -p (1 - doc) / doc for a toxic one.
        pull = np.where(y > 0, -(1 - doc) / doc, 1.0)
        g = p * pull[owner]
        grad = np.append(np.bincount(feature, g[sentence], minlength=len(words)) + PENALTY * (w - PRIOR), [g.sum(), leak * pull.sum()]) / len(y)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        x = x - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model({word: float(x[i]) for word, i in index.items()}, float(x[-2]), float(1 / (1 + np.exp(-x[-1]))))


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, flag: float = 0.5, names: tuple[str, str] = ("score", "offending")) -> DataFrame:
    """The columns ``keep`` (all by default) and, by ``names``, score and offending: the numbers, from 0, of sentences of at least ``flag``.

    A text without sentences (null, empty, signs only) scores the leak. Whole
    texts are read; repeated rows score alike; an empty table gives no rows.
    Kept columns with one of ``names`` are replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import math

        import pyarrow as pa

        weights, bias, leak = sent.value
        known = weights.keys()
        for batch in sliced(batches):
            scores, where = [], []
            for t in batch.column("__text").to_pylist():
                none, bad = math.log1p(-leak), []
                for i, s in enumerate(sentences(t)):
                    z = bias + sum(map(weights.__getitem__, known & features(s)))
                    z = max(-30.0, min(30.0, z))
                    none -= math.log1p(math.exp(z))
                    if 1 / (1 + math.exp(-z)) >= flag:
                        bad.append(i)
                scores.append(-math.expm1(none))
                where.append(bad)
            new = [pa.array(scores, pa.float64()), pa.array(where, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *new], [*keep, *names])

    schema = docs.select(*keep).withColumns({names[0]: F.lit(0.0), names[1]: F.lit(None).cast("array<int>")}).schema
    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def held_out() -> Column:
    """Rows whose labels are never learned from: crc32 of the id's digits leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def scored(spark, docs: DataFrame, sf_dir: str, names: tuple[str, str] = ("score", "offending")) -> DataFrame:
    """docs with score and offending (or other ``names``), by a model of the labelled rows that aren't held out."""
    source = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", F.col("toxic").alias("label"))
    return score(docs, fit(sample(source, labels)), names=names)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    out = scored(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), sf_dir)
    return out.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), F.size("offending").alias("n_offending"))
