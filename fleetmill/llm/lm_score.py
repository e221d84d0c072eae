"""Language-model scoring with a log-frequency Bloom filter of n-gram counts.

The n-grams of all training texts, up to ``order`` words, are counted. A count
becomes a level, 1 + floor(log2(count / least)), and the filter holds each
n-gram at its level and all below; probing level after level until one is
missing gives the level back, and that the mean count of its n-grams. A false
hit can only raise a level, to that of the n-grams within it at most.
Probabilities go from short histories h to long ones:

    P(w | h) = discount(level of h w) * c(h w) / c(h) + rest(level of h) * P(w | shorter h)

Discounts of low levels are Good and Turing's: the tokens that a level has once
each n-gram loses one occurrence, over those that it has. The rest is what the
discounted n-grams leave, summed over all training tokens behind histories of
a level, by probing.

The filter grows with the corpus's n-grams. It is broadcast ``slice_segments`` MiB
at a time, a scan of the texts for each slice; between scans the levels found
so far are kept beside the texts. Unigram counts for the base score are exact:
the most frequent words' are broadcast, the others' joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bloom import filled, mixed, read_slice, segments_for
from .common import Scratch, arrow_batches, table, text_bytes, written
from .packed import Ranges
from .words import by_bytes, chunks, counted, hashes

ORDER = 3
#: The least count of bigrams and longer n-grams that the filter holds; all words are held.
LEAST = 2
#: Levels whose counts are discounted.
DISCOUNTED = 5
#: MiB of the filter that are broadcast at once, and words in the table of exact counts (16 bytes each).
SLICE_SEGMENTS = 96
TIER = 500_000
#: N-grams that a task counts at once.
AT_ONCE = 1 << 21
#: Bytes of text for each range of hashes that is summed up at once.
BUCKET_BYTES = 4 << 20
#: Rows that go to a Python worker at once.
ROWS = 1000
#: No words: they hold spaces.
_END, _BEGIN = b" end", b" begin"


def _stream(texts: list[bytes]):
    """The texts' words as one array: begin, words, end of each text; and where each text begins."""
    import numpy as np

    begin, end = hashes([_BEGIN]), hashes([_END])
    parts, starts, at = [], [], 0
    for t in texts:
        own = [begin, *(hashes(c) for c in chunks(t.lower())), end]
        parts += own
        starts.append(at)
        at += sum(map(len, own))
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.array(starts, dtype=np.int64)


def _grams(words, order: int) -> list:
    """For each n the hashes of the n-grams that end at each place of the array (those of the first n - 1 places mean nothing)."""
    import numpy as np

    out, before = [words], words
    for n in range(2, order + 1):
        longer = np.zeros_like(words)
        longer[1:] = mixed(before[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:] + np.uint64(n))
        out.append(longer)
        before = longer
    return out


def _whole(words, order: int) -> list:
    """For each n whether the n-gram that ends at a place lies within one text, with its begin and its end."""
    import numpy as np

    begin = words == hashes([_BEGIN])[0]
    out, cut = [~begin], begin
    for n in range(2, order + 1):
        ok = ~begin  # the word isn't a begin, nor are those before it but the first
        ok[: n - 1] = False
        for k in range(1, n - 1):
            ok[k:] &= ~cut[:-k]
        out.append(ok)
    return out


def ngram_counts(texts: DataFrame, order: int = ORDER, least: int = 1, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(k, h, n): the count of each n-gram of k words, by its hash, over a column ``text`` of bytes; longer ones than words from ``least`` on.

    Tasks send what they counted as packed rows, one for each range of hashes;
    there are as many ranges as the texts have ``bucket_bytes``, so a task
    sums up a range in memory at any size. Ranges are dealt in runs, and rows
    are in the order of h within a run.
    """
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = Ranges(texts.sparkSession, -(-total // bucket_bytes))

    def count(batches):
        import numpy as np

        kept: list[list] = [[] for _ in range(order)]
        held = [0] * order

        def flush(k):
            h, n = counted(np.concatenate(kept[k]))
            kept[k], held[k] = [], 0
            yield from ranges.rows(h, n, k + 1)

        for batch in by_bytes(batches, "text"):
            words, _ = _stream(batch.column("text").to_pylist())
            for low in range(0, len(words), AT_ONCE):
                part = words[max(0, low - order + 1) : low + AT_ONCE]
                fresh = np.arange(len(part)) >= min(low, order - 1)
                for k, (g, ok) in enumerate(zip(_grams(part, order), _whole(part, order), strict=True)):
                    g = g[ok & fresh]
                    kept[k].append(g)
                    held[k] += len(g)
                    if held[k] >= AT_ONCE:
                        yield from flush(k)
        for k in range(order):
            if held[k]:
                yield from flush(k)

    return ranges.summed(texts.mapInArrow(count, Ranges.KIND), {k: least for k in range(2, order + 1)})


class Model:
    """What tasks need to turn levels into probabilities: totals, and for each n and level mean counts, discounts and rests.

    A begin is as frequent as there are texts, and has a level of its own.
    """

    BEGIN = 63

    def __init__(self, order: int, sums: list, texts: int):
        """``sums``: rows (k, level, tokens, types, lowest), where lowest is the tokens of n-grams with the least count of the level."""
        import numpy as np

        self.order = order
        tokens, types, lowest = (np.zeros((order + 1, 66)) for _ in range(3))
        for r in sums:
            tokens[r.k, r.level], types[r.k, r.level], lowest[r.k, r.level] = r.tokens, r.types, r.lowest
        self.tokens, self.types = int(tokens[1].sum()), int(types[1].sum())
        self.mean = np.divide(tokens, types, out=np.zeros_like(tokens), where=types > 0)
        self.mean[1, self.BEGIN] = texts
        less = tokens[:, :65] - lowest[:, :65] + lowest[:, 1:]
        self.discount = np.ones((order + 1, 65))
        self.discount[:, 1 : DISCOUNTED + 1] = np.clip((less[:, 1 : DISCOUNTED + 1] + 1) / (tokens[:, 1 : DISCOUNTED + 1] + 1), 0.0, 1.0)
        self.discount[:, 0] = 0
        self.rest = np.ones((order + 1, 64))

    def levels(self, words, part) -> list:
        """For each n the levels of the n-grams that end at each place, as far as a slice has them."""
        import numpy as np

        grams, whole = _grams(words, self.order), _whole(words, self.order)
        h, back = np.unique(words, return_inverse=True)
        out = [part.levels(h)[back]]
        alone = part.low == 0 and part.high == part.segments
        for g, ok in zip(grams[1:], whole[1:], strict=True):
            if alone:  # no n-gram is more frequent than its end
                ok = ok & (out[-1] > 0)
            out.append(part.levels(g, ok))
        return out

    def capped(self, levels, starts) -> list:
        """For each n the levels, none above those of the n-grams within; begins are at ``starts``."""
        import numpy as np

        out = [levels[0].copy()]
        out[0][starts] = self.BEGIN
        for n in range(2, self.order + 1):
            level, before = levels[n - 1].copy(), out[-1]
            level[1:] = np.minimum(level[1:], np.minimum(before[1:], before[:-1]))
            level[starts] = 0
            if n > 2:  # the text's first word has no longer history
                level[np.minimum(starts + 1, len(level) - 1)] = 0
            out.append(level)
        return out

    def seen(self, levels, starts):
        """[n, level of the history, level of the n-gram]: how many places."""
        import numpy as np

        out = np.zeros((self.order + 1, 64, 64), dtype=np.int64)
        capped = self.capped(levels, starts)
        token = np.ones(len(capped[0]), dtype=bool)
        token[starts] = False
        at = np.flatnonzero(token)
        for n in range(2, self.order + 1):
            both = capped[n - 2][at - 1].astype(np.int64) * 64 + capped[n - 1][at]
            out[n] = np.bincount(both, minlength=4096).reshape(64, 64)
        return out

    def fit(self, seen) -> None:
        for n in range(2, self.order + 1):
            places = seen[n].sum(axis=1)
            used = (seen[n] * self.discount[n][None, :64]).sum(axis=1)
            self.rest[n] = (places - used + 1) / (places + 1)

    def logs(self, levels, starts):
        """log10 of the probability of each place's word; 0 for begins."""
        import numpy as np

        capped = self.capped(levels, starts)
        p = (np.where(capped[0] == self.BEGIN, 0, self.mean[1][capped[0]]) + 1) / (self.tokens + self.types + 1)
        for n in range(2, self.order + 1):
            own, history = capped[n - 1], np.zeros_like(capped[n - 1])
            history[1:] = capped[n - 2][:-1]
            before = self.mean[n - 1][history]
            known = (history > 0) & (before > 0)
            share = np.divide(np.minimum(self.mean[n][own] * self.discount[n][own], before), before, out=np.zeros(len(p)), where=known)
            p = np.where(known, share + self.rest[n][history] * p, p)
        out = np.log10(np.minimum(p, 1.0))
        out[starts] = 0.0
        return out


def scored(docs: DataFrame, train: Column, text: str = "text", order: int = ORDER, least: int = LEAST, slice_segments: int = SLICE_SEGMENTS, tier: int = TIER, names: tuple[str, ...] = ("n_tokens", "n_known", "train_tokens", "base_score", "score")) -> DataFrame:
    """docs, without the text, with n_tokens, n_known, train_tokens, base_score and score; columns of these names are replaced.

    The model learns from all rows where ``train`` is true, null being false.
    A null text is an empty one, whose only token is its end. Texts are read
    whole, whatever their length; repeated rows count and are scored each;
    other columns are carried as they are. An empty table gives no rows, and
    without training rows every token has one probability. Words are told
    apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    others = [c for c in docs.columns if c != text and c not in names]
    with Scratch(spark) as scratch, arrow_batches(spark, ROWS):
        learned = docs.where(F.coalesce(train, F.lit(False))).select(text_bytes(F.col(text)).alias("text"))
        counts = ngram_counts(learned, order, least)
        step = F.when(F.col("k") == 1, F.col("n")).otherwise(F.expr(f"n div {least}"))
        counts = scratch.write(counts.withColumn("levels", F.length(F.bin(step)).cast("int")), "counts")
        lowest = F.when(F.col("k") == 1, 1).otherwise(least) * F.expr("shiftleft(1L, levels - 1)")
        sums = counts.groupBy("k", F.col("levels").alias("level")).agg(F.sum("n").alias("tokens"), F.count("*").alias("types"), F.sum(F.when(F.col("n") == lowest, F.col("n")).otherwise(0)).alias("lowest")).collect()
        unigrams = counts.where("k = 1").select("h", "n")
        ends = unigrams.where(F.col("h") == int(hashes([_END]).view("int64")[0])).first()
        segments = segments_for(sum(r.level * r.types for r in sums))
        bits = scratch.write(filled(counts.select("h", "levels"), segments), "filter")
        model = Model(order, sums, ends.n if ends else 0)
        first = unigrams.orderBy(F.desc("n"), "h").limit(tier).toArrow()
        frequent = spark.sparkContext.broadcast(_sorted(first))

        own = F.struct(*others) if others else F.lit(None).cast("int")
        rows = docs.select(own.alias("__own"), F.coalesce(train, F.lit(False)).alias("__train"), text_bytes(F.col(text)).alias("text"), F.lit(None).cast("binary").alias("levels"))
        for low in range(0, segments, slice_segments):
            high, before = min(segments, low + slice_segments), scratch.paths[-1]
            part = spark.sparkContext.broadcast(read_slice(bits, low, high, segments))
            if high < segments:
                rows = scratch.write(_probed(rows, model, part), "levels")
            else:
                found = scratch.write(_probed(rows, model, part, frequent).withColumn("__row", F.monotonically_increasing_id()), "found")
            part.unpersist()
            if low:
                scratch.remove(before)
        model.fit(_seen(found.where("__train").select("levels"), model))
        result = _logs(found, model)
        rare = found.select("__row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("__row", F.col("r.rare").alias("h"), F.col("r.times").alias("times"))
        rare = rare.join(unigrams, "h", "left").select("__row", "times", F.coalesce("n", F.lit(0)).alias("c"))
        rare = rare.groupBy("__row").agg(F.sum(F.col("times") * F.log10((F.col("c") + 1) / (model.tokens + model.types + 1))).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known"))
        zero = lambda c: F.coalesce(c, F.lit(0))
        out = result.join(rare, "__row", "left")
        values = (F.col("n_tokens"), F.col("n_known") + zero("known"), F.lit(model.tokens).cast("bigint"), F.col("base_score") + zero("more"), F.col("score"))
        return written(out.select(*(F.col("__own")[c].alias(c) for c in others), *(v.alias(n) for v, n in zip(values, names, strict=True))), "lm-score")


def _sorted(first) -> tuple:
    """(hashes, counts) of an Arrow table (h, n), by hash."""
    import numpy as np

    h = first.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], first.column("n").to_numpy()[order]


def _levels(words, kept: bytes | None, model: Model, part):
    """The levels (a row for each n) by a slice, and those found before."""
    import numpy as np

    out, step = np.zeros((model.order, len(words)), dtype=np.uint8), AT_ONCE // 4
    for low in range(0, len(words), step):
        before = min(low, model.order)
        for n, found in enumerate(model.levels(words[low - before : low + step], part)):
            out[n, low : low + step] = found[before:]
    if kept is not None:
        out = np.maximum(out, np.frombuffer(kept, dtype=np.uint8).reshape(model.order, -1))
    return out


def _probed(rows: DataFrame, model: Model, part, frequent=None) -> DataFrame:
    """rows with what a slice adds to ``levels``; with the frequent words' counts, instead of the text n_tokens, and n_known and base_score by those counts, and the rare words to be joined."""
    last = frequent is not None

    def probe(batches):
        import numpy as np
        import pyarrow as pa

        begin = hashes([_BEGIN])[0]
        for batch in by_bytes(batches, "text"):
            kept = [batch.column("__own"), batch.column("__train")]
            streams = [_stream([t])[0] for t in batch.column("text").to_pylist()]
            sizes = [len(x) for x in streams]
            cuts = np.cumsum([0, *sizes])
            words = np.concatenate(streams)
            found = batch.column("levels").to_pylist()
            found = None if found[0] is None else np.concatenate([np.frombuffer(k, dtype=np.uint8).reshape(model.order, -1) for k in found], axis=1).tobytes()
            levels = _levels(words, found, model, part.value)
            levels = pa.array([levels[:, a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())
            if not last:
                yield pa.RecordBatch.from_arrays([*kept, batch.column("text"), levels], ["__own", "__train", "text", "levels"])
                continue
            table, count = frequent.value
            token = words != begin
            spot = np.searchsorted(table, words).clip(max=max(0, len(table) - 1))
            here = (table[spot] == words) & token if len(table) else np.zeros(len(words), dtype=bool)
            c = np.where(here, count[spot], 0) if len(table) else np.zeros(len(words), dtype=np.int64)
            base = np.where(here, np.log10((c + 1) / (model.tokens + model.types + 1)), 0.0)
            lone = token & ~here
            rare, times, offsets = [], [], [0]
            for a, b in zip(cuts, cuts[1:], strict=False):
                h, n = np.unique(words[a:b][lone[a:b]], return_counts=True)
                rare.append(h)
                times.append(n)
                offsets.append(offsets[-1] + len(h))
            at = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays([
                *kept, levels, pa.array(np.array(sizes, dtype=np.int64) - 1), pa.array(np.add.reduceat(here.astype(np.int64), cuts[:-1])), pa.array(np.add.reduceat(base, cuts[:-1])),
                pa.ListArray.from_arrays(at, pa.array(np.concatenate(rare).view(np.int64))), pa.ListArray.from_arrays(at, pa.array(np.concatenate(times).astype(np.int64))),
            ], ["__own", "__train", "levels", "n_tokens", "n_known", "base_score", "rare", "times"])

    if not last:
        return rows.mapInArrow(probe, rows.schema)
    return rows.mapInArrow(probe, rows.select("__own", "__train", "levels", *(F.lit(None).cast(t).alias(n) for n, t in (("n_tokens", "bigint"), ("n_known", "bigint"), ("base_score", "double"), ("rare", "array<bigint>"), ("times", "array<bigint>")))).schema)


def _joined(column, model: Model):
    """(levels, starts) of a batch's texts."""
    import numpy as np

    each = [np.frombuffer(k, dtype=np.uint8).reshape(model.order, -1) for k in column.to_pylist()]
    return np.concatenate(each, axis=1), np.cumsum([0, *(x.shape[1] for x in each[:-1])])


def _seen(levels: DataFrame, model: Model):
    """model.seen() over all rows: tasks sum up a small table each."""
    import numpy as np

    def count(batches):
        import pyarrow as pa

        total = np.zeros((model.order + 1, 64, 64), dtype=np.int64)
        for batch in by_bytes(batches, "levels"):
            total += model.seen(*_joined(batch.column("levels"), model))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total.ravel()[at])], ["at", "n"])

    out = np.zeros((model.order + 1) * 4096, dtype=np.int64)
    for r in levels.mapInArrow(count, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return out.reshape(model.order + 1, 64, 64)


def _logs(found: DataFrame, model: Model) -> DataFrame:
    """found with the score in place of the levels."""
    kept = ["__row", "__own", "n_tokens", "n_known", "base_score"]

    def score(batches):
        import numpy as np
        import pyarrow as pa

        for batch in by_bytes(batches, "levels"):
            levels, starts = _joined(batch.column("levels"), model)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(np.add.reduceat(model.logs(levels, starts), starts))], [*kept, "score"])

    rows = found.select(*kept, "levels")
    return rows.mapInArrow(score, rows.drop("levels").withColumn("score", F.lit(0.0)).schema)


def op13_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    out = scored(docs.withColumn("held_out", held), ~held)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
