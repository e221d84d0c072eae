"""Phrase mining by set-oriented relations (SETM).

An occurrence relation R_k holds a row a text: the sorted places where frequent
phrases of k words start, and their groups. Places count words through the
text, with a gap between pieces, so neighbours in a relation are neighbours in
a piece. R_k is merge-joined with itself at adjacent places, which gives the
occurrences of phrases of k + 1 words; these are counted by group; groups below
the threshold go, and R_k+1, the occurrences of those left, is written before
the next length is made. A phrase's group is a 64-bit hash of its language and
words.

Only counts are shuffled, summed by tasks first. Occurrences are reduced to
frequent groups by a Bloom filter of at most ``FILTER_SEGMENTS`` MiB, whatever
the number of groups: what it lets through beyond them is counted and dropped
at the next length, and no count depends on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bloom import filled, mixed, read_slice, segment_of, segments_for
from .common import Scratch, arrow_batches, sliced, table, written
from .packed import Ranges
from .words import by_bytes, counted, hashes

#: MiB of the filter of frequent groups at most.
FILTER_SEGMENTS = 32
#: Occurrences that a task counts at once, and bytes of text that become words at once.
AT_ONCE = 1 << 21
CHUNK = 1 << 20
#: Tasks that pick a language's first phrases before one merges theirs.
SHARES = 32
#: Distinct words that a task counts at once.
KEPT_WORDS = 300_000
#: Occurrences for each range of groups that is summed up at once.
RANGE = 1 << 20
#: Groups for each range of them whose parts are merged at once.
PARTS = 1 << 16
#: Rows that go to a Python worker at once.
ROWS = 1000

_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(ord(".") if b in _SEPARATORS else ord(" ") if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def _seed(lang: str):
    import numpy as np
    import xxhash

    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), seed=1))


def _groups(words: list[bytes], seed):
    """64-bit hashes of a language's words."""
    return mixed(hashes(words) + seed)


def _pieces(text: bytes):
    """(words, places) of a text, some at a time: cut behind a separator, or a long piece between words."""
    import numpy as np

    text, low, at = text.translate(_TABLE), 0, 0
    while low < len(text):
        high = low + CHUNK
        while high < len(text) and text[high] not in b" .":
            high += 1
        words = text[low:high].replace(b".", b" . ").split(b" ")
        words = [w for w in words if w]
        mark = np.fromiter((w == b"." for w in words), dtype=bool, count=len(words))
        # A separator takes a place of its own, so the words around it aren't neighbours.
        places = at + np.flatnonzero(~mark)
        yield [w for w in words if w != b"."], places
        at += len(words)
        low = high


def _lists(offsets, values):
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, g, word, n) of every word of (lang, text); a row without a word has a language's number of word occurrences."""

    def count(batches):
        from collections import Counter

        import pyarrow as pa

        seen: dict = {}

        def rows():
            for lang, words in seen.items():
                items = list(words.items())
                for low in range(0, len(items), 10_000):
                    part = items[low : low + 10_000]
                    g = _groups([w for w, _ in part], _seed(lang)).view("int64")
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array(g), pa.array([w.decode() for w, _ in part]), pa.array([n for _, n in part], pa.int64())], ["lang", "g", "word", "n"])
                total = sum(words.values())
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([0], pa.int64()), pa.array([None], pa.string()), pa.array([total], pa.int64())], ["lang", "g", "word", "n"])
            seen.clear()

        for batch in sliced(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = seen.setdefault(lang, Counter())
                for words, _ in _pieces(text):
                    own.update(words)
            if sum(map(len, seen.values())) > KEPT_WORDS:
                yield from rows()
        yield from rows()

    return docs.mapInArrow(count, "lang string, g bigint, word string, n bigint").groupBy("lang", "g", "word").agg(F.sum("n").alias("n"))


def _occurrences(docs: DataFrame, part) -> DataFrame:
    """R_1: (at, g), a row a text, of the words that pass the filter."""

    def find(batches):
        import numpy as np
        import pyarrow as pa

        for batch in by_bytes(batches, "text"):
            langs, places, groups, offsets = batch.column("lang").to_pylist(), [], [], [0]
            for lang, text in zip(langs, batch.column("text").to_pylist(), strict=True):
                seed, total = _seed(lang), 0
                for words, at in _pieces(text):
                    g = _groups(words, seed)
                    keep = part.value.levels(g) > 0
                    places.append(at[keep])
                    groups.append(g[keep])
                    total += int(keep.sum())
                offsets.append(offsets[-1] + total)
            at = np.concatenate(places) if places else np.empty(0, np.int64)
            g = np.concatenate(groups) if groups else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([_lists(offsets, pa.array(at.astype(np.int64))), _lists(offsets, pa.array(g.view(np.int64)))], ["at", "g"])

    return docs.mapInArrow(find, "at array<bigint>, g array<bigint>").where(F.size("at") > 1)


def _merged(batch):
    """(row, at, g, head, tail) of the phrases one word longer: a merge join of a relation with itself at adjacent places."""
    import numpy as np

    at, g = (batch.column(c) for c in ("at", "g"))
    sizes = np.diff(at.offsets.to_numpy())
    row = np.repeat(np.arange(len(sizes)), sizes)
    at, g = at.flatten().to_numpy(), g.flatten().to_numpy().view(np.uint64)
    # Rows are sorted by place, so what continues a phrase is the next row or isn't there.
    first = np.flatnonzero((at[1:] == at[:-1] + 1) & (row[1:] == row[:-1]))
    head, tail = g[first], g[first + 1]
    return row[first], at[first], mixed(head * np.uint64(0x9E3779B97F4A7C15) + tail), head, tail


def _batches(batches):
    """Arrow batches of (at, g) of about a million occurrences at most, or one row."""
    import numpy as np

    for batch in batches:
        sizes = np.diff(batch.column("at").offsets.to_numpy())
        low = total = 0
        for i, n in enumerate(sizes.tolist()):
            if i > low and total + n > AT_ONCE // 2:
                yield batch.slice(low, i - low)
                low, total = i, 0
            total += n
        if batch.num_rows > low:
            yield batch.slice(low)


def group_counts(relation: DataFrame, least: int) -> DataFrame:
    """(g, n) of the phrases one word longer than the relation's, from ``least`` occurrences on."""
    held = relation.agg(F.sum(F.size("at"))).first()[0] or 0
    ranges = Ranges(relation.sparkSession, -(-held // RANGE))

    def count(batches):
        import numpy as np

        kept, held = [], 0
        for batch in _batches(batches):
            g = _merged(batch)[2]
            kept.append(g)
            held += len(g)
            if held >= AT_ONCE:
                yield from ranges.rows(*counted(np.concatenate(kept)), 1)
                kept, held = [], 0
        if held:
            yield from ranges.rows(*counted(np.concatenate(kept)), 1)

    return ranges.summed(relation.mapInArrow(count, Ranges.KIND), {1: least}).select(F.col("h").alias("g"), "n")


def _distinct(rows):
    """Rows (g, head, tail), one a group, ascending."""
    import numpy as np

    return rows[np.unique(rows[:, 0], return_index=True)[1]]


def united(batches):
    """Arrow batches (g, head, tail), one a range, of packed rows of ranges in order."""
    import numpy as np
    import pyarrow as pa

    at, own, held = None, [], 0

    def merged():
        rows = _distinct(np.concatenate(own)).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(3)], ["g", "head", "tail"])

    for batch in batches:
        for bucket, rows in zip(batch.column("bucket"), batch.column("rows"), strict=True):
            bucket = bucket.as_py()
            if bucket != at:
                if own:
                    yield merged()
                at, own, held = bucket, [], 0
            own.append(np.frombuffer(rows.as_py(), dtype=np.uint64).reshape(-1, 3))
            held += len(own[-1])
            if held > max(4 * PARTS, 2 * len(own[0])):
                own = [_distinct(np.concatenate(own))]
                held = len(own[0])
    if own:
        yield merged()


def group_parts(relation: DataFrame, part, groups: int) -> DataFrame:
    """(g, head, tail) of those phrases that pass the filter, about so many: the groups without the last and without the first word.

    Tasks send what they saw as packed rows, one for each range of groups. All
    tasks see nearly all frequent groups, so what is held of them is reduced to
    one row a group as it grows, on both sides: it is bounded by a range's
    groups, not by the number of tasks.
    """
    ranges = max(1, -(-groups // PARTS))

    def find(batches):
        import numpy as np
        import pyarrow as pa

        kept, held = [], 0

        def flush(rows):
            of = segment_of(rows[:, 0], ranges).astype(np.int64)
            cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]]))
            return pa.RecordBatch.from_arrays([pa.array(of[cuts[:-1]]), pa.array([rows[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())], ["bucket", "rows"])

        for batch in _batches(batches):
            _, _, g, head, tail = _merged(batch)
            keep = np.flatnonzero(part.value.levels(g) > 0)
            kept.append(_distinct(np.stack([g[keep], head[keep], tail[keep]], axis=1)))
            held += len(kept[-1])
            if held > AT_ONCE // 2:
                kept = [_distinct(np.concatenate(kept))]
                held = len(kept[0])
                if held > AT_ONCE // 4:
                    yield flush(kept[0])
                    kept, held = [], 0
        if held:
            yield flush(_distinct(np.concatenate(kept)))

    sent = relation.mapInArrow(find, "bucket bigint, rows binary").repartition("bucket").sortWithinPartitions("bucket")
    return sent.mapInArrow(united, "g bigint, head bigint, tail bigint")


def _longer(relation: DataFrame, part) -> DataFrame:
    """R_k+1 from R_k: the merge join, semi-joined with the frequent groups."""

    def extend(batches):
        import numpy as np
        import pyarrow as pa

        for batch in _batches(batches):
            row, at, g, _, _ = _merged(batch)
            keep = part.value.levels(g) > 0
            offsets = np.concatenate([[0], np.cumsum(np.bincount(row[keep], minlength=batch.num_rows))])
            yield pa.RecordBatch.from_arrays([_lists(offsets, pa.array(at[keep])), _lists(offsets, pa.array(g[keep].view(np.int64)))], ["at", "g"])

    return relation.mapInArrow(extend, relation.schema).where(F.size("at") > 1)


def _frequent(groups: DataFrame, scratch: Scratch):
    """(the filter of some groups, broadcast; their number)."""
    keys = groups.select(F.col("g").alias("h"), F.lit(1).alias("levels"))
    number = keys.count()
    segments = min(FILTER_SEGMENTS, segments_for(number))
    bits = scratch.write(filled(keys, segments), "filter")
    return keys.sparkSession.sparkContext.broadcast(read_slice(bits, 0, segments, segments)), number


def phrases(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, cover: int = 100, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to ``longest`` words.

    A phrase occurs ``least`` times or more (a) within pieces, pieces being cut
    at .,;:!? and line ends, words at spaces and tabs. It is scored at its
    lowest cut into a first part (l times) and a rest (r times):
    floor(1000 a n / (l r)), n being the language's words; of equal scores the
    shortest first part's. A phrase within a longer one that is frequent too
    and occurs at least ``cover`` % as often is left out. Null texts are
    empty, a null language is ``und``; repeated rows count each; no other column
    is read; texts and words of any length are taken whole. An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8").alias("text"))
    with Scratch(spark) as scratch, arrow_batches(spark, ROWS):
        known = scratch.write(word_counts(docs).where((F.col("n") >= least) | F.col("word").isNull()), "words")
        totals = F.broadcast(known.where("word is null").select("lang", F.col("n").alias("total")))  # a row a language
        # Of each frequent phrase: its words, and how often its beginnings and ends occur, from one word up.
        none = F.array().cast("array<bigint>")
        group = known.where("word is not null").select("g", "lang", F.array("word").alias("words"), "n", none.alias("begins"), none.alias("ends"))
        group = scratch.write(group, "groups-1")
        part, _ = _frequent(group, scratch)
        relation, found = scratch.write(_occurrences(docs, part), "occurrences-1"), []
        for k in range(2, longest + 1):
            path = scratch.paths[-1]
            counts = scratch.write(group_counts(relation, least), f"counts-{k}")
            part.unpersist()
            part, number = _frequent(counts, scratch)
            head = group.select(F.col("g").alias("head"), "lang", F.col("words").alias("w"), F.concat("begins", F.array("n")).alias("begins"))
            tail = group.select(F.col("g").alias("tail"), F.element_at("words", -1).alias("last"), F.concat("ends", F.array("n")).alias("ends"))
            group = counts.join(group_parts(relation, part, number), "g").join(head, "head").join(tail, "tail").select("g", "lang", F.concat("w", F.array("last")).alias("words"), "n", "begins", "ends", "head", "tail")
            group = scratch.write(group, f"groups-{k}")
            found.append(group)
            if k < longest:
                relation = scratch.write(_longer(relation, part), f"occurrences-{k}")
                scratch.remove(path)
        part.unpersist()
        kept = []
        for k, own in enumerate(found):
            if k + 1 < len(found):
                longer = found[k + 1]
                over = longer.select(F.explode(F.array("head", "tail")).alias("g"), F.col("n").alias("m")).groupBy("g").agg(F.max("m").alias("m"))
                own = own.join(over, "g", "left").where(F.col("m").isNull() | (F.lit(100) * F.col("m") < F.lit(cover) * F.col("n"))).drop("m")
            kept.append(own.drop("head", "tail"))
        every = kept[0]
        for own in kept[1:]:
            every = every.unionByName(own)
        wide = lambda c: c.cast("decimal(19,0)")
        # The k-th cut has begins[k] before it and the end of what is left behind it.
        every = every.join(totals, "lang").withColumn("_a", (wide(F.col("n")) * 1000 * wide(F.col("total"))).cast("decimal(38,0)"))
        cut = F.transform("begins", lambda x, i: F.struct(x.alias("l"), F.element_at("ends", F.size("ends") - i).alias("r"), i.alias("k")))
        every = every.select("g", "lang", F.array_join("words", " ").alias("phrase"), F.col("n").alias("a"), F.col("total").alias("n"), "_a", F.explode(cut).alias("c"))
        every = every.withColumn("score", F.expr("_a div (cast(c.l as decimal(19,0)) * cast(c.r as decimal(19,0)))"))
        least_cut = F.min(F.struct("score", "c.k", "c.l", "c.r")).alias("m")
        every = every.groupBy("g", "lang", "phrase", "a", "n").agg(least_cut).select("g", "lang", "phrase", "a", "m.l", "m.r", "n", "m.score")
        order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
        every = every.withColumn("_s", F.pmod("g", F.lit(SHARES))).withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_s").orderBy(*order))).where(F.col("_r") <= top)
        ranked = every.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
        return written(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "phrases")


def op11_phrases(spark, sf_dir: str) -> DataFrame:
    return phrases(table(spark, sf_dir, "documents").select("lang", "text"))
