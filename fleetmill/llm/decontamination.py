"""Benchmark decontamination: benchmark n-grams as a broadcast hash set, training texts scanned for them.

Words are runs of ASCII letters (lower-cased) and digits and of all characters
beyond ASCII. Each item gives its windows of ``width`` words, which executors
cut and hash; a shorter item is one window. Only hashes are broadcast, eight
bytes a distinct window, and no more than ``slice_windows`` at a time: larger
benchmarks are dealt into slices by hash, and the documents are scanned once a
slice. A scan rolls a hash over each document's words; what hits the set is
verified by a join with the windows' words, and only such rows are shuffled: one
for each distinct window of a document, with its places. A window is one row
whatever the number of its items: it holds a digest of their set, and sets are
expanded once for each combination of sets that documents have.
"""

from __future__ import annotations

import hashlib

from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HASHES, Scratch, arrow_batches, sliced, small, table, written

WIDTH = 10
#: Distinct windows broadcast at once, 8 bytes each and two bytes of flags.
SLICE_WINDOWS = 4_000_000
_FACTOR = 0x9E3779B97F4A7C15
_WINDOW, _SET = ["size", "hash", "window"], ["x", "y", "z"]


def _byte_table() -> bytes:
    """Maps A-Z to a-z, other ASCII signs to a space, and all else to itself."""
    keep = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
    return bytes(b + 32 if 65 <= b <= 90 else b if b in keep else 32 for b in range(256))


_TABLE = _byte_table()


def words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode().translate(_TABLE).split()


def word_hashes(own: list[bytes]):
    import numpy as np

    return np.fromiter(map(HASHES.__getitem__, own), dtype=np.uint64, count=len(own))


def rolled(hashes, width: int):
    """The hash of each run of ``width`` word hashes; empty if there are fewer."""
    import numpy as np

    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        out = out * np.uint64(_FACTOR) + hashes[i : i + n]
    out ^= out >> np.uint64(31)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def windows(items: DataFrame, width: int = WIDTH, rows: int = 10_000) -> DataFrame:
    """(item, size, hash, window) of items (item, text): the words of each window, with a space between. An item of any length goes out in batches."""

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = words(text)
                size = min(width, len(own))
                if not size:
                    continue
                h = rolled(word_hashes(own), size).view("int64")
                for low in range(0, len(h), rows):
                    part = h[low : low + rows]
                    text_of = [b" ".join(own[i : i + size]) for i in range(low, low + len(part))]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(part), pa.string()), pa.array([size] * len(part), pa.int32()), pa.array(part), pa.array(text_of, pa.binary())], ["item", "size", "hash", "window"])

    return items.select("item", "text").mapInArrow(cut, "item string, size int, hash bigint, window binary")


class _HashSet:
    """Window hashes by size, to look up arrays of hashes."""

    def __init__(self, by_size: dict):
        import numpy as np

        self.tables = []
        for size, hashes in by_size.items():
            known = np.sort(hashes.view(np.uint64))
            flags = np.zeros(1 << max(16, (len(known) * 16).bit_length()), dtype=bool)
            flags[(known & np.uint64(len(flags) - 1)).astype(np.int64)] = True
            self.tables.append((size, known, flags))

    def hits(self, hashes):
        """(size, places, hash) of each distinct window of a text, given its words' hashes, that is in the set."""
        import numpy as np

        for size, known, flags in self.tables:
            h = rolled(hashes, size)
            at = np.flatnonzero(flags[(h & np.uint64(len(flags) - 1)).astype(np.int64)])
            if len(at):
                k = np.minimum(np.searchsorted(known, h[at]), len(known) - 1)
                at = at[known[k] == h[at]]
                at = at[np.argsort(h[at], kind="stable")]
                for places in np.split(at, np.flatnonzero(np.diff(h[at])) + 1) if len(at) else []:
                    yield size, places.tolist(), h[places[0]]


def _scanned(docs: DataFrame, sent: Broadcast, text: str, columns: list[str], n_words: str) -> DataFrame:
    """The columns, the number of words, and ``__hits``: the windows whose hash is in the set."""
    def scan(batches):
        import numpy as np
        import pyarrow as pa

        known = _HashSet(sent.value)
        kind = pa.list_(pa.struct([("size", pa.int32()), ("places", pa.list_(pa.int64())), ("hash", pa.int64()), ("window", pa.binary())]))
        for batch in sliced(batches):
            n, hits = [], []
            for t in batch.column("__text").to_pylist():
                own = words(t)
                n.append(len(own))
                found = known.hits(word_hashes(own))
                hits.append([{"size": s, "places": at, "hash": int(h.astype(np.int64)), "window": b" ".join(own[at[0] : at[0] + s])} for s, at, h in found])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(n, pa.int64()), pa.array(hits, kind)], [*columns, n_words, "__hits"])

    new = {n_words: "bigint", "__hits": "array<struct<size:int,places:array<bigint>,hash:bigint,window:binary>>"}
    schema = docs.select(*columns).withColumns({k: F.lit(None).cast(v) for k, v in new.items()}).schema
    return docs.select(*columns, F.col(text).alias("__text")).mapInArrow(scan, schema)


def _slices(found: DataFrame, slices: int):
    """The distinct hashes by size, a slice at a time."""
    import numpy as np

    distinct = found.select("size", "hash").distinct()
    for k in range(slices):
        part = distinct.where(F.pmod(F.xxhash64("hash"), F.lit(slices)) == k).toArrow()
        size, h = part.column("size").to_numpy(), part.column("hash").to_numpy()
        yield {int(s): h[size == s] for s in np.unique(size)}


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None, width: int = WIDTH, slice_windows: int = SLICE_WINDOWS, names: tuple[str, str, str, str] = ("n_words", "spans", "items", "n_hit")
) -> DataFrame:
    """For each document the columns ``keep`` (all by default) and, by ``names``, n_words, spans (of hit words, merged), items (sorted ids as strings), n_hit.

    ``benchmark`` has item_id and text. A null or empty text has no words and no
    hits; texts and items of any length are read whole. Items without words, and
    items without an id, give no windows. Rows with the same item_id are one
    item, and a window of several items hits them all. Repeated documents are
    judged each on its own; without windows no document is hit; an empty table
    gives no rows. Kept columns with one of ``names`` are replaced.
    """
    n_words, spans, items, n_hit = names
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]
    with Scratch(docs.sparkSession) as scratch, arrow_batches(docs.sparkSession, 500):
        named = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item"), "text")
        found = scratch.write(windows(named, width), "windows")
        # A window once; windows of the same items have the same digest of them.
        digest = [F.bit_xor(F.xxhash64("item")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "item")).alias("y"), F.count("*").alias("z")]
        once = scratch.write(found.distinct().groupBy(*_WINDOW).agg(*digest), "once")
        slices = once.count() // slice_windows + 1
        docs = docs.withColumn("__row", F.monotonically_increasing_id())
        docs = docs if slices == 1 else scratch.write(docs.select(*{*keep, text}, "__row"), "rows")
        parts = []
        for k, by_size in enumerate(_slices(once, slices)):
            sent = docs.sparkSession.sparkContext.broadcast(by_size)
            part = _scanned(docs, sent, text, [*keep, "__row"] if k == 0 else ["__row"], n_words)
            parts.append(written(part, "scanned") if k == 0 else scratch.write(part.where(F.size("__hits") > 0).select("__row", "__hits"), "hits"))
            sent.unpersist()  # the slice's rows are written
        hits = parts[0].where(F.size("__hits") > 0).select("__row", "__hits")
        for part in parts[1:]:
            hits = hits.unionByName(part)
        each = hits.select("__row", F.inline("__hits"))
        good = each.join(small(once), _WINDOW)
        span = F.transform("places", lambda low: F.struct(low.alias("low"), (low + F.col("size")).alias("high")))
        by_row = good.groupBy("__row").agg(F.array_sort(F.flatten(F.collect_list(span))).alias(spans), F.array_sort(F.collect_set(F.struct(*_SET))).alias("__sets"))
        by_row = scratch.write(by_row.withColumns({"__a": F.xxhash64("__sets"), "__b": F.xxhash64(F.lit(1), "__sets")}), "by-row")
        used = by_row.groupBy("__a", "__b").agg(F.first("__sets").alias("__sets")).select("__a", "__b", F.inline("__sets"))
        listed = used.join(_item_lists(found, once), _SET).groupBy("__a", "__b").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("of")))).alias(items))
        judged = written(_merged(by_row.join(listed, ["__a", "__b"]).select("__row", spans, items), spans, items, n_hit), "judged")
    none = {spans: F.array().cast("array<struct<low:bigint,high:bigint>>"), items: F.array().cast("array<string>"), n_hit: F.lit(0).cast("bigint")}
    joined = parts[0].drop("__hits").join(small(judged), "__row", "left")
    return joined.select(*keep, n_words, *(F.coalesce(c, v).alias(c) for c, v in none.items()))


def _item_lists(found: DataFrame, once: DataFrame) -> DataFrame:
    """(x, y, z, of): each set of items, a row a set, from the items of one window that has it."""
    one = once.groupBy(*_SET).agg(F.min(F.struct(*_WINDOW)).alias("w")).select(*_SET, "w.*")
    return found.distinct().join(one, _WINDOW).groupBy(*_SET).agg(F.collect_list("item").alias("of"))


def _merged(judged: DataFrame, spans: str, items: str, n_hit: str) -> DataFrame:
    """Sorted spans united where they touch, with their number of words."""

    def unite(batches):
        import pyarrow as pa

        for batch in batches:
            out, n = [], []
            for row in batch.column(spans).to_pylist():
                one: list[dict] = []
                for s in row:
                    if one and s["low"] <= one[-1]["high"]:
                        one[-1]["high"] = max(one[-1]["high"], s["high"])
                    else:
                        one.append(dict(s))
                out.append(one)
                n.append(sum(s["high"] - s["low"] for s in one))
            yield pa.RecordBatch.from_arrays([batch.column("__row"), pa.array(out, pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))), batch.column(items), pa.array(n, pa.int64())], ["__row", spans, items, n_hit])

    return judged.mapInArrow(unite, f"__row bigint, {spans} array<struct<low:bigint,high:bigint>>, {items} array<string>, {n_hit} bigint")


def without_spans(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs whose hit spans are cut out of the text: what stands between the first and last word of each.

    ``found`` is the result of contamination() with ``key``; keys are unique here.
    """

    names = docs.columns

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for t, spans in zip(batch.column(text).to_pylist(), batch.column("__spans").to_pylist(), strict=True):
                out.append(t if t is None or not spans else cut_text(t, [(s["low"], s["high"]) for s in spans]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if c == text else batch.column(c) for c in names], names)

    hits = found.where("n_hit > 0").select(key, F.col("spans").alias("__spans"))
    return docs.join(hits, key, "left").select(*names, "__spans").mapInArrow(cut, docs.schema)


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans of its words."""
    import re

    at = [m.span() for m in re.finditer(rb"[^\x20]+", text.encode().translate(_TABLE))]
    raw, out, end = text.encode(), [], 0
    for a, b in spans:
        out.append(raw[end : at[a][0]])
        end = at[b - 1][1]
    return b"".join([*out, raw[end:]]).decode()


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    ids = F.sha2(F.concat_ws(",", "items"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), ids.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def brute_force(rows: list[tuple], items: list[tuple], width: int = WIDTH) -> list[tuple]:
    """The digest of op4 by plain comparison, for tests: rows (doc_id, text), items (item_id, text)."""
    out = []
    for doc, text in rows:
        own, hit, ids = words(text), set(), set()
        for item, t in items:
            if item is None or t is None:
                continue
            w = words(t)
            size = min(width, len(w))
            for i in range(len(w) - size + 1 if w else 0):
                for j in range(len(own) - size + 1):
                    if own[j : j + size] == w[i : i + size]:
                        hit |= set(range(j, j + size))
                        ids.add(str(item))
        out.append((doc, len(own), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out
