"""Token-id shards with a minimal perfect hash index for keyed access.

Texts are encoded in ascending key order and written as shards: raw 16-bit ids
end to end, and an index from key to place. The index is a minimal perfect hash
(levels of bit arrays; a key takes the first level at which it met no other)
whose slots hold a fingerprint, a start and a length. Reading a key is one hash
a level, one fingerprint to compare and one slice: constant time, without a
search and without the keys. Shards are rows of a Parquet table in the shared
folder, so any store that Spark writes to holds them.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, arrow_batches, sliced, small, table, written
from .encoding import tokenizer_path, word_encoder

#: Ids in a shard, but for a longer document.
SHARD_TOKENS = 1_000_000
_KINDS = {"part": "int", "shard": "int", "n_docs": "bigint", "n_tokens": "bigint", "low": "bigint", "high": "bigint", "payload": "binary", "keys": "binary", "repeats": "binary", "sizes": "array<int>", "bits": "binary", "left": "binary", "marks": "binary", "starts": "binary", "lengths": "binary"}
SCHEMA = ", ".join(f"{k} {v}" for k, v in _KINDS.items())
#: Stands for a null key; it sorts first, as null does.
NULL_KEY = -(1 << 63)


def mix(x):
    """A 64-bit finaliser, over arrays."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(keys, repeats):
    """The hash of (key, number among rows of the key)."""
    import numpy as np

    return mix(mix(np.asarray(keys, dtype=np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) + np.asarray(repeats, dtype=np.uint64))


class PerfectHash:
    """slots(): distinct hashes to distinct numbers below their count; other hashes to any, or -1."""

    def __init__(self, sizes: list[int], bits: bytes, left: bytes):
        import numpy as np

        self.sizes, self.left = sizes, np.frombuffer(left, dtype="<u8")
        self.bits = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=sum(sizes)).astype(bool)
        self.rank = np.concatenate(([0], np.cumsum(self.bits)))

    @classmethod
    def build(cls, hashes, gamma: float = 2.0) -> PerfectHash:
        import numpy as np

        rest, sizes, levels = np.asarray(hashes, dtype=np.uint64), [], []
        while len(rest) and len(sizes) < 24:
            size = max(64, int(gamma * len(rest)))
            at = cls._at(rest, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            sizes.append(size)
            rest = rest[~alone[at]]
        bits = np.packbits(np.concatenate(levels)) if levels else np.empty(0, dtype=np.uint8)
        return cls(sizes, bits.tobytes(), np.sort(rest).astype("<u8").tobytes())

    @staticmethod
    def _at(hashes, level: int, size: int):
        import numpy as np

        return (mix(hashes + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(size)).astype(np.int64)

    def slots(self, hashes):
        import numpy as np

        hashes = np.asarray(hashes, dtype=np.uint64)
        out, base = np.full(len(hashes), -1, dtype=np.int64), 0
        rest = np.arange(len(hashes))
        for level, size in enumerate(self.sizes):
            at = base + self._at(hashes[rest], level, size)
            hit = self.bits[at]
            out[rest[hit]] = self.rank[at[hit]]
            rest, base = rest[~hit], base + size
        if len(rest) and len(self.left):  # keys that met another at every level
            at = np.minimum(np.searchsorted(self.left, hashes[rest]), len(self.left) - 1)
            same = self.left[at] == hashes[rest]
            out[rest[same]] = self.rank[-1] + at[same]
        return out


def _shard(part: int, number: int, keys: list[int], repeats: list[int], payload: list[bytes]) -> dict:
    import numpy as np

    lengths = np.array([len(p) // 2 for p in payload], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    hashes = key_hash(keys, repeats)
    index = PerfectHash.build(hashes)
    slot = index.slots(hashes)
    tables = np.zeros((3, len(keys)), dtype="<u4")
    tables[0, slot], tables[1, slot], tables[2, slot] = (hashes >> np.uint64(32)).astype(np.uint32), starts, lengths
    bits = np.packbits(index.bits).tobytes()
    return {
        "part": part, "shard": number, "n_docs": len(keys), "n_tokens": int(lengths.sum()), "low": keys[0], "high": keys[-1], "payload": b"".join(payload),
        "keys": np.array(keys, dtype="<i8").tobytes(), "repeats": np.array(repeats, dtype="<u4").tobytes(), "sizes": index.sizes, "bits": bits, "left": index.left.tobytes(), "marks": tables[0].tobytes(), "starts": tables[1].tobytes(), "lengths": tables[2].tobytes(),
    }


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end_id: int = 1, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the shards of the encoded texts and returns them as a table, with ``base``: ids in all shards before.

    Keys are integers or null; a null key comes first. Rows of equal key keep
    the order of their texts' hashes and are told apart by a running number. A
    null or empty text has the end id alone; a text of any length is one record.
    An empty table gives no shards; no other column is read.
    """
    # Equal keys may be split over tasks: the texts' hash is part of the range.
    order = [F.col("__key").asc(), F.xxhash64("__text").asc()]
    rows = docs.select(F.coalesce(F.col(key).cast("bigint"), F.lit(NULL_KEY)).alias("__key"), F.coalesce(text, F.lit("")).alias("__text"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order, "__text")

    def encode(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, number, last, repeat = TaskContext.get().partitionId(), 0, None, 0
        encoder, end = word_encoder(path), end_id.to_bytes(2, "little")
        keys, repeats, payload, size = [], [], [], 0

        def out():
            return pa.RecordBatch.from_pylist([_shard(part, number, keys, repeats, payload)], schema=arrow)

        arrow = pa.schema([(k, {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}.get(v, pa.list_(pa.int32()))) for k, v in _KINDS.items()])
        for batch in sliced(batches):
            for k, ids in zip(batch.column(0).to_pylist(), encoder.encode_batch(batch.column(1).to_pylist()), strict=True):
                repeat = repeat + 1 if k == last else 0
                last = k
                keys.append(k)
                repeats.append(repeat)
                payload.append(ids + end)
                size += len(ids) // 2 + 1
                if size >= shard_tokens:
                    yield out()
                    number, keys, repeats, payload, size = number + 1, [], [], [], 0
        if keys:
            yield out()

    shards = written(rows.mapInArrow(encode, SCHEMA), "token-shards")
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    places = shards.select("part", "shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))  # a row a shard
    return shards.join(small(places, 100_000), ["part", "shard"])


class Reader:
    """Keyed access to one shard, given as a row's fields."""

    def __init__(self, row: dict):
        import numpy as np

        self.payload = row["payload"]
        self.index = PerfectHash(row["sizes"], row["bits"], row["left"])
        self.marks, self.starts, self.lengths = (np.frombuffer(row[k], dtype="<u4") for k in ("marks", "starts", "lengths"))

    def find(self, keys, repeats):
        """(starts, lengths) of the keys in the shard; the length is -1 where a key isn't in it."""
        import numpy as np

        hashes = key_hash(keys, repeats)
        slot = self.index.slots(hashes)
        there = (slot >= 0) & (self.marks[slot] == (hashes >> np.uint64(32)).astype(np.uint32))
        return self.starts[slot].astype(np.int64), np.where(there, self.lengths[slot].astype(np.int64), -1)

    def ids(self, start: int, length: int):
        import numpy as np

        return np.frombuffer(self.payload, dtype="<u2", count=length, offset=2 * start)


def read_back(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, by keyed reads of the shards."""

    def read(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                reader = Reader(row)
                keys = np.frombuffer(row["keys"], dtype="<i8")
                starts, lengths = reader.find(keys, np.frombuffer(row["repeats"], dtype="<u4"))
                if (lengths < 0).any():
                    raise ValueError(f"shard {row['part']}/{row['shard']}: a key isn't found")
                crc = [zlib.crc32(reader.ids(a, n).astype("<u4").tobytes()) for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(keys, mask=keys == NULL_KEY), pa.array(starts + row["base"]), pa.array(lengths), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    with arrow_batches(shards.sparkSession, 2):  # rows of some MB
        return written(shards.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"), "read-back")


def lookup(shards: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc_id, ids) of the keys (doc_id) that the shards have; of repeated keys, the first row.

    Keys go to the first part, and in it to the first shard, that ends at or
    after them: parts are as many as the writer's partitions, so a table of
    their ends is small, and a shard is met by its keys in one join. A key that
    spans shards is in the first one that it could be in.
    """
    places = shards.select("part", "shard", "low", "high")
    parts = sorted(places.groupBy("part").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect())  # a row a partition of the writer
    ends = shards.sparkSession.sparkContext.broadcast([(r.part, r.low, r.high) for r in parts])

    def route(batches):
        import numpy as np
        import pyarrow as pa

        part, low, high = (np.array(x, dtype=np.int64) for x in (zip(*ends.value, strict=True) if ends.value else ([], [], [])))
        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False)
            at = np.searchsorted(high, k)
            hit = at < len(high)
            hit[hit] &= low[at[hit]] <= k[hit]
            yield pa.RecordBatch.from_arrays([pa.array(k[hit]), pa.array(part[at[hit]].astype(np.int32))], ["k", "part"])

    def read(left, right):
        import numpy as np
        import pyarrow as pa

        if not left.num_rows or not right.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int32()))})
        reader, want = Reader(right.to_pylist()[0]), left.column("k").to_numpy()
        starts, lengths = reader.find(want, np.zeros(len(want), dtype=np.uint32))
        hit = np.flatnonzero(lengths >= 0).tolist()
        return pa.table({"doc_id": pa.array(want[hit], pa.int64()), "ids": pa.array([reader.ids(starts[k], lengths[k]).tolist() for k in hit], pa.list_(pa.int32()))})

    wanted = keys.select(F.col("doc_id").cast("bigint").alias("k")).where("k is not null").distinct()
    with Scratch(shards.sparkSession) as scratch:
        routed = wanted.mapInArrow(route, "k bigint, part int").join(places, "part").where("k between low and high")
        routed = scratch.write(routed.groupBy("k", "part").agg(F.min("shard").alias("shard")), "routed")
        there = shards.join(small(routed.select("part", "shard").distinct()), ["part", "shard"], "left_semi")
        found = routed.groupBy("part", "shard").cogroup(there.groupBy("part", "shard")).applyInArrow(read, "doc_id bigint, ids array<int>")
        return written(found, "found")


def op8_token_files(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return read_back(write_shards(docs, tokenizer_path("word_bpe_49k.json")))
