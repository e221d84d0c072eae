"""Best-fit packing with a swap-based local search.

Texts become token ids and an end id; what is longer than a sequence is cut
into full pieces, the first piece taking the rest. Pieces are dealt evenly into
cells of about ``cell_pieces``, and each cell is packed by itself: best fit over
falling lengths, then a local search among all underfull sequences, which moves
a piece or exchanges one for one or two for one wherever that raises the sum
of squared fills, until going through them all empties none any more. A cell
ends with one part-filled sequence or a few, so cells cost at most about one
sequence in a thousand.
Only lengths are shuffled, never ids.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, sliced, table, written
from .encoding import byte_encoder, tokenizer_path

LENGTH = 2048
CELL_PIECES = 6_000


def pieces(docs: DataFrame, path: str, ranks: str, text: str = "text", length: int = LENGTH, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of each text's ids and the end id.

    A null or empty text has the end id alone. Repeated rows give their pieces
    each; a text of any length is cut whole; an empty table gives no rows, and
    other columns aren't read.
    """

    def cut(batches):
        import sys

        import pyarrow as pa

        encoder = byte_encoder(path, ranks)
        for batch in sliced(batches):
            at, piece, start, size, crc, raw = [], [], [], [], [], []
            for row, t in enumerate(batch.column("__text").to_pylist()):
                ids = encoder.encode(t or "")
                ids.append(end_id)
                if sys.byteorder != "little":
                    ids.byteswap()
                whole, view = len(ids), memoryview(ids).cast("B")
                low, k = 0, 0
                high = whole % length or min(length, whole)
                while low < whole:
                    at.append(row)
                    piece.append(k)
                    start.append(low)
                    size.append(high - low)
                    crc.append(zlib.crc32(view[low * 4 : high * 4]))
                    if keep_ids:
                        raw.append(bytes(view[low * 4 : high * 4]))
                    low, high, k = high, high + length, k + 1
            new = [batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(new + [pa.array(raw, pa.binary())] * keep_ids, names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    kinds = [docs.schema["doc_id"].dataType.simpleString(), "int", "bigint", "bigint", "bigint", "binary"]
    return docs.select("doc_id", F.col(text).alias("__text")).mapInArrow(cut, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=False)))


def best_fit(sizes: list[int], length: int = LENGTH) -> list[list[int]]:
    """The bins (lists of item numbers) of best fit over falling sizes."""
    bins: list[list[int]] = []
    by_free: dict[int, list[int]] = {}
    open_sizes: list[int] = []  # the free sizes that some bin has, sorted
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        k = bisect_left(open_sizes, size)
        if k < len(open_sizes):
            free = open_sizes[k]
            at = by_free[free].pop()
            if not by_free[free]:
                del by_free[free]
                open_sizes.pop(k)
            bins[at].append(i)
        else:
            free, at = length, len(bins)
            bins.append([i])
        if free := free - size:
            if free not in by_free:
                by_free[free] = []
                insort(open_sizes, free)
            by_free[free].append(at)
    return bins


def local_search(sizes: list[int], bins: list[list[int]], length: int = LENGTH) -> list[list[int]]:
    """Fewer or fuller bins: every accepted step raises the sum of squared fills.

    From the emptiest on, an underfull bin gives pieces to others of at least
    its fill: by a move, an exchange of one for one, or two for one either way,
    always the step with the largest gain, until there's none or it is empty. A
    step of gain d on fills a >= b raises the sum by 2 d (a - b + d) > 0. All
    underfull bins have their turn, again as long as a turn of all empties one.
    """
    bins = [list(b) for b in bins]
    fill = [sum(sizes[i] for i in b) for b in bins]
    emptied = True
    while emptied:
        emptied = False
        search = _Search(sizes, bins, fill, length)
        for low in sorted(search.open, key=lambda k: (fill[k], k)):
            while bins[low] and fill[low] < length and (step := search.best(low)):
                high, out, back, gain = step
                bins[high] = [i for i in bins[high] if i not in back] + out
                bins[low] = [i for i in bins[low] if i not in out] + back
                fill[high] += gain
                fill[low] -= gain
                search.changed(low)
                search.changed(high)
            emptied |= not bins[low]
    return [b for b in bins if b]


class _Search:
    """The pieces, and the pairs of pieces, of underfull bins as arrays, a stretch a bin."""

    def __init__(self, sizes: list[int], bins: list[list[int]], fill: list[int], length: int):
        import numpy as np

        self.sizes, self.bins, self.fill, self.length = np.array(sizes, dtype=np.int64), bins, fill, length
        self.open = [k for k in range(len(bins)) if bins[k] and fill[k] < length]
        self.parts: dict[int, tuple] = {}
        for k in self.open:
            self.changed(k)

    def changed(self, k: int) -> None:
        import numpy as np

        if not self.bins[k] or self.fill[k] >= self.length:
            self.parts.pop(k, None)
        else:
            own = np.array(self.bins[k], dtype=np.int64)
            size = self.sizes[own]
            a, b = np.triu_indices(len(own), 1)
            self.parts[k] = (own, size, own[a], own[b], size[a] + size[b])
        self.table = None

    def _stacked(self) -> tuple:
        """(bin, first piece, second piece or -1, size) of all pieces and pairs."""
        import numpy as np

        if self.table is None:
            of = [(np.full(len(s) + len(p), k), np.concatenate([o, x]), np.concatenate([np.full(len(o), -1), y]), np.concatenate([s, p])) for k, (o, s, x, y, p) in self.parts.items()]
            self.table = tuple(np.concatenate(c) for c in zip(*of, strict=True)) if of else tuple(np.empty(0, dtype=np.int64) for _ in range(4))
            self.free = self.length - np.array(self.fill, dtype=np.int64)
        return self.table

    def best(self, low: int) -> tuple[int, list[int], list[int], int] | None:
        """(high, pieces from low, pieces from high, gain), or None."""
        import numpy as np

        if low not in self.parts:
            return None
        where, first, second, size = self._stacked()
        own, one, x, y, two = self.parts[low]
        free = self.free[where]
        usable = (where != low) & (self.free[where] <= self.free[low])
        found = (0, None)

        def largest(values, pieces, most, allowed, back) -> None:
            """For each of the other bins' entries: the largest of low's values that fits ``most``, for those behind ``back``."""
            nonlocal found
            order = np.argsort(values, kind="stable")
            at = np.searchsorted(values[order], most, side="right") - 1
            gain = np.where(allowed & (at >= 0), values[order][np.maximum(at, 0)] - back, 0)
            k = int(np.argmax(gain)) if len(gain) else 0
            if len(gain) and gain[k] > found[0]:
                found = (int(gain[k]), (k, pieces(order[at[k]]), back is not zero))

        zero = np.zeros(len(size), dtype=np.int64)
        largest(one, lambda i: [int(own[i])], free, usable, zero)  # a move
        largest(one, lambda i: [int(own[i])], size + free, usable, size)  # for one, or for two
        if len(two):
            largest(two, lambda i: [int(x[i]), int(y[i])], size + free, usable & (second < 0), size)  # two for one
        gain, step = found
        if step is None:
            return None
        k, out, exchange = step
        back = [int(p) for p in (first[k], second[k]) if p >= 0] if exchange else []
        return int(where[k]), out, back, gain


def pack(parts: DataFrame, length: int = LENGTH, cell_pieces: int = CELL_PIECES) -> DataFrame:
    """parts (with length; written once, so it may be costly) with sequence_id and offset.

    Each piece gets its place; an empty table gives no rows. Pieces are dealt to
    cells by their row number in the written table, so neither repeated rows nor
    equal lengths gather in one cell; pieces of equal length may swap places.
    Columns of the names sequence_id and offset are replaced, others kept.
    """
    parts = parts.drop("sequence_id", "offset")
    with arrow_batches(parts.sparkSession, 500):  # for the texts behind them
        parts = written(parts.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    cells = max(1, -(-parts.count() // cell_pieces))
    names = [c for c in parts.columns if c != "__row"]

    def one(key, rows):
        import pyarrow as pa

        sizes = rows.column("length").to_pylist()
        bins = local_search(sizes, best_fit(sizes, length), length)
        sequence, offset = [0] * len(sizes), [0] * len(sizes)
        first = key[0].as_py() << 32
        for k, b in enumerate(bins):
            at = 0
            for i in b:
                sequence[i], offset[i] = first + k, at
                at += sizes[i]
        return rows.select(names).append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    schema = parts.select(*names).withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")}).schema
    dealt = parts.withColumn("__cell", F.pmod(F.xxhash64("__row"), F.lit(cells)))
    return dealt.groupBy("__cell").applyInArrow(one, schema)


def packed(docs: DataFrame) -> DataFrame:
    return pack(pieces(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken")))


def op1_packing(spark, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents").select("doc_id", "text"))
