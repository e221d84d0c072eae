"""N-gram Jaccard join by a size-aware heavy-light split.

A document's set is its distinct ``width``-word shingles, as 64-bit hashes, and
links are exact on these hashes. All sets are ordered alike: shingles that few
documents have come first, in hash order, then the frequent ones (see below).
A set's first n - ceil(t n) + 1 shingles are its prefix. Two sets of similarity
>= t share a shingle in their prefixes, and two in prefixes one longer. So

* small sets are entered under every pair of shingles of the longer prefix: a
  key that few unrelated sets have in common, of which a small set has few;
* a pair with a large set is found by scanning the inverted lists of single
  prefix shingles, which hold large sets and those small ones near the bound.

The boundary is the prefix length at which enumerating pairs would cost more
rows than scanning lists, from counts over all sets.

Frequent shingles are known from counters by hash bucket, which tasks fill with
all shingles and Spark adds up: a passage that many documents share comes last
in their order and so makes no long list, however tasks are cut. Whatever list
is longer than a block all the same, as those of sets that consist of frequent
shingles are, is split (see blocks).

Equal sets are one node. In a list, sets are compared by bit sketches that give
an upper bound of their overlap, and a spanning forest of what passes makes
candidate groups, so a list of m sets yields m edges at most. Within a candidate
group every two sets are then compared exactly, unless they are joined through
a centre already. The documents' links are the components of the exact links;
no link between different sets is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import centred, dealt, linked, sides
from .common import HASHES, Scratch, arrow_batches, components, groups_of, sliced, small, table, written

WIDTH = 4
PERCENT = 85
#: Bits of a sketch (the parity of the set's hashes in so many classes): the
#: next power of two of this share of the set's size, and so many at least.
#: Of two unrelated sets, half of the bits differ, more than links allow.
LEAST_BITS, BIT_SHARE = 128, 0.5
#: The longest prefix for which pairs are considered.
MAX_PAIRS_PREFIX = 16
#: Counters of shingles a task (16 MB), sent in so many ranges. A bucket is frequent from so many, and from so many times the mean, on.
BUCKETS, RANGES, FREQUENT, TIMES = 1 << 22, 64, 1000, 8
#: Sets of a list, and texts of a candidate group, that are compared at once; what has more is split.
BLOCK = 256
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def shingles(text: str | None, width: int = WIDTH):
    """The sorted hashes of a text's distinct shingles; of fewer words, one of the whole sequence."""
    import numpy as np

    words = [] if text is None else text.encode().lower().split()  # ASCII only, both
    h = np.fromiter(map(HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(width, len(h))
    if not size:
        return h
    n = len(h) - size + 1
    out = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        out = (out ^ h[i : i + n]) * np.uint64(_FACTORS[i % 4])
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(out ^ (out >> np.uint64(32)))


def least_overlap(n: int, percent: int = PERCENT) -> int:
    return -(-percent * n // 100)


def sketches(docs: DataFrame, text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, t1, t2, n, key, bits, prefix, range, counts): t1, t2 a text's hash; key the set's, null for an empty one.

    The prefix is in hash order. RANGES rows a task at most have only ``range``
    and ``counts``: the task's counters of that range, in as few bytes each as
    the largest needs.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        seen, kinds = np.zeros(BUCKETS, dtype=np.int32), None
        for batch in sliced(batches):
            n, key, bits, prefix = [], [], [], []
            for t in batch.column("__text").to_pylist():
                h = shingles(t, width)
                n.append(len(h))
                if not len(h):
                    key.append(None), bits.append(None), prefix.append(None)
                    continue
                np.add.at(seen, (h & np.uint64(BUCKETS - 1)).astype(np.int64), 1)
                key.append(xxhash.xxh3_128_digest(h.tobytes()))
                size = max(LEAST_BITS, 1 << (int(BIT_SHARE * len(h)) - 1).bit_length())
                odd = np.bincount((h >> np.uint64(11)).astype(np.int64) & (size - 1), minlength=size) & 1
                bits.append(np.packbits(odd.astype(np.uint8)).tobytes())
                prefix.append(h[: prefix_length(len(h), percent)].view(np.int64))
            rows, none = len(n), [None] * len(n)
            new = [pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(bits, pa.binary()), pa.array(prefix, pa.list_(pa.int64())), pa.array(none, pa.int32()), pa.array(none, pa.binary())]
            made = pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "t1", "t2")), *new], names)
            kinds = made.schema.types[:7]  # as they came: parts of an id may be declared without nulls, and times have the session's zone
            yield made
        for k, part in enumerate(seen.reshape(RANGES, -1)):
            if part.any():
                counts = part.astype(np.min_scalar_type(int(part.max()))).tobytes()
                yield pa.RecordBatch.from_arrays([*(pa.nulls(1, c) for c in kinds), pa.array([k], pa.int32()), pa.array([counts], pa.binary())], names)

    rows = docs.select("doc_id", *text_hashes(text), F.col(text).alias("__text"))
    names = ["doc_id", "t1", "t2", "n", "key", "bits", "prefix", "range", "counts"]
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, t1 bigint, t2 bigint, n bigint, key binary, bits binary, prefix array<bigint>, range int, counts binary"
    return rows.mapInArrow(run, schema)


def prefix_length(n: int, percent: int) -> int:
    """One more than single shingles need."""
    return min(n, n - least_overlap(n, percent) + 2)


def frequent(marks: DataFrame) -> DataFrame:
    """(bucket): the buckets of shingles, counted over all documents, that come last in every prefix; BUCKETS / TIMES at most."""
    total = marks.agg(F.sum("n")).first()[0] or 0
    least = max(FREQUENT, TIMES * total / BUCKETS)

    def add(batches):
        import numpy as np
        import pyarrow as pa

        size, at, sums = BUCKETS // RANGES, None, None

        def found():
            return pa.RecordBatch.from_arrays([pa.array((np.flatnonzero(sums >= least) + at * size).astype(np.int32))], ["bucket"])

        for batch in batches:
            for k, counts in zip(batch.column("range").to_pylist(), batch.column("counts"), strict=True):
                if k != at:
                    if sums is not None:
                        yield found()
                    at, sums = k, np.zeros(size, dtype=np.int64)
                raw = counts.as_buffer()
                sums += np.frombuffer(raw, dtype=f"u{raw.size // size}")
        if sums is not None:
            yield found()

    each = marks.where("range is not null").select("range", "counts")
    return each.repartition("range").sortWithinPartitions("range").mapInArrow(add, "bucket int")


def ordered(sets: DataFrame, docs: DataFrame, buckets: list[int], scratch: Scratch, text: str, width: int, percent: int) -> DataFrame:
    """sets (id, t1, t2, n, bits, prefix) as (id, n, bits, prefix, cold): prefixes in the order that has the frequent buckets last; the first ``cold`` shingles aren't frequent.

    Only sets with a frequent shingle in the hash-ordered prefix are made anew.
    """
    sets = sets.withColumn("cold", F.size("prefix"))
    if not buckets:
        return sets.select("id", "n", "bits", "prefix", "cold")
    import numpy as np

    bitmap = np.zeros(BUCKETS, dtype=bool)
    bitmap[buckets] = True
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(bitmap).tobytes())

    def hot():
        """Of hashes, whether they are frequent."""
        flags = np.unpackbits(np.frombuffer(sent.value, dtype=np.uint8)).astype(bool)
        return lambda h: flags[(h & np.uint64(BUCKETS - 1)).astype(np.int64)]

    def touched(batches):
        import pyarrow as pa

        last = hot()
        for batch in batches:
            p = batch.column("prefix")
            flat = last(p.values.to_numpy(zero_copy_only=False).view(np.uint64))
            sums = np.concatenate(([0], np.cumsum(flat)))
            ends = p.offsets.to_numpy()
            keep = pa.array(np.flatnonzero(sums[ends[1:]] > sums[ends[:-1]]), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(c).take(keep) for c in kept], kept)

    def again(batches):
        import pyarrow as pa

        is_hot = hot()
        for batch in sliced(batches):
            prefix, cold = [], []
            for t in batch.column("text").to_pylist():
                h = shingles(t, width)
                last, size = is_hot(h), prefix_length(len(h), percent)
                p = np.concatenate([h[~last], h[last]])[:size]
                prefix.append(p.view(np.int64))
                cold.append(min(size, int((~last).sum())))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "n", "bits")), pa.array(prefix, pa.list_(pa.int64())), pa.array(cold, pa.int32())], ["id", "n", "bits", "prefix", "cold"])

    kept = ["id", "t1", "t2", "n", "bits"]
    ids = small(scratch.write(sets.select(*kept, "prefix").mapInArrow(touched, "id bigint, t1 bigint, t2 bigint, n bigint, bits binary"), "touched"))
    texts = docs.select(*text_hashes(text), F.col(text).alias("text")).join(ids, ["t1", "t2"]).select("id", "n", "bits", "text")
    made = texts.mapInArrow(again, "id bigint, n bigint, bits binary, prefix array<bigint>, cold int").dropDuplicates(["id"])  # of copies of a text
    return sets.join(ids.select("id"), "id", "left_anti").select("id", "n", "bits", "prefix", "cold").unionByName(made)


def text_hashes(text: str) -> list[Column]:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def boundary(sets: DataFrame) -> int:
    """The longest prefix for which pairs are enumerated, by cost: rows written against rows and comparisons of lists."""
    short = sets.where(F.size("prefix") <= MAX_PAIRS_PREFIX + 1).select(F.size("prefix").alias("p"), F.explode("prefix").alias("s"))
    rows = sorted(short.groupBy("p").agg(F.count("*").alias("rows"), F.approx_count_distinct("s").alias("lists")).collect())  # MAX_PAIRS_PREFIX + 1 rows
    best, cost, least = 0, 0.0, 0.0
    for p, n, lists in rows:
        length = n / max(1, lists)
        # Each set: p (p - 1) / 2 keys, or p - 1 keys and as many half lists to compare with.
        cost += n / p * (p * (p - 1) / 2 - (p - 1) * (1 + length / 2))
        if cost < least:
            best, least = p, cost
    return best


def _keys(sets: DataFrame, bound: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(s, id, n) twice: the keys under which each set is entered, first those with a shingle that isn't frequent."""
    p = F.size("prefix")
    pairs = F.transform("prefix", lambda a, i: F.transform(F.slice("prefix", i + 2, F.lit(bound + 1)), lambda b: F.xxhash64(a, b)))
    few = sets.where((p <= bound) & (p > 1)).select("id", "n", "cold", pairs.alias("k"))
    # The longer prefix has one more than needed for single shingles.
    single = F.when(p > 1, F.slice("prefix", F.lit(1), F.greatest(p - 1, F.lit(1)))).otherwise(F.col("prefix"))
    # A small set may link with a large one if it isn't much smaller than the smallest of those.
    near = sets.where((p > bound) | (F.col("n") * 100 >= percent * F.lit(_least_size(bound, percent)))).select("id", "n", "cold", single.alias("k"))
    first = F.slice("k", F.lit(1), F.col("cold"))
    rest = F.slice("k", F.col("cold") + 1, F.size("k"))
    cold = few.select("id", "n", F.explode(F.flatten(first)).alias("s")).unionByName(near.select("id", "n", F.explode(first).alias("s")))
    hot = few.where(F.col("cold") < F.size("k")).select("id", "n", F.explode(F.flatten(rest)).alias("s")).unionByName(near.where(F.col("cold") < F.size("k")).select("id", "n", F.explode(rest).alias("s")))
    return cold.withColumn("n", F.col("n").cast("int")), hot.select("id", "s")


def _least_size(bound: int, percent: int) -> int:
    """The smallest size with a prefix (and one more) above the bound."""
    n = 1
    while prefix_length(n, percent) <= bound:
        n += 1
    return n


class _Sketches:
    """The rows of an Arrow table with n and bits, to compare in pairs."""

    def __init__(self, rows, percent: int):
        import numpy as np

        self.n, self.percent = rows.column("n").to_numpy(), percent
        raw = rows.column("bits").to_pylist()
        self.width = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        # Sketches by width, and each width's folded to half: classes modulo a half are the exclusive or of the halves.
        self.place, self.whole, self.half = np.zeros(len(raw), dtype=np.int64), {}, {}
        for w in np.unique(self.width).tolist():
            at = np.flatnonzero(self.width == w)
            self.place[at] = np.arange(len(at))
            x = self.whole[w] = np.frombuffer(b"".join(raw[k] for k in at.tolist()), dtype=np.uint64).reshape(len(at), w // 8)
            if w * 8 > LEAST_BITS:
                self.half[w] = x[:, : w // 16] ^ x[:, w // 16 :]

    def passes(self, x, y):
        """Rows x and y: the overlap needed, against the bound by the sketches' differing bits."""
        import numpy as np

        n, width = self.n, self.width
        both = n[x] + n[y]
        need = -(-self.percent * both // (100 + self.percent))
        ok = np.minimum(n[x], n[y]) >= need
        for w in np.unique(width[x[ok]]).tolist():
            for wide, table in ((w, self.whole.get(w)), (2 * w, self.half.get(2 * w)), (w // 2, None)):
                at = np.flatnonzero(ok & (width[x] == w) & (width[y] == wide))
                if len(at):
                    a = self.half[w] if table is None else self.whole[w]
                    b = self.whole[wide] if table is None else table
                    apart = np.bitwise_count(a[self.place[x[at]]] ^ b[self.place[y[at]]]).sum(axis=1).astype(np.int64)
                    ok[at] = (both[at] - apart) // 2 >= need[at]
        return ok

    def forest(self, a, b) -> list[tuple[int, int]]:
        """Pairs of rows, of a and of b, that join what passes; a pair that is joined already isn't compared."""
        import numpy as np

        label, out = {int(x): int(x) for x in np.concatenate([a, b])}, []
        at = np.unique(np.concatenate([a, b]))
        label = np.arange(int(at[-1]) + 1)
        same = a is b
        for k, x in enumerate(a.tolist()):
            y = b[k + 1 :] if same else b
            y = y[label[y] != label[x]]
            if not len(y):
                continue
            for z in y[self.passes(np.full(len(y), x), y)].tolist():
                if label[z] != label[x]:
                    low, high = sorted((label[x], label[z]))
                    label[label == high] = low
                    out.append((x, z))
        return out


def candidates(sets: DataFrame, bound: int, scratch: Scratch, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that join whatever may link: a spanning forest of each list's pairs that sketches don't rule out.

    ``sets`` has id, n, bits, prefix and cold, prefixes being in one order.
    """
    from pyspark.sql import Window

    cold, hot = _keys(sets, bound, percent)
    sketch = sets.select("id", "n", "bits").hint("merge")  # one plan for small and large tables
    # Lists of shingles that aren't frequent are short as a rule. Of these, a row goes on if the size next to its own allows a link.
    own = Window.partitionBy("s")
    sizes = own.orderBy("n")
    cold = cold.withColumns({"less": F.lag("n").over(sizes), "more": F.lead("n").over(sizes), "members": F.count("*").over(own)})
    met = cold.where((F.col("less") * 100 >= F.col("n") * percent) | (F.col("n") * 100 >= F.col("more") * percent)).select("id", "s", "members")
    lengths = hot.groupBy("s").agg(F.count("*").alias("members")).where("members > 1")
    lists = scratch.write(met.unionByName(hot.join(lengths, "s")), "lists")
    rows = lists.where(F.col("members") <= block).drop("members").join(sketch, "id").select("s", "id", "n", "bits").repartition("s").sortWithinPartitions("s", "n", "id")

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        rest = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = now if rest is None else pa.concat_tables([rest, now])
            s = now.column("s").to_numpy()
            if not len(s):
                continue
            end = int(np.searchsorted(s, s[-1]))  # the last list may go on
            rest = now.slice(end)
            if end:
                yield from found(now.slice(0, end))
        if rest is not None:
            yield from found(rest)

    def found(rows):
        import numpy as np
        import pyarrow as pa

        s, ids = (rows.column(c).to_numpy() for c in ("s", "id"))
        pairs, out = _Sketches(rows, percent), set()
        starts = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        sizes = np.diff(np.append(starts, len(s)))
        start_of, size_of = np.repeat(starts, sizes), np.repeat(sizes, sizes)
        at = np.arange(len(s))
        light = size_of <= 12
        for k in range(1, 12):
            x = at[light & (at + k < start_of + size_of)]
            if not len(x):
                break
            x = x[pairs.passes(x, x + k)]
            out.update(zip(ids[x].tolist(), ids[x + k].tolist(), strict=True))
        for a, m in zip(starts[sizes > 12].tolist(), sizes[sizes > 12].tolist(), strict=True):
            members = np.arange(a, a + m)
            out.update((int(ids[x]), int(ids[y])) for x, y in pairs.forest(members, members))
        if out:
            x, y = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    def near(unit, a, b):
        import numpy as np

        pairs = _Sketches(unit, percent)
        return np.stack([pairs.passes(np.full(len(b), x), b) for x in a.tolist()])

    def split(batches):
        import pyarrow as pa

        for unit in groups_of(batches, ["s", "i", "j"]):
            out = _Sketches(unit, percent).forest(*sides(unit))
            if out:
                ids = unit.column("id").to_numpy()
                x, y = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids[list(x)], pa.int64()), pa.array(ids[list(y)], pa.int64())], ["a", "b"])

    edges = rows.mapInArrow(compare, "a bigint, b bigint")
    long = lists.where(F.col("members") > block)
    if not long.isEmpty():
        joined, rest = centred(long.join(sketch, "id"), ["s"], near, scratch, block)
        edges = edges.unionByName(joined).unionByName(dealt(rest, ["s"], block).mapInArrow(split, "a bigint, b bigint"))
    return edges.distinct()


def verified(texts: DataFrame, scratch: Scratch, percent: int = PERCENT, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that join what links exactly within each group.

    ``texts`` has grp, id, members (their number in the group) and text.
    """

    def near(unit, a, b):
        texts = unit.column("text").to_pylist()
        sets = [shingles(t, width) for t in texts]
        return links([sets[k] for k in a.tolist()], [sets[k] for k in b.tolist()], percent)

    return linked(texts, ["grp"], near, scratch, block)


def links(left: list, right: list, percent: int = PERCENT):
    """The boolean matrix of the links between sets (sorted arrays of distinct hashes) of two lists."""
    import numpy as np

    m, k = len(left), len(right)
    size = np.array([len(s) for s in (*left, *right)], dtype=np.int64)
    column = np.unique(np.concatenate((*left, *right)), return_inverse=True)[1]
    owner = np.repeat(np.arange(m + k), size)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((m, k))
    values = int(column[-1]) + 1 if len(column) else 0
    step = max(256, 8_000_000 // (m + k))  # 32 MB at a time
    for low in range(0, values, step):
        a, b = np.searchsorted(column, (low, low + step))
        part = np.zeros((m + k, min(step, values - low)), dtype=np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        common += part[:m] @ part[m:].T
    common = np.rint(common).astype(np.int64)
    union = size[:m, None] + size[None, m:] - common
    return (100 * common >= percent * union) & (common > 0)


def jaccard_components(docs: DataFrame, text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row a document; component_id is the smallest doc_id of its group.

    Null, empty and wordless texts have an empty set and are alone. Texts of any
    length are read whole. Repeated rows have equal sets, and so one group. Null
    ids count as larger than all others; an empty table gives no rows. No column
    but doc_id and ``text`` is read, so others may have any name.
    """
    with Scratch(docs.sparkSession) as scratch, arrow_batches(docs.sparkSession, 1000):
        marks = scratch.write(sketches(docs, text, width, percent).withColumn("id", F.monotonically_increasing_id()), "sketches")
        made = scratch.paths[-1]
        # One row stands for each set; its id is the set's.
        keys = scratch.write(marks.where("n > 0").groupBy("key").agg(F.min("id").alias("id"), F.min("doc_id").alias("least")), "keys")
        sets = marks.select("id", "t1", "t2", "n", "bits", "prefix").join(small(keys.select("id")), "id")
        buckets = [r.bucket for r in frequent(marks).collect()]  # BUCKETS / TIMES at most, whatever the number of documents
        sets = scratch.write(ordered(sets, docs, buckets, scratch, text, width, percent), "sets")
        marks = scratch.write(marks.where("n is not null").select("doc_id", "id", "t1", "t2", "n", "key"), "marks")
        scratch.remove(made)
        groups = scratch.write(components(candidates(sets, boundary(sets), scratch, percent), scratch), "groups")
        sizes = groups.groupBy("component").agg(F.count("*").alias("members"))
        members = groups.join(sizes, "component").join(marks.select("id", "t1", "t2"), "id").select(F.col("component").alias("grp"), "id", "members", "t1", "t2")
        members = scratch.write(members, "members")
        # Texts come by hash, and copies of a text are one again.
        texts = docs.select(*text_hashes(text), F.col(text).alias("text")).join(small(members), ["t1", "t2"]).select("grp", "id", "members", "text")
        texts = scratch.write(texts.groupBy("grp", "id", "members").agg(F.min("text").alias("text")), "texts")
        joined = components(verified(texts, scratch, percent, width), scratch)
        named = keys.join(joined, "id", "left").select("key", "least", F.coalesce("component", "id").alias("class"))
        smallest = named.groupBy("class").agg(F.min("least").alias("component_id"))
        by_key = named.join(smallest, "class").select("key", "component_id")
        marks = marks.select("doc_id", F.col("n").alias("n_shingles"), "key")
        out = marks.join(by_key, "key", "left").select("doc_id", "n_shingles", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
        return written(out, "jaccard-components")


def op2_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
