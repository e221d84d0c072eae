"""Prefix tries of conversations by fixed-length block hashing.

Each conversation's turns are cut into blocks of ``block`` turns, and a block's
digest covers its turns and the digest of the block before, so equal digests
are equal beginnings. Conversations are grouped by block digests first. Where
the conversations behind a block all go on with the same next block, its turns
are nodes as they are. Only where they go on with several are turns looked at:
each distinct block gives digests of its turns' beginnings, and these are
grouped. Members are counted by partial sums, so a beginning that most
conversations share is no hot key, and no text is shuffled, but digests.

Sums over subtrees need no walk. A node belongs to its smallest member, which
then has all nodes of its own path below it: so each conversation has a depth
up to which its path belongs to others. A leaf counts for the conversation that
it belongs to, and a turn is saved if its node belongs to another conversation.
Summing both over a node's members, in the same groups, gives its subtree's.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, table, written

#: Turns in a block, and consecutive ids whose digits one row holds.
BLOCK = 4
IDS = 4096


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, bytes) of rows (conv_id, turn, role, text): a digest of role and text, and the text's UTF-8 bytes; null role or text is empty."""
    role, text = (F.encode(F.coalesce(F.col(c), F.lit("")), "utf-8") for c in ("role", "text"))
    digest = F.md5(F.concat(F.encode(F.concat(F.octet_length(role).cast("string"), F.lit(":")), "utf-8"), role, text))
    return conversations.where("conv_id is not null").select("conv_id", "turn", digest.alias("digest"), F.octet_length(text).cast("bigint").alias("bytes"))


def shared_openings(turns: DataFrame, stride: int = 5, most: int = 9) -> DataFrame:
    """(conv_id, part, turn, digest, bytes, skip) of rebuilt conversations: the first h turns of conversation c - c % stride, then c's own behind its first h, which are to be skipped; h = crc32(c) % most.

    The turns of part 0 come first; in both parts turns are in order, null first, those of equal numbers in an order of their digests.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    order = Window.partitionBy("conv_id").orderBy("turn", "digest", "bytes")
    first = turns.withColumn("_i", F.row_number().over(order)).where(F.col("_i") < most)
    ids = turns.select("conv_id").distinct().select("conv_id", h.alias("_h"), (F.col("conv_id") - F.col("conv_id") % stride).alias("_base"))
    opening = ids.join(first.withColumnRenamed("conv_id", "_base"), "_base").where("_i <= _h")
    opening = opening.select("conv_id", F.lit(0).alias("part"), "turn", "digest", "bytes", F.lit(0).alias("skip"))
    return opening.unionByName(turns.select("conv_id", F.lit(1).alias("part"), "turn", "digest", "bytes", h.alias("skip")))


def blocks_of(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, depth, parent, key, digests, sizes, before) a block: of rows as of shared_openings(), the depth and the bytes before it, the digests of the block before and of this.

    A task streams past its conversations, narrow rows in order, and holds a block.
    """

    def cut(batches):
        import pyarrow as pa

        out, at, key, depth, before, own, skipped = [], None, "", 0, 0, [], 0

        def close():
            nonlocal key, depth, before, own
            if own:
                digests, sizes = [d for d, _ in own], [n for _, n in own]
                new = hashlib.md5((key + "".join(digests)).encode()).hexdigest()
                out.append((at, depth, key, new, digests, sizes, before))
                key, depth, before, own = new, depth + len(own), before + sum(sizes), []

        for batch in batches:
            for conv, part, digest, size, skip in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "digest", "bytes", "skip")), strict=True):
                if conv != at:
                    close()
                    at, key, depth, before, skipped = conv, "", 0, 0, 0
                if part and skipped < skip:
                    skipped += 1
                    continue
                own.append((digest, size))
                if len(own) == block:
                    close()
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                out = []
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    import pyarrow as pa

    names = ["conv_id", "depth", "parent", "key", "digests", "sizes", "before"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int64()]
    rows = turns.withColumn("conv_id", F.col("conv_id").cast("bigint")).repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "digest", "bytes")
    return rows.select("conv_id", "part", "digest", "bytes", "skip").mapInArrow(cut, "conv_id bigint, depth bigint, parent string, key string, digests array<string>, sizes array<bigint>, before bigint")


def _groups(blocks: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Distinct blocks, with their members' sums; ``sums`` are of bigints, or of arrays with a bigint for each turn."""
    same = [F.any_value(c).alias(c) for c in ("depth", "parent", "digests", "sizes", "before")]
    return blocks.groupBy("key").agg(*same, *(c.alias(n) for n, c in sums.items()))


def _refined(groups: DataFrame, sums: dict[str, str], block: int) -> DataFrame:
    """(key, parent, depth, bytes, before, sums) of each node below the root: of the turns of distinct blocks, grouped only where siblings diverge.

    ``sums`` says how a node's value comes from its blocks': min, sum, or each (the turn's own member of an array, summed).
    """
    siblings = groups.groupBy("parent").agg(F.count("*").alias("_siblings"))
    rows = groups.join(siblings, "parent")
    turn = rows.select("*", F.posexplode("sizes").alias("_j", "bytes"))
    value = {n: F.element_at(n, F.col("_j") + 1) if how == "each" else F.col(n) for n, how in sums.items()}
    depth = (F.col("depth") + F.col("_j") + 1).alias("depth")
    before = (F.col("before") + F.aggregate(F.slice("sizes", 1, F.col("_j")), F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("before")
    last = F.col("_j") + 1 == F.size("sizes")
    inner = lambda j: F.concat_ws(":", "key", j.cast("string"))
    alone = turn.where("_siblings = 1").select(
        F.when(last, F.col("key")).otherwise(inner(F.col("_j") + 1)).alias("key"), F.when(F.col("_j") == 0, F.col("parent")).otherwise(inner(F.col("_j"))).alias("parent"),
        depth, "bytes", before, *(v.alias(n) for n, v in value.items()))
    start = lambda j: F.md5(F.encode(F.concat(F.col("parent"), F.array_join(F.slice("digests", 1, j), "")), "utf-8"))
    parted = turn.where("_siblings > 1").select(
        start(F.col("_j") + 1).alias("key"), F.when(F.col("_j") == 0, F.col("parent")).otherwise(start(F.col("_j"))).alias("parent"),
        depth, "bytes", before, *(v.alias(n) for n, v in value.items()))
    grouped = parted.groupBy("key").agg(*(F.any_value(c).alias(c) for c in ("parent", "depth", "bytes", "before")), *((F.min(n) if how == "min" else F.sum(n)).alias(n) for n, how in sums.items()))
    return alone.unionByName(grouped)


def ends(last: DataFrame) -> DataFrame:
    """(key, ends_sha256) of rows (key, conv_id): SHA-256 of a key's decimal ids, ascending, comma-joined.

    Rows hold the joined ids of ranges of ``IDS`` numbers, made in parallel; a task then streams past a key's ranges, holding one.
    """
    ranges = last.groupBy("key", F.expr(f"conv_id div {IDS}").alias("_c")).agg(F.array_join(F.transform(F.array_sort(F.collect_set("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def digest(batches):
        import pyarrow as pa

        out, at, state = [], None, None
        for batch in batches:
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if key != at:
                    if state is not None:
                        out.append((at, state.hexdigest()))
                    at, state = key, hashlib.sha256()
                    state.update(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["key", "ends_sha256"])
                out = []
        if state is not None:
            out.append((at, state.hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["key", "ends_sha256"])

    ordered = ranges.repartition("key").sortWithinPartitions("key", "_c")
    return ordered.select("key", "ids").mapInArrow(digest, "key string, ends_sha256 string")


def trie(turns: DataFrame, ids: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), a row a node.

    ``turns`` is as of shared_openings(); ``ids`` has the distinct conv_ids, of
    conversations without turns too. Nodes are told apart by 128-bit digests.
    Repeated turns are turns each. Without ids there is no row.
    """
    with Scratch(turns.sparkSession) as scratch:
        blocks = scratch.write(blocks_of(turns, block), "blocks")
        count = {"n_convs": F.count("*"), "conv_id": F.min("conv_id")}
        nodes = scratch.write(_refined(_groups(blocks, count), {"n_convs": "sum", "conv_id": "min"}, block), "nodes")
        children = scratch.write(nodes.groupBy("parent").agg(F.count("*").alias("n_children")), "children")

        # Of each conversation: the depth up to which its path belongs to others, the bytes up to there, and whether a leaf belongs to it.
        marked = nodes.join(children.select(F.col("parent").alias("key"), F.lit(False).alias("_leaf")), "key", "left")
        own = marked.groupBy("conv_id").agg(F.count("*").alias("_own"), F.sum("bytes").alias("_bytes"), F.count_if(F.col("_leaf").isNull()).alias("_leaf"))
        whole = blocks.groupBy("conv_id").agg(F.max(F.col("depth") + F.size("sizes")).alias("_depth"), F.max_by("key", "depth").alias("_last"), F.max(F.col("before") + F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("_all"))
        zero = lambda c: F.coalesce(F.col(c), F.lit(0))
        paths = ids.select(F.col("conv_id").cast("bigint").alias("conv_id")).join(whole, "conv_id", "left").join(own, "conv_id", "left")
        paths = scratch.write(paths.select("conv_id", F.coalesce("_last", F.lit("")).alias("key"), (zero("_depth") - zero("_own")).alias("_others"), (zero("_all") - zero("_bytes")).alias("_saved"), zero("_leaf").alias("_leaf")), "paths")

        member = blocks.join(paths.drop("key"), "conv_id")
        deep = lambda j: F.col("_others") >= F.col("depth") + j + 1
        turn = [F.lit(j) for j in range(block)]
        sums = {
            "n_leaves": F.sum("_leaf"),
            "_n": F.array(*(F.count_if(deep(j)) for j in turn)),
            "_q": F.array(*(F.sum(F.when(deep(j), F.col("_saved")).otherwise(0)) for j in turn)),
        }
        again = _refined(_groups(member, sums), {"n_leaves": "sum", "_n": "each", "_q": "each"}, block)
        saved = again.select("key", "n_leaves", (F.col("_q") - F.col("_n") * F.col("before")).alias("saved_tokens"))

        top = paths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum("_leaf").alias("n_leaves"), F.sum("_saved").alias("saved_tokens")).where("n_convs > 0")
        root = top.select(F.lit("").alias("key"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("bigint").alias("depth"), "n_convs", "conv_id", "n_leaves", "saved_tokens")
        below = nodes.select("key", "parent", "depth", "n_convs", "conv_id").join(saved, "key")
        every = below.unionByName(root).join(children.withColumnRenamed("parent", "key"), "key", "left")
        every = every.join(ends(paths.select("key", "conv_id")), "key", "left")
        above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id")).unionByName(root.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id")))
        every = every.join(above, "parent", "left")
        lone = (F.col("depth") == 0) & F.col("n_children").isNull()  # the root is a leaf if nothing is below
        empty = hashlib.sha256(b"").hexdigest()
        return written(every.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"), F.when(lone, 1).otherwise(F.col("n_leaves")).cast("bigint").alias("n_leaves"), F.col("saved_tokens").cast("bigint").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")), "trie")


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    with Scratch(spark) as scratch:
        turns = scratch.write(turns_of(table(spark, sf_dir, "conversations")), "turns")
        return trie(shared_openings(turns), turns.select("conv_id").distinct())
