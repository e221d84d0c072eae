"""URL filter: path-template trees a host, rejecting templates by smoothed labelled purity.

A page's path is a way down its host's tree, a segment a level; digits within a
segment are a wildcard. The tree grows below nodes that hold bad pages and
others too; what lies below any other node is one template. A node of bounded
size is grown to its leaves by one task; a larger one is split a level at a time
by shuffles, till its parts fit. So the number of jobs goes with the size of the
largest host, not with depth. At a node

* of many different segments, the segment is a variable: it becomes a wildcard,
  but for branches whose labels differ from their siblings' beyond chance;
* of few segments, labelled branches are merged if their labels are alike: each
  is tested against its siblings on the same side of the node's share of bad
  pages. A branch without labels is like no other, and stays by itself.

Alike is what a Bayes factor says: labels of two branches under one share of
bad pages, against a share each. It holds for counts of any size.

A template is rejected if its share of bad labelled pages, smoothed towards the
host's and that towards the corpus', reaches a threshold; shares of the host or
the corpus alone reject nothing. All counts are grouped sums over all pages, so
a hot host costs no more than its templates.

Labels are given, or else come from the rules: pages that a rule blocks are bad
examples, pages that one allows are good ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, groups_of, small, table, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: A node with more segments than this has a variable one.
MAX_CHILDREN = 24
#: A node that one task grows: distinct paths, and their bytes (UTF-8), at most.
TASK_LEAVES, TASK_BYTES = 20_000, 16_000_000
#: Weight of the prior in pages, and the rejected share.
WEIGHT = 5.0
REJECT = 0.5
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """The host, A-Z lower-cased; empty for a null url or one without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(verdict, rule) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def shape_of(path: Column) -> Column:
    """The path without its first slash, digits as <n>."""
    return F.regexp_replace(F.regexp_replace(path, "^/", ""), "[0-9]+", "<n>")


def _log_gamma(x, log):
    """The logarithm of the gamma function for x > 0, by Stirling's series two steps up."""
    y = x + 2
    return (y - 0.5) * log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) - log(x * (x + 1))


def _log_beta(bad, good, log):
    """The log evidence of so many bad and good labels, but for what is the same either way."""
    a, b = bad + 0.5, good + 0.5
    return _log_gamma(a, log) + _log_gamma(b, log) - _log_gamma(a + b, log)


def log_bayes_factor(bad, labelled, bad_all, labelled_all, log: Callable = F.log):
    """How much better two shares of bad labels explain a branch and the rest of its node than one share does; of columns, or of numbers with their ``log``."""
    rest_bad, rest = bad_all - bad, labelled_all - labelled
    return _log_beta(bad, labelled - bad, log) + _log_beta(rest_bad, rest - rest_bad, log) - _log_beta(bad_all, labelled_all - bad_all, log) - 1.1447298858494002  # log beta(1/2, 1/2)


def templates(pages: DataFrame, scratch: Scratch, max_children: int = MAX_CHILDREN, task_leaves: int = TASK_LEAVES, task_bytes: int = TASK_BYTES) -> DataFrame:
    """(host, shape, template, labelled, bad) from pages (host, path, bad).

    ``bad`` is 1 or 0, or null where there's no label. ``*`` is a wildcard or
    merged branches, ``*+`` merged ones of more bad pages than their node, and
    ``**`` all that lies below a node that isn't split.
    """
    leaf = pages.groupBy("host", shape_of(F.col("path")).alias("shape")).agg(F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    tree = scratch.write(leaf.withColumn("template", F.lit("")), "tree")
    level, done, columns = 0, [], ["host", "shape", "template", "labelled", "bad"]
    while True:
        node = tree.groupBy("host", "template").agg(F.sum("n").alias("all"), F.sum("bad").alias("pb"), F.count("*").alias("leaves"), F.sum(F.octet_length("shape")).alias("bytes"))
        mixed = (F.col("pb") > 0) & (F.col("pb") < F.col("all"))
        fits = (F.col("leaves") <= task_leaves) & (F.col("bytes") <= task_bytes)
        node = node.select("host", "template", F.when(~mixed, "pure").when(fits, "task").otherwise("large").alias("kind"))
        tree = scratch.write(tree.join(node, ["host", "template"]), "nodes")
        below = F.when(F.size(F.split("shape", "/")) > level, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))
        done.append(tree.where("kind = 'pure'").withColumn("template", below).select(columns))
        done.append(_grown(tree.where("kind = 'task'").drop("kind"), level, max_children))
        large = tree.where("kind = 'large'").drop("kind")
        if large.isEmpty():
            break
        level += 1
        tree = scratch.write(_level(large, level, max_children), "level")
        done.append(tree.where("closed").select(columns))
        tree = tree.where("not closed").drop("closed")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _level(tree: DataFrame, level: int, max_children: int) -> DataFrame:
    """Leaves below mixed nodes, a level further down, and whether they end there (``closed``)."""
    segments = F.split("shape", "/")
    tree = tree.withColumn("segment", F.when(F.size(segments) >= level, F.element_at(segments, level)))
    child = tree.groupBy("host", "template", "segment").agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b"))
    node = child.groupBy("host", "template").agg(F.sum("l").alias("pl"), F.sum("b").alias("pb"), F.count("*").alias("children"))
    # Above the node's share of bad pages or not; null without labels.
    side = F.when(F.col("l") > 0, F.col("b") * F.col("pl") > F.col("pb") * F.col("l"))
    judged = child.join(node, ["host", "template"]).withColumn("side", side)
    known = judged.where("l > 0").groupBy("host", "template", "side").agg(F.sum("l").alias("sl"), F.sum("b").alias("sb"), F.count("*").alias("known"))
    judged = judged.join(known, ["host", "template", "side"], "left")
    factor = log_bayes_factor(F.col("b"), F.col("l"), F.col("pb"), F.col("pl"))
    alone = F.col("side").isNull() | (F.col("known") == 1) | (log_bayes_factor(F.col("b"), F.col("l"), F.col("sb"), F.col("sl")) > 0)
    variable = F.col("children") > max_children
    apart = F.when(variable, factor > F.log(F.col("children"))).otherwise(alone)
    name = F.when(apart, F.col("segment")).when(~variable & F.col("side"), "*+").otherwise("*")
    named = judged.select("host", "template", "segment", F.when(F.col("segment").isNotNull(), name).alias("name"))
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("host", "template", "segment")]
    below = F.concat("t.template", F.coalesce(F.concat(F.lit("/"), "name"), F.lit("")))
    return tree.alias("t").join(named.alias("s"), same[0] & same[1] & same[2]).select("t.host", "shape", "n", "labelled", "bad", below.alias("template"), F.col("t.segment").isNull().alias("closed"))


def _grown(tree: DataFrame, level: int, max_children: int) -> DataFrame:
    """The leaves of nodes that fit a task, with their templates."""

    def grow(batches):
        import pyarrow as pa

        for node in groups_of(batches, ["host", "template"]):
            shape, n, labelled, bad = (node.column(c).to_pylist() for c in ("shape", "n", "labelled", "bad"))
            found = grown([s.split("/") for s in shape], n, labelled, bad, node.column("template")[0].as_py(), level, max_children)
            for low in range(0, len(found), 1000):
                part = node.slice(low, 1000).combine_chunks()
                yield pa.RecordBatch.from_arrays([*(part.column(c).combine_chunks() for c in ("host", "shape")), pa.array(found[low : low + 1000], pa.string()), *(part.column(c).combine_chunks() for c in ("labelled", "bad"))], ["host", "shape", "template", "labelled", "bad"])

    rows = tree.repartition("host", "template").sortWithinPartitions("host", "template")
    return rows.mapInArrow(grow, "host string, shape string, template string, labelled bigint, bad bigint")


def grown(paths: list[list[str]], n: list[int], labelled: list[int], bad: list[int], template: str, level: int, max_children: int) -> list[str]:
    """The templates of a node's leaves, by the rules of _level() down to where no node is mixed."""
    import math

    out, work = [""] * len(paths), [((None, template), level, range(len(paths)))]
    while work:
        name, depth, rows = work.pop()
        pl, pb = sum(labelled[k] for k in rows), sum(bad[k] for k in rows)
        if not 0 < pb < sum(n[k] for k in rows):
            ends, below = _rendered(name), _rendered((name, "**"))
            for k in rows:
                out[k] = below if len(paths[k]) > depth else ends
            continue
        children: dict = {}
        for k in rows:
            children.setdefault(paths[k][depth] if len(paths[k]) > depth else None, []).append(k)
        counts = {c: (sum(labelled[k] for k in own), sum(bad[k] for k in own)) for c, own in children.items()}
        sides: dict = {}
        for own, b in counts.values():
            if own:
                side = sides.setdefault(b * pl > pb * own, [0, 0, 0])
                side[0], side[1], side[2] = side[0] + own, side[1] + b, side[2] + 1
        variable, groups = len(children) > max_children, {}
        for c, (own, b) in counts.items():
            if c is None:
                ends = _rendered(name)
                for k in children[c]:
                    out[k] = ends
                continue
            above = b * pl > pb * own if own else None
            if variable:
                apart = log_bayes_factor(b, own, pb, pl, math.log) > math.log(len(children))
            else:
                apart = above is None or sides[above][2] == 1 or log_bayes_factor(b, own, sides[above][1], sides[above][0], math.log) > 0
            groups.setdefault(c if apart else "*+" if above and not variable else "*", []).extend(children[c])
        work += [((name, part), depth + 1, own) for part, own in groups.items()]
    return out


def _rendered(name: tuple) -> str:
    """The template of a chain (parent, part), the root's part being what leads to it."""
    parts = []
    while name is not None:
        name, part = name
        parts.append(part)
    return "/".join(reversed(parts))


def judge(pages: DataFrame, url: str = "url", rules=RULES, labels: Column | None = None, weight: float = WEIGHT, reject: float = REJECT) -> DataFrame:
    """pages with host, path, rule, template, purity (the smoothed share of bad pages) and verdict.

    ``labels`` is a column with 1 for bad and 0 for good pages, or null; without
    it the rules label. A null url, or one without ://, has an empty host and
    path, and is judged as that host's. A page whose template has no labels is
    allowed. Rows aren't merged, so repeated ones are judged alike; urls of any
    length and depth are read whole; an empty table gives no rows. Columns of
    the new names are replaced.
    """
    pages = pages.drop("host", "path", "rule", "template", "purity", "verdict")
    at = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    at = at.withColumn("__rule", matching_rule(F.col("host"), F.col("path"), rules))
    bad = F.when(F.col("__rule.verdict") == "block", 1).when(F.col("__rule.verdict") == "allow", 0) if labels is None else labels
    with Scratch(pages.sparkSession) as scratch:
        tree = templates(at.select("host", "path", bad.alias("bad")), scratch)
        by_template = tree.groupBy("host", "template").agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b"))
        whole = by_template.agg(F.sum("l").alias("wl"), F.sum("b").alias("wb"))
        by_host = by_template.groupBy("host").agg(F.sum("l").alias("hl"), F.sum("b").alias("hb"))
        below = F.lit(reject * 0.99)  # what isn't from the template's own labels rejects nothing
        prior = F.least((F.coalesce(F.col("wb"), F.lit(0)) + 0.5) / (F.coalesce(F.col("wl"), F.lit(0)) + 2), below)
        host_prior = F.least((F.col("hb") + weight * prior) / (F.col("hl") + weight), below)
        purity = (F.col("b") + weight * host_prior) / (F.col("l") + weight)
        rated = by_template.join(by_host, "host").join(F.broadcast(whole), F.lit(True)).select("host", "template", purity.alias("purity"))
        lookup = written(tree.select("host", F.col("shape").alias("__shape"), "template").join(rated, ["host", "template"]), "url-templates")
    out = at.withColumn("__shape", shape_of(F.col("path"))).join(small(lookup, 200_000), ["host", "__shape"])
    verdict = F.coalesce(F.col("__rule.verdict"), F.when(F.col("purity") >= reject, "block").otherwise("allow"))
    return out.select(*pages.columns, "host", "path", F.col("__rule.rule").alias("rule"), "template", "purity", verdict.alias("verdict"))


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "template", "purity")
