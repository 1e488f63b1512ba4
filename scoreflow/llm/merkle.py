"""A Merkle manifest of a dataset by nested-interval labels.

Each node of a language's tree carries the interval of leaf ranks that it covers. A level's nodes come from
runs of eight nodes below: grouping by the interval's bucket. Downwards, a node meets its ancestor through
that bucket and the ancestor's interval containing its own; its siblings are what is left of the ancestor's
children when its own interval is taken out. So every node learns its path to the root, level by level, and
leaves get theirs with the run that they lie in: no path of a leaf is ever moved.

Ranks come from range partitions: place in a sorted partition plus the counts of the ones before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoreflow.llm.common import stored, table

FANOUT = 8
#: One document in so many, by crc32 of its id, is tampered with.
TAMPER_EVERY = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """A leaf's input for one field: `-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(text: Column) -> Column:
    return digest(*(field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")), field(text))


def leaves_of(docs: DataFrame, tamper_every: int = TAMPER_EVERY) -> DataFrame:
    """tree, doc_id, leaf, tampered: `tree` orders languages, null first; `tampered` is null where nothing changes."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % tamper_every == 0
    changed = leaf_digest(F.translate(F.col("text"), UPPER, LOWER))
    return docs.select(
        F.when(F.col("lang").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("lang").cast("string"))).alias("tree"),
        F.col("doc_id"), leaf_digest(F.col("text")).alias("leaf"),
        F.when(chosen & F.col("text").isNotNull(), changed).alias("tampered"),
    )


def with_ranks(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` (tree, ...) with `lo`, the rank within the tree by `order`, and `n`, the tree's number of rows.

    Range partitions go by tree, order and the row's place in the input, so that neither a large tree nor a
    value that many rows share falls to one task. The sorted rows are written with their places before the
    ranks are made, which keeps places fixed if an executor is lost.
    """
    columns = rows.columns
    placed = stored(rows.withColumn("_tie", F.monotonically_increasing_id()), "merkle-rows")
    keys = ["tree", *order, "_tie"]
    dealt = placed.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    dealt = stored(dealt.select(*columns, "_place"), "merkle-sorted").withColumn("_part", F.shiftright("_place", 33))
    # One row for each tree and task: a task's rows of a tree stand side by side.
    blocks = dealt.groupBy("tree", "_part").agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    within = Window.partitionBy("tree").orderBy("_part")
    blocks = blocks.select(
        "tree", "_part", "_first", F.sum("_rows").over(Window.partitionBy("tree")).alias("n"),
        (F.sum("_rows").over(within) - F.col("_rows")).alias("_before"),
    )
    return dealt.join(blocks, ["tree", "_part"]).select(
        *columns, (F.col("_before") + F.col("_place") - F.col("_first")).alias("lo"), "n")


def _joined(children: Column) -> Column:
    return F.array_join(F.transform(children, lambda c: c["digest"]), "")


def runs_of(leaves: DataFrame, fanout: int) -> DataFrame:
    """Level 1: one row for each run of leaves, with the leaves inside. A lone leaf is its own run and digest."""
    child = F.struct("lo", (F.col("lo") + 1).alias("hi"), F.col("leaf").alias("digest"), *(
        c for c in leaves.columns if c not in ("tree", "lo", "n", "leaf")))
    runs = leaves.groupBy("tree", "n", (F.col("lo") - F.col("lo") % fanout).alias("bucket")).agg(
        F.array_sort(F.collect_list(child)).alias("children"))
    return runs.select(
        "tree", "n", F.col("bucket").alias("lo"), F.least(F.col("bucket") + fanout, F.col("n")).alias("hi"), "children",
        F.when(F.col("n") == 1, F.col("children")[0]["digest"]).otherwise(F.sha2(_joined(F.col("children")), 256)).alias("digest"),
    )


def build(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """The nodes of all trees, a table for each level from 1 up: tree, n, lo, hi, children, digest. A tree ends at
    the level where one node covers all its leaves."""
    levels = [stored(runs_of(leaves, fanout), "merkle-runs")]
    largest = levels[0].agg(F.max("n")).head()[0] or 0
    width = fanout
    while width < largest:  # some trees have several nodes of this width
        below = levels[-1].where(F.col("n") > width).select("tree", "n", F.struct("lo", "hi", "digest").alias("child"))
        above = below.groupBy("tree", "n", F.expr(f"child.lo - child.lo % {width * fanout}").alias("lo")).agg(
            F.array_sort(F.collect_list("child")).alias("children"))
        width *= fanout
        levels.append(stored(above.select(
            "tree", "n", "lo", F.least(F.col("lo") + width, F.col("n")).alias("hi"), "children",
            F.sha2(_joined(F.col("children")), 256).alias("digest")), "merkle-level"))
    return levels


def _side(children: Column, keep) -> Column:
    return _joined(F.filter(children, keep))


def siblings(children: Column, lo: Column, hi: Column) -> Column:
    """What the interval lo..hi leaves of an ancestor's children: digests to its left and to its right."""
    return F.struct(
        _side(children, lambda c: c["hi"] <= lo).alias("left"), _side(children, lambda c: c["lo"] >= hi).alias("right"))


def paths(levels: list[DataFrame], tops: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """tree, n, children, and for each run its `path`: the siblings of the run, of its ancestors, and the path that
    `tops` (tree, subroot, path, root) has for the tree."""
    width = fanout ** len(levels)
    attached = None
    for nodes in reversed(levels):
        # A tree begins at its top; the nodes under it have an ancestor at the level above.
        whole = nodes.where(F.col("n") <= width).join(tops, "tree")
        found = whole.select("tree", "n", "lo", "hi", "children", "subroot", "root", "path")
        if attached is not None:
            up = attached.select(
                "tree", F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi"), F.col("children").alias("up_children"),
                "subroot", "root", "path", F.col("lo").alias("bucket"))
            own = nodes.where(F.col("n") > width).withColumn("bucket", F.col("lo") - F.col("lo") % (width * fanout))
            met = own.join(up, ["tree", "bucket"]).where((F.col("up_lo") <= F.col("lo")) & (F.col("hi") <= F.col("up_hi")))
            found = found.unionByName(met.select(
                "tree", "n", "lo", "hi", "children", "subroot", "root",
                F.concat(F.array(siblings(F.col("up_children"), F.col("lo"), F.col("hi"))), F.col("path")).alias("path")))
        attached, width = found, width // fanout
    return attached


def tops_of(levels: list[DataFrame], fanout: int) -> DataFrame:
    """tree, digest of the one node that covers the whole tree."""
    found, width = None, fanout
    for nodes in levels:
        top = nodes.where(F.col("n") <= width).select("tree", "digest")
        found, width = top if found is None else found.unionByName(top), width * fanout
    return found


def with_leaf_paths(attached: DataFrame) -> DataFrame:
    """One row for each leaf, `child`, with its whole path; a lone leaf has no siblings of its own."""
    rows = attached.select("tree", "n", "subroot", "root", "children", "path", F.explode("children").alias("child"))
    first = F.array(siblings(F.col("children"), F.col("child.lo"), F.col("child.hi")))
    return rows.withColumn("path", F.when(F.col("n") == 1, F.col("path")).otherwise(F.concat(first, F.col("path"))))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda at, s: F.sha2(F.concat(s["left"], at, s["right"]), 256))


def manifest(docs: DataFrame, fanout: int = FANOUT, tamper_every: int = TAMPER_EVERY) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row for each row of `docs`
    (doc_id, source, lang, n_chars, text).

    Nulls are the field `-`; null languages are a tree of their own, before all others; null ids come first in
    their tree and are never tampered with. Rows that repeat an id are leaves each, in the order of their digests.
    An empty table gives no rows; a language with one document is its leaf. Other columns are ignored.
    """
    levels = build(with_ranks(leaves_of(docs, tamper_every), ["doc_id", "leaf"]), fanout)
    subroots = tops_of(levels, fanout).select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("digest").alias("leaf"))
    upper = build(with_ranks(subroots, ["of"]), fanout)
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    root = tops_of(upper, fanout).select(
        "tree", F.lit(None).cast("string").alias("subroot"), nothing.alias("path"), F.col("digest").alias("root"))
    ends = with_leaf_paths(paths(upper, root, fanout))
    tops = stored(ends.select(
        F.col("child.of").alias("tree"), F.col("child.digest").alias("subroot"), "root", "path"), "merkle-tops")
    leaves = with_leaf_paths(paths(levels, tops, fanout))
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    given = F.coalesce(F.col("child.tampered"), F.col("child.digest"))
    out = leaves.select(
        F.col("child.doc_id").alias("doc_id"), F.col("child.digest").alias("leaf"), "subroot", "root",
        F.sha2(proof, 256).alias("proof_sha256"), folded(given, F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))
