"""Merkle manifest of a table of documents, by joins of nodes with their siblings.

A leaf is the SHA-256 (lower-case hex) of a document's FIELDS, each `-` if null, else its UTF-8 bytes' count, `:` and the
value. The leaves of a source are in order of doc_id (nulls first, equal ids by digest); every FAN nodes that follow
each other, the last run perhaps fewer, become the hash of their joined digests, level by level, until one node is
left: the source's subroot, which is the leaf itself where there is only one. The subroots in order of source (null
first, by UTF-8 bytes) are the leaves of one more tree, whose top is the root.

A node is a row (tree, run, slot, digest): `slot` is its place in its run of FAN. On every level nodes are joined by an
equijoin with the computed slots of their run, which gives each its siblings' digests; of these rows those of slot 0 emit
the parents. Both sides of that join, the aggregate after it and the join with what lies above are dealt by (tree, run),
so a level is shuffled once and a source of any size is spread over tasks. From the top down, each node's path (the
digests left and right of it, level by level) is its own step and its parent's path; paths are stored for one node in FAN
and less. The driver holds the root and whether a level has parents; the number of levels grows with the logarithm.

Repeated rows are leaves of their own. A row without doc_id is a leaf and is never altered. Columns besides FIELDS do not
count. An empty table has no root and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import id_checksum, key_of, numbered, store
from kerbside.session import setting

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# What is dealt by (tree, run) may be joined on these and more columns without another shuffle.
BY_SOME_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<left:string, right:string>>"


def leaf(altered: dict[str, Column] | None = None) -> Column:
    """The digest of a document, of some of whose fields other values may be given."""
    texts = [(altered or {}).get(name, F.col(name)).cast("string") for name in FIELDS]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, altered: dict[str, Column], where: Column) -> DataFrame:
    """(tree, doc_id, leaf, shown) in numbered order; `shown` is the leaf as presented, altered where the condition holds."""
    found = store(docs.select(key_of("source").alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                              leaf().alias("leaf"), F.when(where, leaf(altered)).alias("shown"),
                              F.monotonically_increasing_id().alias("row")), "manifest-leaves")
    # Repeated rows are equal in all but `row`, by which ranges can part them.
    return numbered(found, "tree", ["doc_id", "leaf", "row"], "manifest-order").select(
        "tree", "index", F.col("leaf").alias("digest"), "doc_id", F.coalesce("shown", "leaf").alias("shown"))


def placed(nodes: DataFrame) -> DataFrame:
    """Nodes with their run and their slot in it in place of their index, dealt by run."""
    return (nodes.withColumns({"run": F.expr(f"index div {FAN}"), "slot": (F.col("index") % FAN).cast("int")})
            .drop("index").repartition("tree", "run"))


def steps(nodes: DataFrame, first_only: bool = False) -> DataFrame:
    """Placed nodes, or those of slot 0, with the digests `left` and `right` of them; `alone` for the only one of a tree."""
    others = F.explode(F.sequence(F.lit(0), F.lit(FAN - 1))).alias("other")
    takers = nodes.filter("slot = 0") if first_only else nodes
    members = nodes.select("tree", "run", F.col("slot").alias("other"), F.col("digest").alias("sibling"))
    found = takers.select("*", others).join(members, ["tree", "run", "other"])
    kin = (found.groupBy(*nodes.columns).agg(F.array_sort(F.collect_list(F.struct("other", "sibling"))).alias("kin")))

    def side(holds) -> Column:
        return F.array_join(F.transform(F.filter("kin", lambda k: holds(k["other"])), lambda k: k["sibling"]), "")
    return kin.select(*nodes.columns, side(lambda other: other < F.col("slot")).alias("left"),
                      side(lambda other: other > F.col("slot")).alias("right"),
                      ((F.col("run") == 0) & (F.size("kin") == 1)).alias("alone"))


def climb(nodes: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """The placed nodes of every level, and for every level what it emits: (tree, index, digest, alone), a parent, or
    the top of a tree that ends there."""
    levels, above = [], []
    while True:
        levels.append(placed(nodes))
        emitted = steps(levels[-1].select("tree", "run", "slot", "digest"), first_only=True)
        parent = F.when(F.col("alone"), F.col("digest")).otherwise(F.sha2(F.concat("digest", "right"), 256))
        above.append(store(emitted.select("tree", F.col("run").alias("index"), parent.alias("digest"), "alone"),
                           f"manifest-level-{len(levels)}"))
        nodes = above[-1].filter("not alone").drop("alone")
        if nodes.isEmpty():
            return levels, above


def descend(levels: list[DataFrame], above: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest nodes with their path to the root, from the paths (tree, top, path) of the trees' tops."""
    paths = None
    for level in reversed(range(len(levels))):
        ended = above[level].filter("alone").select("tree").join(tops, "tree")
        over = ended.select("tree", F.lit(0).cast("long").alias("run"), "top", "path")
        if paths is not None:
            over = over.unionAll(paths.select("tree", F.expr(f"run * {FAN} + slot").alias("run"), "top", "path"))
        own = F.when(F.col("alone"), F.array().cast(PATH)).otherwise(F.array(F.struct("left", "right")))
        paths = (steps(levels[level]).join(over.repartition("tree", "run"), ["tree", "run"])
                 .select(*levels[level].columns, "top", F.concat(own, "path").alias("path")))
        if level:
            paths = store(paths, f"manifest-path-{level}")
    return paths


def prove(docs: DataFrame, altered: dict[str, Column], where: Column) -> DataFrame:
    """One row per document: its leaf, its source's subroot, the root, its siblings' hash, and whether the document as
    presented (altered where the condition holds) still leads to the root."""
    spark = docs.sparkSession
    with setting(spark, BY_SOME_KEYS, "false"):
        levels, above = climb(leaves(docs, altered, where))
        subroots = above[0].filter("alone")
        for emitted in above[1:]:
            subroots = subroots.unionAll(emitted.filter("alone"))
        subroots = numbered(subroots.select(F.lit("").alias("forest"), "tree", "digest"), "forest", ["tree"],
                            "manifest-subroots")
        upper, over = climb(subroots.select(F.col("forest").alias("tree"), "index", "digest", F.col("tree").alias("source")))
        top = over[-1].filter("alone")
        root = top.select("digest").first()  # one row, or none for an empty table
        whole = descend(upper, over, top.select("tree", F.col("digest").alias("top"), F.array().cast(PATH).alias("path")))
        tops = store(whole.select(F.col("source").alias("tree"), F.col("digest").alias("top"), "path"), "manifest-tops")
        found = descend(levels, above, tops)
        siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
        folded = F.aggregate("path", F.col("shown"), lambda at, s: F.sha2(F.concat(s["left"], at, s["right"]), 256))
        found = store(found.select("doc_id", F.col("digest").alias("leaf"), F.col("top").alias("subroot"),
                                   F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root")),
                      "manifest-proofs")
    root = F.lit(root and root[0]).cast("string")
    return found.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
                        (F.col("folded_root") == root).alias("verified"))


def check_altered(docs: DataFrame) -> DataFrame:
    """Proofs where every document whose id's checksum 5 divides is presented with A-Z of its text in lower case."""
    return prove(docs, {"text": F.translate("text", UPPER, LOWER)}, id_checksum() % 5 == 0)
