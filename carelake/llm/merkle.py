"""A Merkle manifest of a dataset: a tree per source, a tree over the sources' roots, a proof per row.

Nodes get their place in their tree from one global order. At each level a parent's children are
spread into ``FANOUT`` columns by conditional aggregates on the slot (place modulo fan-out); the
columns in order hash to the parent. On the way down the same columns without the own slot are a
node's siblings, so no row is joined with its up to fifteen neighbours: a level below the root
costs one join of the parents with their own paths.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import Placed
from ..session import written

FANOUT = 16
#: Copies of the small table of sources, so that a source with most rows meets it in many tasks.
SALTS = 32
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<before:string,after:string>>"


def row_hash(values: list[Column]) -> Column:
    """Hash of the values, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(field, values)), 256)


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """The written levels of all trees, lowest first: each parent with its children in columns.

    ``nodes``: tree, n (nodes of the tree on this level), pos and node, a struct with ``digest``.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels = []
    while most > 1:
        slots = [F.max(F.when(F.col("pos") % FANOUT == k, F.col("node"))).alias(f"c{k}") for k in range(FANOUT)]
        parents = nodes.where("n > 1").groupBy("tree", "n", F.expr(f"pos div {FANOUT}").alias("at")).agg(*slots)
        digest = F.sha2(F.concat_ws("", *[F.col(f"c{k}.digest") for k in range(FANOUT)]), 256)
        levels.append(written(parents.withColumn("digest", digest), f"merkle-level{len(levels)}"))
        most = -(-most // FANOUT)
        nodes = _above(levels[-1])
    return levels


def _above(level: DataFrame) -> DataFrame:
    return level.select("tree", F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"), F.col("at").alias("pos"), F.struct("digest").alias("node"))


def _roots(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """A row per tree: tree and the digest that remains."""
    ends = [part.where("n = 1").select("tree", F.col("node.digest").alias("digest")) for part in [nodes, *map(_above, levels)]]
    return reduce(DataFrame.union, ends)


def _paths(nodes: DataFrame, levels: list[DataFrame], starts: DataFrame) -> DataFrame:
    """Every node with what stands on its tree's start (``path`` and more) and its own path put before it.

    A path lists, from the node up, the siblings before and after; ``starts`` holds tree and path.
    """
    carried = [c for c in starts.columns if c not in ("tree", "path")]
    heights = range(len(levels), 0, -1)
    open_ = None  # paths of the parents of the level at hand, from the level above
    for h in heights:
        level = levels[h - 1]
        top = level.where(F.col("n") <= FANOUT).select("tree", "at").join(starts, "tree")
        open_ = top if open_ is None else open_.unionByName(top)
        kids = F.array_compact(F.array(*[f"c{k}" for k in range(FANOUT)]))
        spread = level.select("tree", "at", kids.alias("kids")).join(open_, ["tree", "at"])
        digests = F.transform("kids", lambda kid: kid["digest"])
        each = spread.select("*", digests.alias("digests"), F.posexplode("kids").alias("slot", "node"))
        step = F.struct(
            F.concat_ws("", F.slice("digests", 1, F.col("slot"))).alias("before"),
            F.concat_ws("", F.slice("digests", F.col("slot") + 2, FANOUT)).alias("after"),
        )
        longer = F.concat(F.array(step), F.col("path")).cast(PATH).alias("path")
        if h > 1:
            open_ = each.select("tree", (F.col("at") * FANOUT + F.col("slot")).alias("at"), longer, *carried)
        else:
            open_ = each.select("tree", "node", longer, *carried)
    alone = nodes.where("n = 1").select("tree", "node").join(starts, "tree").select("tree", "node", "path", *carried)
    return alone if open_ is None else alone.unionByName(open_)


def manifest(rows: DataFrame, altered: Callable[[Column], Column] | None = None, suspect: Column | None = None) -> DataFrame:
    """A row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``altered`` gives a text's later form and ``suspect`` says for which rows it is what is found
    now: the root is folded from the leaf as it is now and the siblings of the manifest, and
    ``verified`` says whether it is the root. Null values have a form of their own in the leaf;
    a null source is a tree of its own and comes first, null ids come first in their source;
    rows equal in source and id stand in order of their leaves, so the roots do not depend on
    how the table is stored; repeated rows are leaves of their own. An empty table gives no
    rows. Only the five columns of a document are read. Jobs run while this is called.
    """
    leaf = row_hash([rows[c] for c in COLUMNS])
    now = leaf
    if altered is not None:
        changed = row_hash([altered(rows[c]) if c == "text" else rows[c] for c in COLUMNS])
        now = F.when(suspect, changed).otherwise(leaf)
    leaves = written(rows.select(rows["source"].alias("source"), rows["doc_id"].alias("doc_id"), leaf.alias("digest"), now.alias("now")), "merkle-leaves")
    placed = Placed(leaves, [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("digest").asc()]).rows
    # A source's first place names its tree, in the order of the sources.
    trees = written(placed.groupBy("source").agg(F.min("_pos").alias("tree"), F.count("*").alias("n")), "merkle-trees")
    salted = trees.select(F.col("source").alias("of"), "tree", "n", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    nodes = placed.join(salted, F.col("source").eqNullSafe(F.col("of")) & (F.col("_pos") % SALTS == F.col("salt"))).select(
        "tree", "n", (F.col("_pos") - F.col("tree")).alias("pos"), F.struct("digest", "now", "doc_id").alias("node")
    )
    levels = _levels(nodes)
    subroots = Placed(_roots(nodes, levels), [F.col("tree").asc()])
    tops = subroots.rows.select(F.lit(0).alias("tree"), F.lit(subroots.total).alias("n"), F.col("_pos").alias("pos"), F.struct("digest", F.col("tree").alias("of")).alias("node"))
    top_levels = _levels(tops)
    start = _roots(tops, top_levels).select("tree", F.col("digest").alias("root"), F.array().cast(PATH).alias("path"))
    starts = _paths(tops, top_levels, start).select(F.col("node.of").alias("tree"), "path", F.col("node.digest").alias("subroot"), "root")
    proven = _paths(nodes, levels, written(starts, "merkle-starts"))
    siblings = F.concat_ws("", F.transform("path", lambda s: F.concat(s["before"], s["after"])))
    folded = F.aggregate("path", F.col("node.now"), lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))
    return proven.select(
        F.col("node.doc_id").alias("doc_id"), F.col("node.digest").alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def every_fifth(doc_id: Column) -> Column:
    """Rows whose id, in decimal, has a CRC-32 that 5 divides; a null id is none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))
