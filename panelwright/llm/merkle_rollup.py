"""Merkle manifest of a dataset as a rollup of nested structs (operator 12).

Every row is a leaf, the digest of its fields. Leaves stand in order inside their language; a run of 8
nodes becomes one until a single node, the subroot, is left, and the subroots of all languages become the
root the same way. A row's proof is its siblings on the way up; folding the leaf with them gives the root.

The rank of a leaf, in digits to base 8, says where it stands at each level. Blocks of 512 consecutive
nodes meet in one task, which groups the digits away one after another: children become an array of
structs inside their parent, and the block is one row with its whole tree inside. Blocks are the nodes of
the next round, so a language of any size takes one round for each factor of 512. On the way down a
transform over the nested arrays gives each node its siblings, one explode makes rows of the nodes: inside a
block proofs need no join. Between rounds one row a block is joined to the proof of its own root.

Ranks: rows are sorted by range over all tasks, each task numbers what it holds, and sums over one row a task
and language give the numbers to start with. No language is in one task, however many rows it has. All of it
is DataFrame functions; text is read once, then only digests move.

Defined results: a null field is ``-``, an empty text ``0:``. Languages are ordered null first, then by UTF-8
bytes; rows of one language by id, null first, then by leaf, so repeated rows are separate leaves with one
after the other. A row without an id is never tampered with. A lone leaf is its own subroot, the subroot of an
only language is the root: the proof is empty where both hold. An empty table gives no rows. Other columns are
not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelwright.llm.common import partitions, stage, unstage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_LEVELS = 3  # of a block
_BITS = 3  # 8 children
_BLOCK = 1 << _BITS * _LEVELS
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of the fields: each is ``-`` if null, else its length in bytes, a colon and its value."""
    texts = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf and changed: the leaf after tampering, null where the row is left alone."""
    plain = {c: F.col(c) for c in FIELDS}
    tampered = plain | {"text": lower_ascii(F.col("text"))}
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return docs.select(
        "doc_id",
        F.col("lang").cast("string").alias("lang"),
        leaf_digest(list(plain.values())).alias("leaf"),
        F.when(hit, leaf_digest(list(tampered.values()))).alias("changed"),
    )


def ranked(rows: DataFrame, tree: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with ``i``, the rank from 0 inside their tree, and ``n``, the number of the tree's rows.

    The second table is the staged one that they read.
    """
    number = F.monotonically_increasing_id()
    by = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *by).sortWithinPartitions(*by)
    dealt = stage(dealt.withColumn("_number", number), "ranks", False)
    part = F.shiftright("_number", 33).alias("_part")
    held = dealt.groupBy(tree, part).agg(F.min("_number").alias("_first"), F.count("*").alias("_held"))
    before = Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select(
        F.col(tree).alias("_tree"),
        F.col("_part").alias("_of"),
        "_first",
        F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_start"),
        F.sum("_held").over(Window.partitionBy(tree)).alias("n"),
    )
    same = F.col(tree).eqNullSafe(F.col("_tree")) & (F.shiftright("_number", 33) == F.col("_of"))
    joined = dealt.join(starts, same)
    return joined.select(*rows.columns, (F.col("_number") - F.col("_first") + F.col("_start")).alias("i"), "n"), dealt


def _nodes_at(level: int) -> Column:
    """Number of nodes of the tree at a level, its ``n`` nodes at level 0."""
    return F.shiftright(F.col("n") + ((1 << _BITS * level) - 1), _BITS * level)


def roll(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, i, n, h, more) of one level to blocks (tree, i, n, h, kids) three levels up.

    ``n`` stays the count of the nodes below. While a tree has one node, the node goes up unchanged.
    """
    more = [c for c in nodes.columns if c not in ("tree", "i", "n")]
    digits = [F.shiftright("i", _BITS * k).alias(f"d{k}") for k in range(1, _LEVELS + 1)]
    rows = nodes.select("tree", "n", *digits, F.struct("i", *more).alias("node")).repartition("tree", f"d{_LEVELS}")
    for k in range(1, _LEVELS + 1):
        left = [f"d{j}" for j in range(k, _LEVELS + 1)]
        rows = rows.groupBy("tree", "n", *left).agg(F.array_sort(F.collect_list("node")).alias("kids"))
        h = F.when(_nodes_at(k - 1) == 1, F.col("kids")[0]["h"]).otherwise(F.sha2(F.array_join("kids.h", ""), 256))
        rows = rows.select("tree", "n", *left[1:], F.struct(F.col(f"d{k}").alias("i"), h.alias("h"), "kids").alias("node"))
    return rows.select("tree", "node.i", "n", "node.h", "node.kids")


def unroll(blocks: DataFrame) -> DataFrame:
    """Blocks with ``above``, the proof of their own node, to their nodes with ``path``, each one's proof.

    A proof is an array of (before, after), the siblings of a level, from the lowest level up.
    """

    def placed(kids: Column, level: int, path: Column | None) -> Column:
        def one(kid: Column, j: Column) -> Column:
            before = F.array_join(F.transform(F.slice(kids, 1, j), lambda k: k["h"]), "")
            after = F.array_join(F.transform(F.slice(kids, j + 2, 1 << _BITS), lambda k: k["h"]), "")
            step = F.array(F.struct(before.alias("before"), after.alias("after")))
            step = F.when(_nodes_at(level) == 1, F.slice(step, 1, 0)).otherwise(step)
            return F.struct(kid.alias("node"), (step if path is None else F.concat(step, path)).alias("path"))

        return F.transform(kids, one)

    def below(found: Column, level: int) -> Column:
        return F.flatten(F.transform(found, lambda x: placed(x["node"]["kids"], level, x["path"])))

    found = placed(F.col("kids"), _LEVELS - 1, None)
    for level in range(_LEVELS - 2, -1, -1):
        found = below(found, level)
    kept = [c for c in blocks.columns if c not in ("i", "n", "h", "kids", "above")]
    rows = blocks.select(*kept, "above", F.explode(found).alias("found"))
    return rows.select(*kept, "found.node.*", F.concat("found.path", "above").alias("path"))


def _rolled(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Rounds of blocks, the last with one block a tree; ``most`` nodes are in the largest tree."""
    rounds = []
    while not rounds or most > 1:
        rounds.append(stage(roll(nodes), "blocks", False))
        most = -(-most // _BLOCK)
        nodes = rounds[-1].select("tree", "i", F.shiftright(F.col("n") + (_BLOCK - 1), _BITS * _LEVELS).alias("n"), "h")
    return rounds


def _proofs(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Down the rounds: above has (tree, path, more) of each tree's last block."""
    found = above.withColumn("i", F.lit(0).cast("long"))
    for blocks in reversed(rounds):
        more = [c for c in found.columns if c not in ("tree", "i", "h", "path")]
        own = found.select(F.col("tree").alias("_tree"), F.col("i").alias("_i"), F.col("path").alias("above"), *more)
        same = blocks["tree"].eqNullSafe(own["_tree"]) & (blocks["i"] == own["_i"])
        found = unroll(blocks.join(own, same).drop("_tree", "_i"))
    return found


def fold(leaf: Column, path: Column) -> Column:
    """Root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(p["before"], h, p["after"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    own = stage(leaves(docs), "leaves", False)
    rows, dealt = ranked(own, "lang", ["doc_id", "leaf"])
    rows = rows.select(F.col("lang").alias("tree"), "i", "n", F.col("leaf").alias("h"), "doc_id", "changed")
    most = own.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    rounds = _rolled(rows, most)
    unstage(own, dealt)
    subroots = rounds[-1].select("tree", "h")
    tops, dealt = ranked(subroots.withColumn("all", F.lit(0)), "all", ["tree"])
    tops = tops.select(F.col("all").alias("tree"), "i", "n", "h", F.col("tree").alias("lang"))
    upper = _rolled(tops, subroots.count())
    unstage(dealt)
    nothing = F.array(F.struct(F.lit("").alias("before"), F.lit("").alias("after")))
    root = upper[-1].select("tree", F.col("h").alias("root"), F.slice(nothing, 1, 0).alias("path"))
    top = _proofs(upper, root).select(F.col("lang").alias("tree"), F.col("h").alias("subroot"), "root", "path")
    found = _proofs(rounds, top)
    siblings = F.array_join(F.transform("path", lambda p: F.concat(p["before"], p["after"])), "")
    found = found.select(
        "doc_id",
        F.col("h").alias("leaf"),
        "subroot",
        "root",
        F.sha2(siblings, 256).alias("proof_sha256"),
        fold(F.coalesce("changed", "h"), F.col("path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
