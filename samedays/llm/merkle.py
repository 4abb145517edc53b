"""A Merkle manifest of a table of documents: leaves, roots and proofs, with few levels stored.

Every document is a leaf, and the leaves of one `lang` form a tree with eight children per node. The roots of the
trees are the leaves of one more tree. All digests are lowercase hex sha256, and an inner node hashes the hex text of
its children.

1. Leaves are made in the scan; the text goes no further. Leaves are numbered within their tree by a range
   partition and the counts of its partitions, so a tree that holds most of the rows is spread like any other.
2. Checkpoint: only every `STRIDE`-th level is stored. A subtree of 8^STRIDE aligned nodes is the unit of
   work, bounded whatever the size of its tree; a task hashes it up to its top and keeps nothing but the top.
3. Recompute: from the top level down, every stored level meets the proofs of the level above it. The missing interior
   nodes of each aligned subtree are made again from its stored nodes, give the siblings of the nodes below, and
   are discarded. The proof of a stored node is what leads from it to the root; the proofs of the leaves
   themselves are never written, they are folded and hashed where they are made.

Defined results: a field that is null counts as `-`, so null ids, languages and texts are leaves like others. Leaves
ascend by doc_id, null first; among rows that share it, by digest. Repeated rows are leaves of their own in
neighbouring places. An empty table gives no rows. Texts of any length are hashed whole. Other columns, whatever
their names, have no part in it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samedays.llm.common import Scratch, lower_ascii
from samedays.operators.numbering import numbered

#: Fixed value: children of a node.
FANOUT = 8
#: Levels from one stored level to the next; 8^3 = 512 nodes in a subtree.
STRIDE = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(text: Column | None = None) -> Column:
    """The leaf of a row with the columns FIELDS; `text` takes the place of its text."""

    def field(name: str) -> Column:
        value = (text if text is not None and name == "text" else F.col(name)).cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        return F.coalesce(sized, F.lit("-"))

    return F.sha2(F.concat(*[field(name) for name in FIELDS]), 256)


def is_tampered() -> Column:
    """Rows whose text the query changes before it checks the proof."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 0


def _levels(size: int) -> int:
    """Levels above `size` nodes until one remains."""
    levels = 0
    while size > 1:
        size, levels = -(-size // FANOUT), levels + 1
    return levels


def _raise(digests: list[str], levels: int) -> list[list[str]]:
    """The digests of an aligned subtree and of each level above them."""
    made = [digests]
    for _ in range(levels):
        below = made[-1]
        made.append([_digest(below[i : i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return made


def _steps(made: list[list[str]], at: int) -> list[str]:
    """From a node of a subtree to its top: per level the run it stands in, as its place and the siblings."""
    steps = []
    for level in made[:-1]:
        first = at - at % FANOUT
        run = level[first : first + FANOUT]
        steps.append(f"{at - first}" + "".join(run[: at - first] + run[at - first + 1 :]))
        at //= FANOUT
    return steps


def _folded(digest: str, proof: list[str]) -> tuple[str, str]:
    """The root that a digest and its proof give, and the digest of all siblings."""
    siblings = hashlib.sha256()
    for step in proof:
        left = int(step[0]) * 64
        siblings.update(step[1:].encode())
        digest = _digest([step[1 : 1 + left], digest, step[1 + left :]])
    return digest, siblings.hexdigest()


def _climb(nodes: DataFrame, stride: int) -> DataFrame:
    """(tree, place, size, digest) of the next stored level from one stored level."""

    def top(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("place")
        size, levels = int(block["size"].iloc[0]), min(stride, _levels(int(block["size"].iloc[0])))
        made = _raise(block["digest"].tolist(), levels)
        place = int(block["place"].iloc[0]) // FANOUT**stride
        return pd.DataFrame({"tree": block["tree"].iloc[:1], "place": place, "size": -(-size // FANOUT**levels), "digest": made[-1]})

    block = F.floor(F.col("place") / F.lit(FANOUT**stride)).alias("block")
    return nodes.groupBy("tree", block).applyInPandas(top, "tree string, place long, size long, digest string")


def _stored_levels(leaves: DataFrame, scratch: Scratch, stride: int) -> list[DataFrame]:
    """Stored levels of all trees, leaves first. A tree that has come to its root is carried up as it is."""
    levels = [leaves]
    while levels[-1].agg(F.max("size")).first()[0] not in (None, 1):
        levels.append(scratch.keep(_climb(levels[-1], stride)))
    return levels


def _descend(nodes: DataFrame, above: DataFrame, stride: int) -> DataFrame:
    """(tree, place, size, digest, proof) of a stored level, from the proofs of the stored level above it."""
    block = F.floor(F.col("place") / F.lit(FANOUT**stride))
    schema = nodes.select("tree", "place", "size", "digest").schema
    tops = above.select("tree", F.col("place").alias("block"), "proof")
    columns = [field.name for field in schema]

    def proofs(key: tuple, members: pd.DataFrame, top: pd.DataFrame) -> pd.DataFrame:
        members = members.sort_values("place")
        made = _raise(members["digest"].tolist(), min(stride, _levels(int(members["size"].iloc[0]))))
        upper = top["proof"].iloc[0].tolist()
        return members[columns].assign(proof=[_steps(made, at) + upper for at in range(len(members))])

    placed = nodes.select(*columns, block.alias("block"))
    grouped = placed.groupBy("tree", "block").cogroup(tops.groupBy("tree", "block"))
    return grouped.applyInPandas(proofs, "tree string, place long, size long, digest string, proof array<string>")


def _tree_proofs(levels: list[DataFrame], root_proof: DataFrame, scratch: Scratch, stride: int) -> DataFrame:
    """(tree, place, proof) of the lowest stored level above the leaves; root_proof has (tree, proof) of the tops."""
    # new names for the columns: the leaves themselves may be the top
    top = levels[-1].join(root_proof, "tree").select(*[F.col(name).alias(name) for name in ("tree", "place", "proof")])
    for nodes in reversed(levels[1:-1]):
        top = scratch.keep(_descend(nodes, top, stride).select("tree", "place", "proof"))
    return top


def manifest(documents: DataFrame, tampered_text: Column | None = None, where: Column | None = None, stride: int = STRIDE) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every document.

    `tampered_text` stands for the text of the rows `where`: the proof is then folded from that leaf instead of the
    true one, and `verified` says whether it still leads to the root.
    """
    scratch = Scratch(documents.sparkSession, "merkle")
    fields = documents.select(*FIELDS)
    other = F.lit(None).cast("string") if tampered_text is None else F.when(where, leaf_digest(tampered_text))
    # the tree's name is the language behind a mark, so that the null language has a name, and comes first
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    made = fields.select("doc_id", tree.alias("tree"), leaf_digest().alias("digest"), other.alias("tampered"))
    # equal rows are told apart by where they are read, which spreads a large group of them
    listed = made.withColumn("copy", F.monotonically_increasing_id())
    order = [F.asc_nulls_first("doc_id"), "digest", "copy"]
    placed = numbered(listed, order, within=["tree"], keep=scratch.keep).withColumnRenamed("group_size", "size")
    # ids pass through pandas as text, where a null would make a float of an integer
    leaves = scratch.keep(placed.select(F.col("doc_id").cast("string"), "tree", "place", "size", "digest", "tampered"))

    levels = _stored_levels(leaves.select("tree", "place", "size", "digest"), scratch, stride)
    subroots = levels[-1].select("tree", "digest")
    upper = numbered(subroots, ["tree"], keep=scratch.keep).select(
        F.lit("").alias("tree"), "place", F.col("group_size").alias("size"), "digest", F.col("tree").alias("name")
    )
    upper = scratch.keep(upper)
    upper_levels = _stored_levels(upper.drop("name"), scratch, stride)
    root = upper_levels[-1].select(F.col("digest").alias("root"), F.array().cast("array<string>").alias("proof"))
    tops = _tree_proofs(upper_levels, root.select(F.lit("").alias("tree"), "proof"), scratch, stride)
    if len(upper_levels) > 1:
        lowest = _descend(upper_levels[0], tops, stride)
    else:
        lowest = tops
    named = upper.withColumnRenamed("digest", "subroot").join(lowest.select("tree", "place", "proof"), ["tree", "place"])
    whole = named.join(root.select(F.lit("").alias("tree"), "root"), "tree")
    subroot_proofs = scratch.keep(whole.select(F.col("name").alias("tree"), "subroot", "root", "proof"))

    tree_tops = _tree_proofs(levels, subroot_proofs.select("tree", "proof"), scratch, stride)
    rows = leaves.withColumn("block", F.floor(F.col("place") / F.lit(FANOUT**stride)) if len(levels) > 1 else F.col("place"))

    def results(key: tuple, members: pd.DataFrame, top: pd.DataFrame) -> pd.DataFrame:
        members = members.sort_values("place")
        made = _raise(members["digest"].tolist(), min(stride, _levels(int(members["size"].iloc[0]))))
        upper = top["proof"].iloc[0].tolist()
        found = []
        for at, (leaf, other) in enumerate(zip(members["digest"], members["tampered"], strict=True)):
            folded, siblings = _folded(leaf if other is None else other, _steps(made, at) + upper)
            found.append((siblings, folded))
        frame = pd.DataFrame(found, columns=["proof_sha256", "folded_root"], index=members.index)
        return pd.concat([members[["tree", "doc_id"]].assign(leaf=members["digest"]), frame], axis=1)

    tops = tree_tops.select("tree", F.col("place").alias("block"), "proof")
    schema = "tree string, doc_id string, leaf string, proof_sha256 string, folded_root string"
    folded = rows.groupBy("tree", "block").cogroup(tops.groupBy("tree", "block")).applyInPandas(results, schema)
    # a row per language, so that Spark broadcasts it while it is small and splits skewed languages where it is not
    judged = folded.join(subroot_proofs.select("tree", "subroot", "root"), "tree")
    doc_id = F.col("doc_id").cast(documents.schema["doc_id"].dataType)
    return judged.select(
        doc_id, "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def tampered(documents: DataFrame) -> DataFrame:
    """The manifest, checked against texts whose A-Z are lower-cased in a third of the rows."""
    return manifest(documents, lower_ascii(F.col("text")), is_tampered())
