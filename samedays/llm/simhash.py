"""SimHash near-duplicates, linked through shard trees keyed by Hamming distance (BK-trees).

1. A text's fingerprint is made where the text is read; no shuffle carries text.
2. Distinct fingerprints are cut into `radius + 1` blocks of bits. Two that differ in `radius` bits at most agree on
   a block, so one copy per block routes every link to a shard: the fingerprints that share the block. A shard with
   more than `max_shard` fingerprints is cut once more the same way over the bits that its block does not fix.
3. Each shard becomes a BK-tree in the task that holds the shard and its queries: a child's key is its distance to
   the parent, and a search follows only keys within the radius of its own distance. Sending the shard to the task
   takes the place of broadcasting every shard to every task, which would be quadratic in the documents.
4. A shard reports its links as a forest, one link per member at most, never all pairs of a group. Components of
   these links are found by star contraction over tables in the shared folder.

Defined results: null or blank text has fingerprint zero, which is linked like any other. A null id takes part; its
component is the least id that is not null, null if there is none. Repeated rows give repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samedays.llm.common import Scratch
from samedays.llm.components import connected_components

BITS = 64
SEED = 42
#: Parameters of the contract.
SHINGLE, RADIUS = 4, 4
#: Fingerprints in a shard before it is cut by a second block.
MAX_SHARD = 2048
#: Copies of the list of components in its join: a large one's fingerprints go to as many tasks.
SALTS = 16
#: Pairs of query and node that a search holds at once.
FRONTIER = 2_000_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of a text: a bit is set if it is in over half the hashes of the shingles."""
    found = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not found:
        return 0
    data = b" ".join(found)
    hashed = xxhash.xxh64_intdigest
    if len(found) <= shingle:
        return hashed(data, SEED)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    view = memoryview(data)
    places = zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=False)
    hashes = np.fromiter((hashed(view[s:e], SEED) for s, e in places), np.uint64, len(found) - shingle + 1)
    counts = np.zeros(BITS, np.int64)
    for begin in range(0, len(hashes), 1 << 16):
        part = hashes[begin : begin + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, carry: Sequence[str] = ()
) -> DataFrame:
    """(doc_id, fp) and the columns to carry: fp is the fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = np.fromiter((fingerprint(t, shingle) for t in batch["_text"]), np.uint64, len(batch))
            yield batch.drop(columns="_text").assign(doc_id=batch["doc_id"].astype("Int64"), fp=made.view(np.int64))

    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), *carry, F.col(text).cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "_text")
    return source.mapInPandas(run, f"{schema}, fp long")


def _blocks(total: int, parts: int) -> list[tuple[int, int]]:
    """(first bit, width) of nearly equal blocks."""
    edges = [total * i // parts for i in range(parts + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:], strict=False)]


def _rest_blocks(block: int, parts: int) -> list[int]:
    """Masks that deal the bits outside a block into parts."""
    low, width = _blocks(BITS, parts)[block]
    rest = [bit for bit in range(BITS) if not low <= bit < low + width]
    return [sum(1 << bit for bit in rest[first : first + size]) for first, size in _blocks(len(rest), parts)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def route(nodes: DataFrame, radius: int = RADIUS, max_shard: int = MAX_SHARD) -> DataFrame:
    """(shard, fp): any two fingerprints within the radius are together in one shard at least.

    The first cut is one copy per block. Sizes of the shards are a partial aggregate; members of a large one are
    copied again, one copy per block of the bits left. No shard is dropped or limited.
    """
    parts = radius + 1
    masks = [_signed(((1 << width) - 1) << low) for low, width in _blocks(BITS, parts)]
    cut = F.array(*[F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for i, m in enumerate(masks)])
    first = nodes.select("fp", F.inline(cut))
    sizes = first.groupBy("block", "value").agg(F.count("*").alias("n"))
    sized = first.join(sizes, ["block", "value"])
    inner = F.array().cast("array<struct<part:int,bits:bigint>>")
    for block in range(parts):
        cuts = [
            F.struct(F.lit(j).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits"))
            for j, m in enumerate(_rest_blocks(block, parts))
        ]
        inner = F.when(F.col("block") == block, F.array(*cuts)).otherwise(inner)
    whole = F.array(F.struct(F.lit(-1).alias("part"), F.lit(0).cast("long").alias("bits")))
    dealt = sized.select("fp", "block", "value", F.inline(F.when(F.col("n") > max_shard, inner).otherwise(whole)))
    return dealt.select(F.struct("block", "value", "part", "bits").alias("shard"), "fp")


class ShardTrees:
    """BK-trees of many shards at once, as arrays. A node is a fingerprint; `key` sorts nodes by (parent, distance)."""

    def __init__(self, shard: np.ndarray, fps: np.ndarray) -> None:
        n = len(fps)
        self.fps, self.root = fps, np.zeros(n, np.int64)
        parent = np.full(n, -1, np.int64)
        edge = np.zeros(n, np.int64)
        open_nodes, group = np.arange(n), shard
        first = True
        while len(open_nodes):
            # the first of each group becomes its node, all others go on to the child at their distance from it
            _, at, member = np.unique(group, return_index=True, return_inverse=True)
            node = open_nodes[at][member]
            if first:
                self.root = node.copy()
            rest = node != open_nodes
            below, above = open_nodes[rest], node[rest]
            distance = np.bitwise_count(fps[below] ^ fps[above]).astype(np.int64)
            parent[below], edge[below] = above, distance
            open_nodes, group, first = below, above * (BITS + 1) + distance, False
        held = np.flatnonzero(parent >= 0)
        keys = parent[held] * (BITS + 1) + edge[held]
        order = np.argsort(keys, kind="stable")
        self.children, self.keys = held[order], keys[order]

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, node) pairs at distance radius or less, the query itself excluded, a level of the trees at a time."""
        node = self.root[queries]
        while len(queries):
            distance = np.bitwise_count(self.fps[queries] ^ self.fps[node]).astype(np.int64)
            hit = (distance <= radius) & (queries != node)
            yield queries[hit], node[hit]
            base = node * (BITS + 1)
            low = np.searchsorted(self.keys, base + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.keys, base + np.minimum(distance + radius, BITS), side="right")
            many = high - low
            queries = np.repeat(queries, many)
            offset = np.arange(len(queries)) - np.repeat(np.cumsum(many) - many, many)
            node = self.children[np.repeat(low, many) + offset]


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the components of each pair; labels are always least members."""
    while len(a):
        la, lb = label[a], label[b]
        open_pairs = la != lb
        if not open_pairs.any():
            return
        a, b = a[open_pairs], b[open_pairs]
        la, lb = la[open_pairs], lb[open_pairs]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def shard_links(shard: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(member, least member) of the components within each shard, for members other than the least."""
    order = np.lexsort((fps, shard))
    shard, fps = shard[order], fps[order]
    trees = ShardTrees(shard, fps.view(np.uint64))
    label = np.arange(len(fps))
    _, member, sizes = np.unique(shard, return_inverse=True, return_counts=True)
    reach = np.cumsum(sizes[member])  # a search meets its shard's members at most
    begin = 0
    while begin < len(fps):
        limit = (reach[begin - 1] if begin else 0) + FRONTIER
        end = max(int(np.searchsorted(reach, limit, side="right")), begin + 1)
        for a, b in trees.within(np.arange(begin, end), radius):
            _join(label, a, b)
        begin = end
    tied = np.flatnonzero(label != np.arange(len(fps)))
    return fps[tied], fps[label[tied]]


def links(nodes: DataFrame, radius: int = RADIUS, max_shard: int = MAX_SHARD) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints, a > b, whose components are those of all pairs within the radius."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def solved(frame: pd.DataFrame) -> pd.DataFrame:
            shard = pd.factorize(frame["shard"])[0].astype(np.int64)
            a, b = shard_links(shard, frame["fp"].to_numpy(np.int64, copy=True), radius)
            return pd.DataFrame({"a": a, "b": b}).drop_duplicates()

        held: list[pd.DataFrame] = []
        for batch in batches:
            if batch.empty:
                continue
            # rows come sorted by shard; the last shard of a batch may go on in the next
            last = batch["shard"].iloc[-1]
            tail = batch["shard"] == last
            if tail.all() and (not held or held[-1]["shard"].iloc[-1] == last):
                held.append(batch)
                continue
            yield solved(pd.concat([*held, batch[~tail]], ignore_index=True))
            held = [batch[tail]]
        if held:
            yield solved(pd.concat(held, ignore_index=True))

    shards = route(nodes, radius, max_shard).select(
        F.concat_ws("/", "shard.block", "shard.value", "shard.part", "shard.bits").alias("shard"), "fp"
    )
    dealt = shards.repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInPandas(run, "a long, b long").filter("a > b").distinct()


def near_duplicates(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    max_shard: int = MAX_SHARD,
    carry: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, fp, root, component_id) for every document, and the columns to carry.

    `component_id` is the least doc_id reachable over links, `root` the least fingerprint, which is never null.
    """
    scratch = Scratch(documents.sparkSession, "simhash")
    marked = scratch.keep(fingerprints(documents, doc_id, text, shingle, carry))
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = connected_components(links(nodes.select("fp"), radius, max_shard), scratch)
    # only linked fingerprints look for their component; a large one is a hot key, so both sides are salted
    tied = roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
    lowest = tied.join(nodes, tied.node == nodes.fp).groupBy("root").agg(F.min("low").alias("component_id"))
    listed = lowest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = tied.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    placed = salted.join(listed, ["root", "salt"]).select("node", "root", "component_id")
    rooted = nodes.join(placed, nodes.fp == placed.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "low").alias("component_id")
    )
    return marked.join(rooted, "fp")


def hex_fingerprint(fp):
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
