"""Conversation prefix trie over a minimal-perfect-hash node table (operator 13).

A node is a distinct sequence of first turns. Conversations are first rebuilt by
the caller's rule (:func:`rebuilt` has the one of op13), then:

1. Each turn gets two 64-bit hashes of its place and content; a prefix's digest is
   their running exclusive or along the conversation, so no text leaves
   the first step and none is gathered. Distinct digests are the nodes.
2. Nodes are put into levels by their members: level k has those with more than
   ``FANOUT**k`` and at most ``FANOUT**(k+1)``. The nodes of one level below the same topmost
   one are a unit; at any depth a unit has at most ``FANOUT`` nodes, however
   many conversations share a prefix. Units are dealt to shards by hash.
3. A shard enumerates its digests, builds a minimal perfect hash over them
   (a cascade of bit arrays), verifies every slot against the digest stored
   there, and scatters the counts into flat arrays. Parent slots come from the same
   hash, verified too; sums go up through them from the deepest nodes to the top.
4. The tops of a level's units are summed by parent and added where the parent
   lies, in a higher level, which is treated next. The number of levels is the
   logarithm of the conversations to the base ``FANOUT``.
5. The ids that end at a node are hashed as a stream in sorted order, so a node with any
   number of them needs no memory for them.

Two prefixes with the same digest would show as a node with two parents or two
last turns; then everything is done again with other hashes.

Edge cases: a null role or text is empty; rows of one turn number are taken by role,
then text; a null turn comes first; rows without a conv_id belong to no
conversation; repeated rows are turns of their own; an empty table has no
conversation, so no root either.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pageflow.llm.components import stored

FANOUT = 1000
SHARD_NODES = 100_000
MAX_HEAD = 5
NO_IDS = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame, seed: int = 0) -> DataFrame:
    """(conv_id, pos from 1, t1, t2, t3, chars): the turns in order, by three hashes of their content."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ("role", "text"))
    rows = (conversations.select(F.col("`conv_id`").cast("long").alias("conv_id"), F.col("`turn`").alias("turn"), role.alias("role"), text.alias("text"))
            .where("conv_id IS NOT NULL"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"),
                       *[F.xxhash64(F.lit(3 * seed + k), "role", "text").alias(f"t{k}") for k in (1, 2, 3)],
                       F.length("text").cast("long").alias("chars"))


def rebuilt(own: DataFrame) -> DataFrame:
    """op13's rule: the first h turns of conversation c - c % 100, then c's own after its first h; h = crc32(c) % 6.

    A row with pos 0 stands for the conversation itself. A conversation gives its
    first turns to the ids of its hundred only, so the join can't grow a hot key.
    """
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    named = own.where("pos = 1").select("conv_id", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % 100).alias("base"))
    first = own.where(f"conv_id % 100 = 0 AND pos <= {MAX_HEAD}").withColumnRenamed("conv_id", "base")
    columns = ["conv_id", "pos", "t1", "t2", "t3", "chars"]
    heads = named.join(first, "base").where("pos <= h").select(*columns)
    tails = own.where(F.col("pos") > head).select(*columns)
    zero = F.lit(0).cast("long")
    roots = named.select("conv_id", *[zero.alias(c) for c in columns[1:]])
    return heads.unionByName(tails).unionByName(roots)


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, d1, d2, p1, p2, t3, chars, ends): each conversation's prefixes with their digests and parents'."""
    order = Window.partitionBy("conv_id").orderBy("pos")
    deep = rows.withColumn("depth", F.row_number().over(order).cast("long") - 1)
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for k in (1, 2):
        placed = F.when(F.col("depth") > 0, F.xxhash64("depth", f"t{k}")).otherwise(F.lit(0).cast("long"))
        deep = deep.withColumn(f"d{k}", F.bit_xor(placed).over(running))
    return deep.select("conv_id", "depth", "d1", "d2", *[F.lag(f"d{k}").over(order).alias(f"p{k}") for k in (1, 2)], "t3", "chars",
                       F.lead("pos").over(order).isNull().alias("ends"))


def nodes(paths: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """One row a distinct prefix: smallest member, members, parent's digest, last text's length, level, unit.

    ``clash`` is true where two different prefixes share the digest.
    """
    crowded = stored(paths.groupBy("d1", "d2").agg(F.count("*").alias("n")).where(F.col("n") > fanout), "trie-crowded")
    most = crowded.agg(F.max("n")).first()[0] or 1
    level, k = F.lit(0), 1
    while fanout ** k < most:
        level, k = level + F.when(F.coalesce("n", F.lit(0)) > fanout ** k, 1).otherwise(0), k + 1
    # one row in ``fanout`` at most is in ``crowded``; Spark broadcasts it while it measures small, else splits hot keys
    placed = paths.join(crowded, ["d1", "d2"], "left").withColumn("level", level)
    top = Window.partitionBy("conv_id", "level").orderBy("depth")
    placed = placed.withColumn("unit", F.first(F.xxhash64("d1", "d2")).over(top))
    same = [F.min(c).eqNullSafe(F.max(c)) for c in ("depth", "p1", "p2", "t3")]
    return placed.groupBy("d1", "d2").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.count("*").alias("n_convs"), F.min("p1").alias("p1"),
        F.min("p2").alias("p2"), F.min("chars").alias("chars"), F.min("level").alias("level"), F.min("unit").alias("unit"),
        (~(same[0] & same[1] & same[2] & same[3])).alias("clash"))


def _mixed(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    h = (a ^ np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(31)) ^ b) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


class NodeTable:
    """Minimal perfect hash of distinct digests: slot of each of n keys in 0..n-1, none twice.

    Each step has twice as many places as keys left; a key alone in its place
    stays there, the others go on to the next step. A slot is the rank of a taken
    place. The digests are kept by slot, so a key that isn't in the table is told.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.steps: list[tuple[np.ndarray, np.ndarray]] = []
        left, taken = np.arange(len(a)), 0
        while len(left):
            if len(self.steps) > 200:
                raise ValueError("a digest stands in the shard twice")
            place = (_mixed(a[left], b[left], len(self.steps)) % np.uint64(2 * len(left))).astype(np.int64)
            alone = np.bincount(place, minlength=2 * len(left)) == 1
            self.steps.append((alone, taken + np.cumsum(alone) - 1))
            taken += int(alone.sum())
            left = left[~alone[place]]
        self.keys = np.zeros(len(a), np.uint64), np.zeros(len(a), np.uint64)
        slot = self._slot(a, b)
        self.keys[0][slot], self.keys[1][slot] = a, b
        if not ((self.keys[0][slot] == a) & (self.keys[1][slot] == b)).all():
            raise ValueError("two digests share a slot")

    def _slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out, left = np.zeros(len(a), np.int64), np.arange(len(a))
        for k, (alone, rank) in enumerate(self.steps):
            place = (_mixed(a[left], b[left], k) % np.uint64(len(alone))).astype(np.int64)
            hit = alone[place]
            out[left[hit]] = rank[place[hit]]
            left = left[~hit]
        return out

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slots of the keys; -1 for those that are not in the table."""
        slot = self._slot(a, b)
        return np.where((self.keys[0][slot] == a) & (self.keys[1][slot] == b), slot, -1)


def accumulate(part: pa.Table) -> pa.Table:
    """Children, leaves and saved code points of a shard's nodes; what came up from lower levels is in the ``add_`` columns."""
    def column(name, kind=np.int64):
        return part.column(name).combine_chunks().fill_null(0).to_numpy(zero_copy_only=False).astype(kind)

    d1, d2, p1, p2 = (column(c).view(np.uint64) for c in ("d1", "d2", "p1", "p2"))
    table = NodeTable(d1, d2)
    slot = table.find(d1, d2)

    def flat(values):
        out = np.zeros(len(slot), np.int64)
        out[slot] = values
        return out

    depth, conv = flat(column("depth")), flat(column("conv_id"))
    parent = flat(np.where(column("depth") > 0, table.find(p1, p2), -1))
    inside = parent >= 0
    children = flat(column("add_children")) + np.bincount(parent[inside], minlength=len(slot))
    leaves = flat(column("add_leaves")) + (children == 0)
    saved = flat(column("add_saved")) + flat((column("n_convs") - 1) * column("chars"))
    order = np.argsort(-depth, kind="stable")
    for run in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        up = run[inside[run]]
        np.add.at(leaves, parent[up], leaves[up])
        np.add.at(saved, parent[up], saved[up])
    made = {"n_children": children, "n_leaves": leaves, "saved_tokens": saved}
    out = {c: part.column(c) for c in ("d1", "d2", "p1", "p2", "conv_id", "depth", "n_convs")}
    out |= {"parent_conv_id": pa.array(conv[parent[slot]], pa.int64(), mask=~inside[slot]), "top": pa.array(~inside[slot])}
    return pa.table(out | {k: pa.array(v[slot]) for k, v in made.items()})


DONE = ("d1 long, d2 long, p1 long, p2 long, conv_id long, depth long, n_convs long, parent_conv_id long, top boolean, "
        "n_children long, n_leaves long, saved_tokens long")


def _ends(paths: DataFrame) -> DataFrame:
    """(d1, d2, ends_sha256) of the nodes at which conversations end; ids are read in order, never gathered."""

    def run(batches):
        last, digest = None, None
        for b in batches:
            done = []
            a1, a2, ids = (b.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            starts = np.flatnonzero(np.concatenate([[True], (np.diff(a1) != 0) | (np.diff(a2) != 0)])) if len(a1) else []
            for s, e in zip(starts, [*starts[1:], len(a1)]):
                key, text = (int(a1[s]), int(a2[s])), ",".join(map(str, ids[s:e].tolist()))
                if key == last:
                    digest.update(f",{text}".encode())
                else:
                    if last:
                        done.append((*last, digest.hexdigest()))
                    last, digest = key, hashlib.sha256(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], ["d1", "d2", "ends_sha256"])
        if last:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*last, digest.hexdigest())], ["d1", "d2", "ends_sha256"])

    return (paths.where("ends").select("d1", "d2", "conv_id").repartition("d1", "d2").sortWithinPartitions("d1", "d2", "conv_id")
            .mapInArrow(run, "d1 long, d2 long, ends_sha256 string"))


def trie(conversations: DataFrame, rebuild=rebuilt, fanout: int = FANOUT, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    seed = 0
    while True:
        paths = stored(prefixes(rebuild(turns(conversations, seed))), "trie-paths")
        table = stored(nodes(paths, fanout), "trie-nodes")
        counts = {r["level"]: (r["n"], r["clashes"]) for r in table.groupBy("level").agg(
            F.count("*").alias("n"), F.count_if("clash").alias("clashes")).collect()}  # a row a level
        if not any(c for _, c in counts.values()):
            break
        seed += 1
    done: list[DataFrame] = []
    sums = ("children", "leaves", "saved")
    for level in sorted(counts):
        part = table.where(F.col("level") == level)
        if done:
            tops = [x.where("top AND depth > 0").select(F.col("p1").alias("d1"), F.col("p2").alias("d2"), "n_leaves", "saved_tokens") for x in done]
            below = tops[0]
            for x in tops[1:]:
                below = below.unionByName(x)
            below = below.groupBy("d1", "d2").agg(F.count("*").alias("add_children"), F.sum("n_leaves").alias("add_leaves"),
                                                  F.sum("saved_tokens").alias("add_saved"))
            part = part.join(below, ["d1", "d2"], "left")
        else:
            part = part.withColumns({f"add_{c}": F.lit(0).cast("long") for c in sums})
        shards = counts[level][0] // shard_nodes + 1
        made = part.drop("clash", "level").withColumn("shard", F.pmod("unit", F.lit(shards))).groupBy("shard").applyInArrow(accumulate, DONE)
        done.append(stored(made, "trie-level"))
    if not done:
        return conversations.sparkSession.createDataFrame(
            [], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    rows = done[0]
    for x in done[1:]:
        rows = rows.unionByName(x)
    # a unit's top has its parent in a higher level, among the crowded nodes
    above = table.where("level > 0").select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("above"))
    rows = rows.join(above, ["p1", "p2"], "left").join(_ends(paths), ["d1", "d2"], "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "above"))
    return rows.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
                       F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"))
