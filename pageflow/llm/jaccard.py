"""N-gram Jaccard join with a token-group matrix (operator 2).

Two documents link when the Jaccard similarity of their 5-word shingle sets is
0.75 or more. The join is exact on 64-bit shingle hashes and works on classes,
the distinct sets, so copies are handled once.

1. Census: each text's set gives its class digest and size; a sketch of fixed
   size counts shingles over the corpus.
2. Prefixes: in any order of the shingles that all documents share, linked sets
   have one in common among their first quarter. The order puts shingles that
   the sketch says are rare first. Prefix tokens travel in packed arrays by
   hash range; those of one class only are dropped there. Very frequent tokens
   skip that step, so no range gathers them.
3. Groups: many classes that share much of their prefix with the same class
   form a group, cut into blocks of bounded size; the others are blocks of their
   own. Blocks that share a prefix token are candidates; for two single classes,
   their shared count and the tokens left after the last shared one must still
   allow a link.
4. Matrix: the sets of candidate blocks are read once more. Each block keeps the
   union of its tokens; a set of one block is opened against the other only if
   enough of its tokens lie in that union. Overlaps of what is opened come from
   a product of token matrices, and only a spanning forest of the links leaves
   the task, never all pairs of a group.
5. Components of the links; every document gets the smallest id it reaches.

Edge cases: null, empty and wordless texts have an empty set and link with
nothing; texts of fewer than five words have one shingle; repeated rows fall
into one class; a null id is never a component's id unless it has no other.
Two sets with equal class digests are told apart by a second digest; if that
ever happens the census is taken again with other random numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from pageflow.llm.components import components, stored
from pageflow.llm.scan import map_texts
from pageflow.llm.shingles import shingle_sets

SKETCH_BITS = 21
BLOCK_BITS = 14
HOT = 2000                # tokens counted this often over the usual noise are not gathered by range
RANGE_TOKENS = 500_000
BUFFER_TOKENS = 500_000
SLICE = 1 << 20
BLOCK_SETS, BLOCK_TOKENS = 512, 1 << 18
GROUP_SHARE, GROUP_SETS = 0.4, 16
CROWD = 100               # classes that a token may meet as single ones
BITMAP_BITS = 27
COLUMNS = 4096


def least_overlap(a, b):
    """Smallest intersection of sets of sizes a and b that links them: 100 i >= 75 (a + b - i)."""
    return -((-3 * (a + b)) // 7)


def prefix_length(n):
    """Linked sets share at least 3/4 of either, so one of so many tokens in any common order."""
    return n + (-3 * n) // 4 + 1


def _digests(s: np.ndarray) -> tuple[int, int]:
    a = np.frombuffer(xxh3_128_digest(s.tobytes()), np.int64)
    return int(a[0]), int(a[1])


class _Seen:
    """Classes a task has had; forgets when full, which only costs repeated work."""

    def __init__(self, size: int = 100_000):
        self.size, self.ids = size, set()

    def first(self, key: int) -> bool:
        if key in self.ids:
            return False
        if len(self.ids) >= self.size:
            self.ids.clear()
        self.ids.add(key)
        return True


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)


def census(docs: DataFrame, id_col: str, text_col: str, seed: int) -> DataFrame:
    """Rows of two kinds: documents (id, class, second digest, n) and packed parts of the sketch (block, counts)."""
    schema = "doc_id long, class long, second long, n long, block int, counts binary"
    names = ["doc_id", "class", "second", "n", "block", "counts"]

    def run(batches):
        seen, sketch, waiting, held = _Seen(), np.zeros(1 << SKETCH_BITS, np.int64), [], 0
        for b in batches:
            classes, seconds, sizes = [], [], []
            for s in shingle_sets(b.column("text"), seed):
                sizes.append(len(s))
                if not len(s):
                    classes.append(None)
                    seconds.append(None)
                    continue
                a, c = _digests(s)
                classes.append(a)
                seconds.append(c)
                if seen.first(a):
                    waiting.append(_slots(s))
                    held += len(s)
            if held > BUFFER_TOKENS:
                sketch += np.bincount(np.concatenate(waiting), minlength=len(sketch))
                waiting, held = [], 0
            n = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(classes, pa.int64()), pa.array(seconds, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        if waiting:
            sketch += np.bincount(np.concatenate(waiting), minlength=len(sketch))
        parts = np.minimum(sketch, (1 << 32) - 1).astype(np.uint32).reshape(-1, 1 << BLOCK_BITS)
        for k in np.flatnonzero(parts.any(axis=1)).tolist():
            none = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array([k], pa.int32()),
                                              pa.array([zlib.compress(parts[k].tobytes(), 1)], pa.binary())], names)

    return map_texts(docs, {"doc_id": F.col(f"`{id_col}`").cast("long"), "text": text_col}, schema, run, size=SLICE)


def _sketch(parts: DataFrame) -> np.ndarray:
    """The summed sketch: 2**(SKETCH_BITS - BLOCK_BITS) rows of fixed size come to the driver."""

    def add(batches: Iterator[pa.RecordBatch]):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column("block").to_pylist(), b.column("counts").to_pylist()):
                counts = np.frombuffer(zlib.decompress(c), np.uint32).astype(np.int64)
                total[k] = total[k] + counts if k in total else counts
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                              pa.array([v.tobytes() for v in total.values()], pa.binary())], ["block", "counts"])

    summed = parts.repartition("block").mapInArrow(add, "block int, counts binary").collect()
    out = np.zeros((1 << (SKETCH_BITS - BLOCK_BITS), 1 << BLOCK_BITS), np.int64)
    for r in summed:
        out[r["block"]] += np.frombuffer(r["counts"], np.int64)
    return out.ravel()


def _levels(sketch: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank of each sketch slot in the common order (rare first), and the rank from which tokens are hot."""
    usual = float(np.median(sketch))

    def rank(count):
        return np.clip(2 * np.log2(1 + np.maximum(0, count - usual) / max(1.0, usual) ** 0.5), 0, 62)

    return rank(sketch).astype(np.uint8), int(rank(np.float64(usual + HOT)))


def shared_tokens(docs: DataFrame, text_col: str, seed: int, levels: np.ndarray, hot: int, ranges: int) -> DataFrame:
    """(token, class, rest, lead, crowded) for the prefix tokens that more than one class has.

    rest: tokens of the set after this one; lead: the smallest class that the token's range has met with it;
    crowded: whether more than ``CROWD`` classes have the token.
    """
    sent = docs.sparkSession.sparkContext.broadcast(levels)  # 2**SKETCH_BITS bytes
    names = ["range", "tokens", "rests", "classes", "runs"]

    def packed(waiting) -> Iterator[pa.RecordBatch]:
        if not waiting:
            return
        token, cls, rest, level = (np.concatenate(x) for x in zip(*waiting))
        at = ((token >> np.uint64(40)).astype(np.int64) * ranges) >> 24
        # the same task's hot tokens go to one range of their own: they are only made distinct there
        at = np.where(level >= hot, ranges + TaskContext.get().partitionId() % ranges, at)
        order = np.argsort(at, kind="stable")
        at, token, cls, rest = at[order], token[order], cls[order], rest[order]
        rows = []
        for start, end in zip(cuts := [0, *(np.flatnonzero(np.diff(at)) + 1).tolist()], [*cuts[1:], len(at)]):
            own = cls[start:end]  # a class's tokens of a range lie together
            runs = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(own)]])
            rows.append((int(at[start]), token[start:end].tobytes(), rest[start:end].tobytes(),
                         own[runs[:-1]].tobytes(), np.diff(runs).astype(np.int32).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(
            zip(*rows), (pa.int32(), *[pa.binary()] * 4))], names)

    def pack(batches):
        levels, seen, waiting, held = sent.value, _Seen(), [], 0
        for b in batches:
            for s in shingle_sets(b.column("text"), seed):
                n = len(s)
                if not n:
                    continue
                cls = _digests(s)[0]
                if not seen.first(cls):
                    continue
                level = levels[_slots(s)]
                p = prefix_length(n)
                order = np.argsort((level.astype(np.uint64) << np.uint64(58)) | (s >> np.uint64(6)), kind="stable")[:p]
                waiting.append((s[order], np.full(p, cls, np.int64), np.arange(n - 1, n - 1 - p, -1, dtype=np.int32), level[order]))
                held += p
            if held > BUFFER_TOKENS:
                yield from packed(waiting)
                waiting, held = [], 0
        yield from packed(waiting)

    def shared(table: pa.Table) -> pa.Table:
        token, rest, cls, runs = (np.concatenate([np.frombuffer(x, kind) for x in table.column(c).to_pylist()])
                                  for c, kind in zip(names[1:], (np.int64, np.int32, np.int64, np.int32)))
        cls = np.repeat(cls, runs)
        order = np.lexsort((cls, token))
        token, cls, rest = token[order], cls[order], rest[order]
        same = np.concatenate([[False], token[1:] == token[:-1]])
        again = same & np.concatenate([[False], cls[1:] == cls[:-1]])  # a class that several tasks had
        token, cls, rest, same = token[~again], cls[~again], rest[~again], same[~again]
        if table.column("range")[0].as_py() < ranges:
            use = same | np.concatenate([same[1:], [False]])
            token, cls, rest = token[use], cls[use], rest[use]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, int)
        holders = np.diff(np.append(first, len(token)))
        lead, crowded = np.repeat(cls[first], holders), np.repeat(holders > CROWD, holders)
        if table.column("range")[0].as_py() >= ranges:
            crowded[:] = True
        return pa.table({"token": token, "class": cls, "rest": rest, "lead": lead, "crowded": crowded})

    tokens = map_texts(docs, {"text": text_col}, ", ".join(["range int", *[f"{c} binary" for c in names[1:]]]), pack, size=SLICE)
    return tokens.groupBy("range").applyInArrow(shared, "token long, class long, rest int, lead long, crowded boolean")


def blocks(tokens: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, block, n, single) of every class in ``tokens``: groups of similar classes, cut into blocks.

    A class joins the group of the lead with which it shares the most prefix
    tokens, if they are at least ``GROUP_SHARE`` of its prefix. Groups of fewer than ``GROUP_SETS`` fall
    apart again: their few pairs are bounded more sharply one by one. That holds
    only for classes whose tokens few others have; one with a crowded token always joins the
    lead with which it shares the most, and stays, so that no token meets
    many single classes.
    """
    votes = tokens.groupBy("class", "lead").agg(F.count("*").alias("votes"), F.max("crowded").alias("crowded"))
    best = (votes.groupBy("class").agg(F.max("crowded").alias("crowded"), F.max(F.when(
        F.col("class") != F.col("lead"), F.struct("votes", "lead"))).alias("b")).select("class", "crowded", "b.votes", "b.lead"))
    active = best.join(classes.select("class", "n"), "class")
    grouped = active.select("class", "n", "crowded", F.when(
        (F.col("votes") >= GROUP_SHARE * (F.col("n") / 4)) | (F.col("crowded") & F.col("lead").isNotNull()), F.col("lead"))
        .otherwise(F.col("class")).alias("group"))
    sizes = grouped.groupBy("group").agg(F.count("*").alias("sets"), F.sum("n").alias("total"))
    parts = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("total") / BLOCK_TOKENS))
    return (grouped.join(sizes.select("group", parts.alias("parts"), (F.col("sets") < GROUP_SETS).alias("small")), "group")
            .withColumn("single", F.col("small") & ~F.col("crowded"))
            .select("class", "n", "single", F.when(F.col("single"), F.col("class")).otherwise(
                F.xxhash64("group", F.pmod(F.xxhash64("class"), "parts"))).alias("block")))


def candidates(tokens: DataFrame, placed: DataFrame) -> DataFrame:
    """(a, b) blocks between or (a = b) within which a link is possible, each pair once, and which are single classes.

    If only one is single, it is ``a``.
    """
    by_block = (tokens.drop("lead", "crowded").join(placed, "class").groupBy("token", "block")
                .agg(F.max("rest").alias("rest"), F.max("n").alias("n"), F.min("single").alias("single")))
    left = by_block.select("token", *[F.col(c).alias(f"a_{c}") for c in ("block", "rest", "n", "single")])
    right = by_block.select("token", *[F.col(c).alias(f"b_{c}") for c in ("block", "rest", "n", "single")])
    pairs = (left.join(right, "token").where("a_block < b_block")
             .where("NOT (a_single AND b_single) OR 4 * least(a_n, b_n) >= 3 * greatest(a_n, b_n)")
             .groupBy(F.col("a_block").alias("a"), F.col("b_block").alias("b"))
             .agg(F.count("*").alias("s"), F.min(F.least("a_rest", "b_rest")).alias("rest"), F.min("a_n").alias("a_n"),
                  F.min("b_n").alias("b_n"), F.min("a_single").alias("a_single"), F.min("b_single").alias("b_single"),
                  F.min(F.col("a_single") & F.col("b_single")).alias("single")))
    # the sets of ``a`` travel to those of ``b``: a single one, if there is one
    a, b = (F.when(F.col("a_single"), F.col(x)).otherwise(F.col(y)) for x, y in (("a", "b"), ("b", "a")))
    # the shared tokens are ``s`` and, at most, those behind the last shared one, or behind the prefix that ends first
    behind = F.least("rest", F.expr("(3 * greatest(a_n, b_n) + 3) div 4 - 1"))
    possible = pairs.where(~F.col("single") | (7 * (F.col("s") + behind) >= 3 * (F.col("a_n") + F.col("b_n"))))
    possible = possible.select(a.alias("a"), b.alias("b"), F.expr("a_single OR b_single").alias("a_single"), F.col("single").alias("b_single"))
    no = F.lit(False)
    within = placed.where("NOT single").select(F.col("block").alias("a"), F.col("block").alias("b"), no.alias("a_single"),
                                               no.alias("b_single")).distinct()
    return possible.union(within)


def hash_bitmap(rows: DataFrame, column: str) -> np.ndarray:
    """One bit for each hash in ``column``, in a bitmap of fixed size (2**BITMAP_BITS bits)."""
    place = F.pmod(column, F.lit(1 << BITMAP_BITS)) + 1
    found = (rows.select(F.bitmap_bucket_number(place).alias("k"), F.bitmap_bit_position(place).alias("at"))
             .groupBy("k").agg(F.bitmap_construct_agg("at").alias("bits")).collect())
    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for r in found:
        start = (r["k"] - 1) * 4096
        out[start:start + 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def sets_of(docs: DataFrame, text_col: str, seed: int, classes: DataFrame) -> DataFrame:
    """(class, tokens) of the sets whose class may be in ``classes`` (a few others slip through the bitmap)."""
    sent = docs.sparkSession.sparkContext.broadcast(hash_bitmap(classes, "class"))

    def run(batches):
        bits, seen = sent.value, _Seen()
        for b in batches:
            ids, sets = [], []
            for s in shingle_sets(b.column("text"), seed):
                if not len(s):
                    continue
                cls = _digests(s)[0]
                at = cls % (1 << BITMAP_BITS)
                if bits[at >> 3] >> (at & 7) & 1 and seen.first(cls):
                    ids.append(cls)
                    sets.append(s.tobytes())
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], ["class", "tokens"])

    return map_texts(docs, {"text": text_col}, "class long, tokens binary", run, size=SLICE)


def _forest(linked: np.ndarray, left: list[int], right: list[int]) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the bipartite links between ``left`` and ``right``."""
    free_l, free_r = np.ones(len(left), bool), np.ones(len(right), bool)
    out = []
    for root in np.flatnonzero(linked.any(axis=1)).tolist():
        if not free_l[root]:
            continue
        free_l[root] = False
        todo = [root]
        while todo:
            i = todo.pop()
            for j in np.flatnonzero(linked[i] & free_r).tolist():
                free_r[j] = False
                out.append((left[i], right[j]))
                for k in np.flatnonzero(linked[:, j] & free_l).tolist():
                    free_l[k] = False
                    out.append((left[k], right[j]))
                    todo.append(k)
    return out


class Block:
    """Sets of similar documents with the union of their tokens."""

    def __init__(self, members):
        self.classes = [m["class"] for m in members]
        self.sets = [np.frombuffer(m["tokens"], np.uint64) for m in members]
        self.sizes = np.array([len(s) for s in self.sets])
        self.union = np.unique(np.concatenate(self.sets)) if len(self.sets) > 1 else self.sets[0]
        self._parts: np.ndarray | None = None

    def parts(self) -> np.ndarray:
        """For each set, the number of the part of the block that links inside it connect (found once)."""
        if self._parts is None:
            place = {c: k for k, c in enumerate(self.classes)}
            parts = np.arange(len(self.sets))
            if len(self.sets) > 1:
                for u, v in block_links(self, self):
                    parts[parts == parts[place[v]]] = parts[place[u]]
            self._parts = parts
        return self._parts

    def common(self) -> np.ndarray:
        """Tokens that two sets at least have; no others can be in an overlap."""
        if len(self.sets) < 2:
            return self.union
        token, times = np.unique(np.concatenate(self.sets), return_counts=True)
        return token[times > 1]

    def bounds(self, other: Block) -> np.ndarray:
        """For each set, how many of its tokens the other block's union has."""
        tokens = np.concatenate(self.sets)
        at = np.minimum(np.searchsorted(other.union, tokens), len(other.union) - 1)
        starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        return np.add.reduceat((other.union[at] == tokens).astype(np.int64), starts)


def block_links(a: Block, b: Block) -> list[tuple[int, int]]:
    """A spanning forest of the links between two blocks, or inside one."""
    opened = [np.flatnonzero(4 * x.bounds(y) >= 3 * x.sizes) for x, y in ((a, b), (b, a))]
    if not all(map(len, opened)):
        return []
    shared = a.common() if a is b else np.intersect1d(a.union, b.union, assume_unique=True)
    overlap = np.zeros((len(opened[0]), len(opened[1])), np.float32)
    for start in range(0, len(shared), COLUMNS):
        part = shared[start:start + COLUMNS]
        sides: list[np.ndarray] = []
        for block, use in zip((a, b), opened):
            matrix = np.zeros((len(use), len(part)), np.float32)
            for row, k in enumerate(use.tolist()):
                s = block.sets[k]
                s = s[np.searchsorted(s, part[0]):np.searchsorted(s, part[-1], side="right")]
                at = np.searchsorted(part, s)
                matrix[row, at[part[at] == s]] = 1
            sides.append(matrix)
        overlap += sides[0] @ sides[1].T
    total = a.sizes[opened[0]][:, None] + b.sizes[opened[1]][None, :]
    linked = 7 * overlap.astype(np.int64) >= 3 * total
    if a is b:
        return _forest(linked, [a.classes[k] for k in opened[0]], [b.classes[k] for k in opened[1]])
    # what is connected inside a block counts as one: an edge between two such parts is enough
    at = np.argwhere(linked)
    parts = [x.parts()[use[at[:, side]]] for side, (x, use) in enumerate(zip((a, b), opened))]
    _, first = np.unique(parts[0] * (len(b.sets) + 1) + parts[1], return_index=True)
    return [(a.classes[opened[0][i]], b.classes[opened[1][j]]) for i, j in at[first].tolist()]


def links(docs: DataFrame, text_col: str, seed: int, pairs: DataFrame, placed: DataFrame) -> DataFrame:
    """(u, v): edges that connect exactly the classes which links connect.

    Single classes are their own blocks: their sets are shuffled once, by class,
    and travel once more to the other side of a pair. Only the sets of large
    groups are gathered into blocks.
    """
    used = placed.join(pairs.select(F.explode(F.array("a", "b")).alias("block")).distinct(), "block", "left_semi")
    one = (sets_of(docs, text_col, seed, used.where("single")).groupBy("class").agg(F.first("tokens").alias("tokens"))
           .select(F.col("class").alias("block"), F.array(F.struct("class", "tokens")).alias("members")))
    groups = used.where("NOT single").select("class", "block")
    many = (sets_of(docs, text_col, seed, groups).join(groups, "class").dropDuplicates(["class"])
            .groupBy("block").agg(F.collect_list(F.struct("class", "tokens")).alias("members")))

    def side(rows: DataFrame, at: str, sets: DataFrame, name: str) -> DataFrame:
        return rows.join(sets.select(F.col("block").alias(at), F.col("members").alias(name)), at)

    singles = side(pairs.where("a_single"), "a", one, "left")
    kinds = [side(singles.where("b_single"), "b", one, "right")]
    if not groups.isEmpty():
        kinds += [side(singles.where("NOT b_single"), "b", many, "right"),
                  side(side(pairs.where("NOT a_single"), "a", many, "left"), "b", many, "right")]
    rows = reduce(DataFrame.unionByName, [k.select("a", "b", "left", "right") for k in kinds])

    def run(batches):
        last: dict[str, tuple[int, Block]] = {}  # rows come sorted by their right side, and often repeat it

        def block(name: str, key: int, column) -> Block:
            if name not in last or last[name][0] != key:
                last[name] = key, Block(column.as_py())
            return last[name][1]

        for batch in batches:
            keys = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())
            for k, (a, b) in enumerate(keys):
                right = block("right", b, batch.column("right")[k])
                left = right if a == b else block("left", a, batch.column("left")[k])
                found = [(u, v) for u, v in block_links(left, right) if u != v]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["u", "v"])

    return rows.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_shingles, component_id and class (equal for equal sets, null for empty ones)."""
    seed = 0
    while True:
        counted = stored(census(docs, id_col, text_col, seed), "jaccard-census")
        own = counted.where("block IS NULL").select("doc_id", "class", "second", "n")
        classes = own.where("class IS NOT NULL").groupBy("class").agg(
            F.min("doc_id").alias("least"), F.min("n").alias("n"), F.min("second").alias("s1"), F.max("second").alias("s2"))
        state = classes.agg(F.count("*").alias("classes"), F.sum("n").alias("tokens"),
                            F.coalesce(F.sum((F.col("s1") != F.col("s2")).cast("long")), F.lit(0)).alias("clashes")).first()
        if not state["clashes"]:
            break
        seed += 1
    own = own.select("doc_id", "class", F.col("n").alias("n_shingles"))
    if not state["classes"]:
        return own.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "class")
    levels, hot = _levels(_sketch(counted.where("block IS NOT NULL").select("block", "counts")))
    ranges = max(16, int(state["tokens"] * 0.27 / RANGE_TOKENS) + 1)
    tokens = stored(shared_tokens(docs, text_col, seed, levels, hot, ranges), "jaccard-tokens")
    placed = stored(blocks(tokens, classes), "jaccard-placed")
    pairs = stored(candidates(tokens, placed), "jaccard-pairs")
    tied = components(links(docs, text_col, seed, pairs, placed))
    named = (classes.join(tied, classes["class"] == tied["node"], "left")
             .select("class", "least", F.coalesce("component", "class").alias("component")))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = named.join(ids, "component").select("class", "component_id")
    return (own.join(by_class, "class", "left")
            .select("doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id"), "class"))
