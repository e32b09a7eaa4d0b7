"""Source divergence audit by row accumulation (operator 11).

Groups are (lang, source); their terms are runs of letters and of characters
beyond ASCII. A term that at least ``MIN_DOCS`` documents of a language hold
is kept there. Each group gives a term the share
p = 1 + floor(SCALE * (count + 2) / (N + 2 * V)), and the distance of two groups is
the sum over all V kept terms of f(p, q) = floor((p - q)**2 / (p + q)).

1. Occurrences are counted by (lang, source, term), combined before the shuffle, and
   gathered into a term-major index: a kept term with its postings (source, count),
   one a group at most.
2. The index is cut by term into slices of bounded size. In a slice each group
   scatters its terms through the index into a dense accumulator with a cell
   for each peer (Gustavson's row product), so postings are never paired up
   as rows. A group's cell starts with f of both zero baselines, the shares that
   a term without an occurrence has, for every term; then come the corrections
   for terms that only the group has, that only the peer has, and that both have.
3. Cells are summed over slices, partly before the shuffle. The largest terms of
   a group are cut to ``TOP`` in each slice, then over all.

All arithmetic is on whole numbers. Rows returned grow with the square of a
language's sources, as the pairs asked for do; a slice holds one row of cells at a time.

Edge cases: null text, lang and source count as ''; documents are rows, so repeated
rows count each; a group without terms has only zero baselines; a language
without kept terms gives its pairs the value 0; a language of one source has no
pairs; ties are ranked by the item's UTF-8 bytes; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pageflow.llm.components import stored
from pageflow.llm.scan import map_texts

#: Of a byte: A-Z as a-z; what stands between terms becomes a space.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
MIN_DOCS, TOP = 10, 10
SCALE = 1_000_000_000
SLICE_POSTINGS = 200_000
HELD, SENT = 300_000, 50_000
#: Languages whose numbers are broadcast at most (some 50 bytes each); more are joined.
BROADCAST_LANGS = 10_000
CELLS = 1 << 20


def occurrences(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): how often a term occurs and in how many documents, summed over parts of a task.

    In UTF-8 every byte of a character beyond ASCII is beyond ASCII, so terms are cut
    from the bytes; a task sends its counts when it holds ``HELD`` of them.
    """
    def packed(held):
        cells = [(*group, t, n, own[1][t]) for group, own in held.items() for t, n in own[0].items()]
        for k in range(0, len(cells), SENT):
            lang, source, term, n, d = zip(*cells[k:k + SENT])
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()).cast(pa.string()),
                 pa.array(n, pa.int64()), pa.array(d, pa.int64())], ["lang", "source", "term", "n", "docs"])

    def run(batches):
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for b in batches:
            groups = zip(b.column("lang").to_pylist(), b.column("source").to_pylist())
            for group, text in zip(groups, b.column("text").cast(pa.binary())):
                words = text.as_py().translate(LETTERS).split()
                if words:
                    n, d = held.setdefault(group, (Counter(), Counter()))
                    n.update(words)
                    d.update(set(words))
            if sum(len(n) for n, _ in held.values()) > HELD:
                yield from packed(held)
                held = {}
        yield from packed(held)

    return map_texts(docs, {"lang": "lang", "source": "source", "text": "text"},
                     "lang string, source string, term string, n long, docs long", run)


def term_index(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, postings): each kept term with the sources that use it and how often."""
    counts = occurrences(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return (counts.groupBy("lang", "term")
            .agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("postings"))
            .where(F.col("docs") >= min_docs).drop("docs"))


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / total), exactly."""
    if not len(count) or count.max() < (1 << 63) // SCALE - 2:
        return 1 + SCALE * (count + 2) // total
    return np.array([1 + SCALE * (a + 2) // b for a, b in zip(count.tolist(), np.broadcast_to(total, count.shape).tolist())], np.int64)


def distance(p, q):
    """floor((p - q)**2 / (p + q)); shares are at most SCALE + 1, so a square fits."""
    return (p - q) * (p - q) // (p + q)


class Slice:
    """Some terms of one language: the term-major index and its transpose, over all peers."""

    def __init__(self, index: pa.Table, peers: pa.Table):
        self.sources = sorted(peers.column("source").to_pylist())
        rows = {s: (n, v) for s, n, v in zip(*(peers.column(c).to_pylist() for c in ("source", "n", "terms")))}
        count = np.array([rows[s][0] for s in self.sources], np.int64)
        kept = rows[self.sources[0]][1]
        self.terms = index.column("term").to_pylist()
        place = {s: k for k, s in enumerate(self.sources)}
        postings = index.column("postings").combine_chunks()
        flat = postings.flatten()
        self.peer = np.array([place[s] for s in flat.field("source").to_pylist()], np.int64)
        n = flat.field("n").to_numpy(zero_copy_only=False).astype(np.int64)
        self.ends = np.concatenate([[0], np.cumsum(postings.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))])
        self.term = np.repeat(np.arange(len(self.terms)), np.diff(self.ends))
        if not kept:
            self.base, self.share, self.whole = np.ones(len(count), np.int64), n, n
            return
        total = count + 2 * kept
        self.base = shares(np.zeros(len(count), np.int64), total)
        self.share = shares(n, total[self.peer])
        sums = np.add.reduceat(n, self.ends[:-1]) if len(n) else n
        self.whole = shares(sums, np.int64(count.sum() + 2 * kept))  # the language's own share of each term

    def rows(self):
        """(number of the group, its cells for all peers, its terms and shares) one group after the other."""
        by_group = np.argsort(self.peer, kind="stable")
        starts = np.searchsorted(self.peer[by_group], np.arange(len(self.sources) + 1))
        # what a peer has, as (peer, share, times): terms of equal counts weigh alike against a baseline
        runs = np.lexsort((self.share, self.peer))
        new = np.flatnonzero(np.diff(self.peer[runs], prepend=-1) | np.diff(self.share[runs], prepend=-1))
        peer, share, times = self.peer[runs][new], self.share[runs][new], np.diff(np.append(new, len(runs)))
        base = self.base
        for g in range(len(self.sources)):
            mine = by_group[starts[g]:starts[g + 1]]
            zero = distance(base[g], base)
            cells = len(self.terms) * zero
            own = slice(*np.searchsorted(peer, [g, g + 1]))
            step = max(1, CELLS // len(base))
            for k in range(own.start, own.stop, step):
                part = slice(k, min(k + step, own.stop))
                cells += (times[part, None] * (distance(share[part, None], base) - zero)).sum(axis=0)
            np.add.at(cells, peer, times * (distance(base[g], share) - zero[peer]))
            lengths = self.ends[self.term[mine] + 1] - self.ends[self.term[mine]]
            done = np.cumsum(lengths) - lengths
            at = np.repeat(self.ends[self.term[mine]] - done, lengths) + np.arange(lengths.sum())
            for k in range(0, len(at), CELLS):
                to, p = at[k:k + CELLS], np.repeat(self.share[mine], lengths)[k:k + CELLS]
                h, q = self.peer[to], self.share[to]
                np.add.at(cells, h, distance(p, q) - distance(p, base[h]) - distance(base[g], q) + zero[h])
            yield g, cells, self.term[mine], self.share[mine]


def audit_slice(top: int):
    """What a slice finds of each group: all its cells, and its ``top`` terms above the language's share."""

    def run(key, index: pa.Table, peers: pa.Table) -> pa.Table:
        if not peers.num_rows:
            raise ValueError("every slice has the groups of its language")
        part, out = Slice(index, peers), []
        rank = np.zeros(len(part.terms), np.int64)
        rank[sorted(range(len(part.terms)), key=part.terms.__getitem__)] = np.arange(len(part.terms))
        for g, cells, terms, p in part.rows():
            others = np.flatnonzero(np.arange(len(cells)) != g).tolist()
            out.append((part.sources[g], "pair", [part.sources[k] for k in others], cells[others].tolist()))
            above = p > part.whole[terms]
            terms, value = terms[above], distance(p[above], part.whole[terms[above]])
            best = np.lexsort((rank[terms], -value))[:top]
            out.append((part.sources[g], "term", [part.terms[k] for k in terms[best].tolist()], value[best].tolist()))
        lang = key[0].as_py()
        source, kind, items, values = zip(*out)
        return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "source": pa.array(source, pa.string()),
                         "part": pa.array(kind, pa.string()), "items": pa.array(items, pa.list_(pa.string())),
                         "vals": pa.array(values, pa.list_(pa.int64()))})
    return run


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from its peers, and the terms it favours."""
    docs = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name) for name, c in
                         (("text", text_col), ("lang", lang_col), ("source", source_col))])
    index = stored(term_index(docs, min_docs), "divergence-index")
    counts = (index.select("lang", F.explode("postings").alias("x")).groupBy("lang", "x.source").agg(F.sum("x.n").alias("n")))
    langs = index.groupBy("lang").agg(F.count("*").alias("terms"), F.ceil(F.sum(F.size("postings")) / SLICE_POSTINGS).alias("slices"))
    langs = stored(langs, "divergence-langs")
    few = langs.count() <= BROADCAST_LANGS
    small = F.broadcast(langs) if few else langs
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    peers = (docs.select("lang", "source").distinct().join(counts, ["lang", "source"], "left").join(small, "lang", "left")
             .select("lang", "source", F.coalesce("n", none).alias("n"), F.coalesce("terms", none).alias("terms"),
                     F.explode(F.sequence(none, F.coalesce("slices", one) - 1)).alias("slice")))
    sliced = index.join(small, "lang").select("lang", F.pmod(F.xxhash64("term"), "slices").alias("slice"), "term", "postings")
    found = sliced.groupBy("lang", "slice").cogroup(peers.groupBy("lang", "slice")).applyInArrow(
        audit_slice(top), "lang string, source string, part string, items array<string>, vals array<long>")
    rows = (found.select("lang", "source", "part", F.explode(F.arrays_zip("items", "vals")).alias("x"))
            .groupBy("lang", "source", "part", F.col("x.items").alias("item")).agg(F.sum("x.vals").alias("value")))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    return (rows.withColumn("rank", F.row_number().over(order))
            .where((F.col("part") == "pair") | (F.col("rank") <= top)))
