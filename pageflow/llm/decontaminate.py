"""Benchmark decontamination (operator 5).

Passages are aligned with items by Smith-Waterman over words, which scores
exact, edited and paraphrased copies. Which documents meet which items is found by rare n-grams:

1. An item's n-grams are the pairs of its words that are one or two words apart (an item of one word
   has that word). Between two equal words of an alignment that follow one
   another, a step over d words of either side costs d - 1; so of a passage that scores
   ``bar``, at least ``bar / 2 - 1`` steps are over one or two words in the item and in
   the text: it holds that many of the item's n-grams, at different words.
2. All documents are scanned for the n-grams of all items, which are counted.
   Each item leaves out its most common ones, at most half of the n-gram starts
   that a leak must have. The rest are its seeds; every passage
   over the bars holds the other half, however often the item leaked.
3. A second scan sends (text, seed) for the seeds that a text holds, which are
   joined with the items. A bitmap of fixed size keeps other n-grams back. Of the texts
   so joined with an item, those stay that hold enough of its seeds.
4. Each such text is aligned with its items, in Spark tasks; bounds
   on running sums of shared words say in which stretches.

Equal texts are aligned once. The benchmark is a table like any other: it is
joined, never collected.

A passage is a leak if its alignment scores at least ``MIN_SHARE`` of the
item's full score with ``MIN_MATCHES`` equal words (all words of a shorter
item), or if it scores as much as ``LONG_COPY`` equal words in a row.

Edge cases: null and empty texts and items have no leaks; an item of fewer
than ``WHOLE_WORDS`` words must be found whole; equal items are
reported each; a document that repeats an item has one leak a passage; words
are compared with A-Z in lower case, split at ASCII white space.
"""

from __future__ import annotations

import hashlib
import math
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructField, StructType

from pageflow.llm.components import stored
from pageflow.llm.jaccard import BITMAP_BITS, hash_bitmap
from pageflow.llm.scan import map_texts
from pageflow.llm.shingles import pair_hashes, word_hashes

WHOLE_WORDS = 3
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SHARE, MIN_MATCHES, LONG_COPY = 0.4, 8, 13
REACH = 2                 # words that an n-gram may step over to its second word, by the first bound
HELD, RANGE_GRAMS, TASK_PAIRS = 1_000_000, 200_000, 500
BROADCAST_TEXTS = 500_000
#: One in so many of the words, or n-gram starts, that a leak must hold may be left out of an index.
LEFT_OUT = 2

LEAK_ARROW = pa.struct([("item_id", pa.int64()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("matches", pa.int64()),
                        ("score", pa.float64())])
LEAK = StructType([StructField("item_id", LongType()), StructField("start_word", LongType()),
                   StructField("end_word", LongType()), StructField("matches", LongType()),
                   StructField("score", DoubleType())])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers starts[k] to starts[k] + counts[k] - 1 of every k, one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


class Items:
    """Test items as word numbers, with an index from words to items."""

    def __init__(self, rows: list[tuple[int, str | None]]):
        self.number: dict[bytes, int] = {}
        split = [(i, words_of(t)) for i, t in rows]
        split = [(i, w) for i, w in split if w]
        self.ids = [i for i, _ in split]
        self.words = [np.array([self.number.setdefault(x, len(self.number)) for x in w], np.int64) for _, w in split]
        lengths = [len(w) for w in self.words]
        self.bars = np.array([bar(n) for n in lengths])
        self.least = np.array([least(n) for n in lengths], np.int64)
        own = [np.unique(w, return_counts=True) for w in self.words]
        self.own_words = np.concatenate([w for w, _ in own]) if own else np.zeros(0, np.int64)
        self.own_counts = np.array([len(w) for w, _ in own], np.int64)
        self.own_starts = np.cumsum(self.own_counts) - self.own_counts
        common = np.bincount(self.own_words, minlength=len(self.number))
        self.index_bars = self.bars.copy()
        pairs = []
        for k, (words, counts) in enumerate(own):
            order = np.lexsort((words, -common[words]))
            left_out = np.searchsorted(np.cumsum(counts[order]), self.least[k] // LEFT_OUT, side="right")
            self.index_bars[k] -= (MATCH - GAP) * counts[order[:left_out]].sum()
            pairs += [(w, k) for w in words[order[left_out:]].tolist()]
        pairs = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.index = pairs[:, 1]
        self.index_counts = np.bincount(pairs[:, 0], minlength=len(self.number))
        self.index_starts = np.cumsum(self.index_counts) - self.index_counts

    def numbered(self, text: str | None) -> np.ndarray:
        w = words_of(text)
        return np.fromiter(map(self.number.get, w, repeat(-1)), np.int64, len(w))

    def stretches(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, start, end) of every part of a text that may hold leaks of an item, ordered."""
        at = np.flatnonzero(words >= 0)
        known = words[at]
        counts = self.index_counts[known]
        met = np.sort(self.index[expand(self.index_starts[known], counts)] * len(words) + np.repeat(at, counts))
        if not len(met):
            return []
        item, place = np.divmod(met, len(words))
        first, _, peak = running_sums(item, place)
        near = np.unique(item[first[peak >= self.index_bars[item[first]]]])
        if not len(near):
            return []
        order = np.argsort(known, kind="stable")
        wanted = self.own_words[expand(self.own_starts[near], self.own_counts[near])]
        low = np.searchsorted(known[order], wanted)
        found = np.searchsorted(known[order], wanted, side="right") - low
        rank = np.repeat(np.repeat(np.arange(len(near)), self.own_counts[near]), found)
        rank, place = np.divmod(np.sort(rank * len(words) + at[order[expand(low, found)]]), len(words))
        first, last, peak = running_sums(rank, place)
        item = near[rank[first]]
        good = (peak >= self.bars[item]) & (last - first + 1 >= self.least[item])
        return list(zip(item[good].tolist(), place[first[good]].tolist(), (place[last[good]] + 1).tolist()))


def running_sums(item: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches where the sum of ``MATCH`` a listed word and ``GAP`` for any other stays above 0: (first, last, peak).

    ``place`` rises within each ``item``, and items rise.
    """
    apart = (MATCH - GAP) * (len(item) + 1) - GAP * (int(place.max()) + 1)
    rise = (MATCH - GAP) * np.arange(len(item)) + GAP * place - item * apart
    lowest = np.minimum.accumulate(rise)
    first = np.flatnonzero(np.concatenate([[True], rise[1:] <= lowest[:-1]]))
    last = np.concatenate([first[1:], [len(item)]]) - 1
    return first, last, np.maximum.reduceat(rise - lowest, first) + MATCH


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int, int]:
    """Smith-Waterman over words: (score, equal words, start, end) of the best local alignment in ``passage``."""
    m, w = len(item), len(passage)
    table = np.zeros((m + 1, w + 1), np.int32)
    slope = -GAP * np.arange(w + 1, dtype=np.int32)
    for i in range(1, m + 1):
        row = np.maximum(table[i - 1] + GAP, 0)
        row[1:] = np.maximum(row[1:], table[i - 1, :-1] + np.where(passage == item[i - 1], MATCH, MISMATCH))
        table[i] = np.maximum.accumulate(row + slope) - slope  # gaps along the passage, in one step
    i, j = np.unravel_index(int(table.argmax()), table.shape)
    best, end, equal = int(table[i, j]), int(j), 0
    while table[i, j] > 0:
        same = item[i - 1] == passage[j - 1]
        if table[i, j] == table[i - 1, j - 1] + (MATCH if same else MISMATCH):
            equal += int(same)
            i, j = i - 1, j - 1
        elif table[i, j] == table[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return best, equal, int(j), end


def bar(length: int) -> float:
    """The least score of a leak."""
    return MATCH * length if length < WHOLE_WORDS else min(MIN_SHARE * MATCH * length, LONG_COPY * MATCH)


def least(length: int) -> int:
    """The least number of equal words of a leak."""
    return max(math.ceil(bar(length) / MATCH), min(MIN_MATCHES, length, LONG_COPY))


def is_leak(score: int, equal: int, length: int) -> bool:
    return ((score >= MIN_SHARE * MATCH * length and equal >= min(MIN_MATCHES, length))
            or score >= LONG_COPY * MATCH)


def possible(item: np.ndarray, passage: np.ndarray) -> int:
    """A score that no alignment exceeds: the best sum over a part of the item, whose words count if ``passage`` has them."""
    sums = np.concatenate([[0], np.cumsum(np.where(np.isin(item, passage), MATCH, max(MISMATCH, GAP)))])
    return int((sums - np.minimum.accumulate(sums)).max())


def copies(item: np.ndarray, passage: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(start, end, equal words, score) of all leaks in ``passage`` that do not overlap, the best first taken, in order."""
    n, size, longest = len(passage), max(8 * len(item), 4096), 3 * len(item)
    out, low = [], 0
    while low < n:  # one part of bounded size after the other; what may go on after its end is left to the next
        high = min(n, low + size)
        found, open_parts = [], [(low, high)]
        while open_parts:
            a, b = open_parts.pop()
            if b - a < least(len(item)) or possible(item, passage[a:b]) < bar(len(item)):
                continue
            score, equal, start, end = align(item, passage[a:b])
            if score < bar(len(item)):
                continue
            if is_leak(score, equal, len(item)) and (high == n or a + start < high - longest):
                found.append((a + start, a + end, equal, score))
            open_parts += [(a, a + start), (a + end, b)]
        out += sorted(found)
        low = n if high == n else max([high - longest, *(x[1] for x in found)])
    return out


def leaks_of(items: Items, text: str | None) -> list[dict]:
    """All leaks of the items in a text, ordered by item and place."""
    words = items.numbered(text)
    out = []
    for k, low, high in items.stretches(words):
        item = items.words[k]
        out += [{"item_id": items.ids[k], "start_word": low + a, "end_word": low + b, "matches": equal,
                 "score": score / (MATCH * len(item))} for a, b, equal, score in copies(item, words[low:high])]
    return out


def _grams(texts: pa.StringArray) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the words alone and of the pairs one and two words apart; where each text's words start."""
    word, first = word_hashes(texts)
    return [pair_hashes(word, first, apart) for apart in range(REACH + 1)], first


def item_grams(items: DataFrame) -> DataFrame:
    """(item, start, gram, least): each n-gram of an item; ``least``: n-gram starts that a leak of it has at least."""
    names = ["item", "start", "gram", "least"]

    def run(batches):
        for b in batches:
            grams, first = _grams(b.column("text"))
            for k, item in enumerate(b.column("item").to_pylist()):
                low, high = first[k], first[k + 1]
                n = int(high - low)
                for g in grams[:1] if n == 1 else grams[1:]:
                    start = np.flatnonzero(g[low:high])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(start), item), pa.int64()), pa.array(start, pa.int64()),
                         pa.array(g[low:high][start].view(np.int64)), pa.array(np.full(len(start), least_starts(n)), pa.int64())], names)

    return map_texts(items, {"item": "item", "text": "text"}, "item long, start long, gram long, least long", run)


def least_starts(length: int) -> int:
    """N-gram starts of an item of ``length`` words that each of its leaks holds at least."""
    return max(1, math.ceil(bar(length) / MATCH - 1)) if length > 1 else 1


def _hits(batches, bits: np.ndarray):
    """(slice, n-gram hashes that may be an item's, number of their text) of each slice of texts."""
    mask = np.uint64((1 << BITMAP_BITS) - 1)
    for b in batches:
        grams, first = _grams(b.column("text"))
        found, texts = [], []
        for g in grams:
            place = g & mask
            at = np.flatnonzero((bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 & (g != 0))
            found.append(g[at])
            texts.append(np.searchsorted(first, at, side="right") - 1)
        yield b, np.concatenate(found), np.concatenate(texts)


def gram_counts(docs: DataFrame, text_col: str, grams: DataFrame) -> DataFrame:
    """(gram, n): how often the corpus has the items' n-grams, summed over parts of a task."""
    sent = docs.sparkSession.sparkContext.broadcast(hash_bitmap(grams, "gram"))

    def run(batches):
        waiting, held = [], 0

        def summed():
            gram, n = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n, pa.int64())], ["gram", "n"])

        for _, gram, _ in _hits(batches, sent.value):
            waiting.append(gram)
            held += len(gram)
            if held > HELD:
                yield summed()
                waiting, held = [], 0
        if waiting:
            yield summed()

    return map_texts(docs, {"text": text_col}, "gram long, n long", run).groupBy("gram").agg(F.sum("n").alias("n"))


def seeds(grams: DataFrame, counts: DataFrame, ranges: int) -> DataFrame:
    """(item, gram, starts, need): the n-grams of each item without its most common ones; ``need``: starts that a leak holds of them."""

    def run(part: pa.Table) -> pa.Table:
        item, start, gram, least, n = (part.column(c).to_numpy() for c in ("item", "start", "gram", "least", "n"))
        order = np.lexsort((gram, -n, item))
        out = []
        for rows in np.split(order, np.flatnonzero(np.diff(item[order])) + 1):
            gone: set[int] = set()
            full = False
            for same in np.split(rows, np.flatnonzero(np.diff(gram[rows])) + 1):
                if not len(same):
                    continue
                full = full or len(gone | set(start[same].tolist())) > least[same[0]] // LEFT_OUT
                if full:
                    out.append((item[same[0]], gram[same[0]], len(np.unique(start[same])), least[same[0]] - len(gone)))
                else:
                    gone |= set(start[same].tolist())
        return pa.table([pa.array(x, pa.int64()) for x in (zip(*out) if out else [[]] * 4)], ["item", "gram", "starts", "need"])

    known = grams.join(counts, "gram", "left").fillna(0, ["n"])
    return (known.withColumn("range", F.pmod(F.xxhash64("item"), F.lit(ranges))).groupBy("range")
            .applyInArrow(run, "item long, gram long, starts long, need long"))


def candidates(docs: DataFrame, text_col: str, chosen: DataFrame) -> DataFrame:
    """(text, item): digests of texts that hold as many seeds of an item as its leaks do."""
    sent = docs.sparkSession.sparkContext.broadcast(hash_bitmap(chosen, "gram"))

    def run(batches):
        for b, gram, text in _hits(batches, sent.value):
            met = np.unique(np.rec.fromarrays([text, gram], names="text,gram"))
            if len(met):
                at, place = np.unique(met.text, return_inverse=True)
                texts = b.column("text").cast(pa.binary()).take(pa.array(at))
                digests = pa.array([hashlib.md5(x.as_buffer()).digest() for x in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([digests.take(pa.array(place)), pa.array(met.gram.view(np.int64))], ["text", "gram"])

    held = map_texts(docs, {"text": text_col}, "text binary, gram long", run).distinct()
    return (held.join(chosen, "gram").groupBy("text", "item").agg(F.sum("starts").alias("starts"), F.min("need").alias("need"))
            .where("starts >= need").select("text", "item"))


def digest_of(text_col: str) -> Column:
    """By which texts are joined; null is the empty text."""
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")))


def text_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """(text, leaks): the leaks of every distinct text that has one, by its digest, ordered by item and place."""
    items = stored(benchmark.select(F.col(f"`{item_id_col}`").cast("long").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
                   .withColumn("item", F.monotonically_increasing_id()), "leak-items")
    grams = stored(item_grams(items), "leak-grams")
    n = grams.count()
    chosen = stored(seeds(grams, gram_counts(docs, text_col, grams), n // RANGE_GRAMS + 1), "leak-seeds")
    pairs = stored(candidates(docs, text_col, chosen), "leak-pairs")
    items = items.select("item", F.struct("item_id", F.col("text").alias("words")).alias("of"))
    with_items = pairs.join(items, "item").groupBy("text").agg(F.array_sort(F.collect_list("of")).alias("items"))
    total = pairs.count()
    if total <= BROADCAST_TEXTS:  # 16 bytes each; else the texts are shuffled to them
        met = F.broadcast(pairs.select("text").distinct())
    else:
        met = pairs.select("text").distinct()
    texts = docs.select(F.col(f"`{text_col}`").alias("whole"), digest_of(text_col).alias("text")).join(met, "text", "left_semi")
    texts = texts.groupBy("text").agg(F.first("whole").alias("whole"))
    # few bytes, much work: the number of tasks follows the pairs
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, total // TASK_PAIRS)
    rows = texts.join(with_items, "text").select("text", "whole", "items").repartition(tasks, "text")

    def run(batches):
        for b in batches:
            for text, whole, mine in zip(*(b.column(c) for c in ("text", "whole", "items"))):
                found = leaks_of(Items([(x["item_id"], x["words"]) for x in mine.as_py()]), whole.as_py())
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([text.as_py()], pa.binary()), pa.array([found], pa.list_(LEAK_ARROW))], ["text", "leaks"])

    return rows.mapInArrow(run, StructType([StructField("text", BinaryType()), StructField("leaks", ArrayType(LEAK))]))


def flag(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text", item_id_col: str = "item_id",
         item_text_col: str = "text", name: str = "leaks") -> DataFrame:
    """``keep`` columns of every document and ``name``, an array of (item_id, start_word, end_word, matches, score)."""
    found = stored(text_leaks(docs, benchmark, text_col, item_id_col, item_text_col), "leaks")
    n, leaks = found.agg(F.count("*"), F.coalesce(F.sum(F.size("leaks")), F.lit(0))).first()
    if n + leaks <= BROADCAST_TEXTS:  # some 50 bytes each; else the documents are shuffled to them
        found = F.broadcast(found)
    kept = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], digest_of(text_col).alias("text"))
    none = F.array().cast(ArrayType(LEAK))
    return kept.join(found, "text", "left").select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
                                                   F.coalesce("leaks", none).alias(name))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each leaked passage: id, item_id, place in words, equal words and score."""
    return flag(docs, benchmark, [id_col], text_col).select(F.col(f"`{id_col}`").alias("doc_id"), F.inline("leaks"))
