"""Substring dedup by content-defined chunks (operator 1).

A gear rolling hash runs over the bytes of each text: every byte shifts the
hash and adds its own random number, so after 16 bytes nothing older is left in
its 16 bits. A chunk ends where the top bits are 0; inserted or removed bytes
thus move only the borders near them, and a passage that recurs anywhere is cut
alike from its second border on. Chunks are deduplicated by a 128-bit digest:
one aggregate finds those that occur twice or more and the smallest document
that has them, and a join marks their occurrences. Adjacent marked chunks make
a run; runs of at least ``MIN_RUN`` bytes are reported.

The aggregate combines before its shuffle, and the join has one row a digest on
its small side, so a passage that a third of all documents share is split by
Spark's skew join rather than gathered in a task.

Edge cases: null and empty texts have no chunks; a text shorter than a chunk is
one chunk; a stretch without a border is cut each ``MAX_CHUNK`` bytes; a null
id is never the first document of a passage unless all its rows have none; rows
that repeat the first document's id and text all keep it; a passage that recurs
inside one document is reported there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh3_128_digest as digest

from pageflow.llm.components import stored
from pageflow.llm.scan import map_texts

CUT_BITS = 5            # a border each 32 bytes on average
APART = 8               # and none within 8 bytes after a possible border
LONG_GAP = 128          # longer gaps between borders get borders by a second rule
MAX_CHUNK = 2048
MIN_RUN = 100           # longer than most common lines, shorter than what is left of 50 words between whole chunks
_GEAR = np.random.default_rng(20).integers(0, 1 << 16, 256).astype(np.uint16)


def _minima(gear: np.ndarray, gaps: list[tuple[int, int]]) -> np.ndarray:
    """Further borders inside long gaps: where the hash is the smallest of the last 32, at least 16 bytes apart."""
    low = gear.copy()
    for step in (1, 2, 4, 8, 16):
        low[step:] = np.minimum(low[step:], low[:-step].copy())
    out = []
    for start, end in gaps:
        last = start
        for at in (np.flatnonzero(gear[start:end] == low[start:end]) + start + 1).tolist():
            if at - last >= 16 and at < end and (at >= start + 32 or not start):
                out.append(at)
                last = at
    return np.array(out, np.int64)


def borders(data: bytes) -> np.ndarray:
    """Ends of the chunks of ``data`` (bytes), the last one its length."""
    raw = np.frombuffer(data, np.uint8)
    n = len(raw)
    gear = _GEAR[raw]
    for step in (1, 2, 4, 8):  # after these, each place sums 16 bytes, the k-th last shifted by k
        shifted = np.zeros(n, np.uint16)
        shifted[step:] = gear[:-step] << np.uint16(step) if n > step else 0
        gear = gear + shifted
    ends = np.flatnonzero((gear >> np.uint16(16 - CUT_BITS)) == 0) + 1
    ends = ends[(ends >= 16) & (ends < n)]
    if len(ends):
        ends = ends[np.diff(ends, prepend=-APART) >= APART]
    gaps = np.flatnonzero(np.diff(ends, prepend=0, append=n) > LONG_GAP)
    if len(gaps):  # text of few different hashes, such as one word over and over
        ends = np.sort(np.concatenate([ends, _minima(gear, [(int(ends[g - 1]) if g else 0, int(ends[g]) if g < len(ends) else n) for g in gaps])]))
    ends = ends[(raw[ends] & 0xC0) != 0x80]  # not inside a character
    ends = np.append(ends, n)
    sizes = np.diff(ends, prepend=0)
    if sizes.max() <= MAX_CHUNK:
        return ends
    out: list[int] = []
    for end, size in zip(ends.tolist(), sizes.tolist()):
        start = end - size
        while end - start > MAX_CHUNK:
            start += MAX_CHUNK
            while raw[start] & 0xC0 == 0x80:
                start -= 1
            out.append(start)
        out.append(end)
    return np.array(out)


def chunk(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a chunk: row (a number of the document's row), id, digest in two halves, start and end (code points) and bytes."""
    names = ["row", "doc_id", "digest", "second", "start", "end", "bytes"]

    def run(batches):
        for b in batches:
            sizes, columns = [], [[], [], [], [], []]
            for text in b.column("text").to_pylist():
                data = (text or "").encode("utf-8", "surrogatepass")
                if not data:
                    sizes.append(0)
                    continue
                ends = borders(data)
                starts = np.concatenate([[0], ends[:-1]])
                points = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
                found = np.frombuffer(b"".join([digest(data[i:j]) for i, j in zip(starts.tolist(), ends.tolist())]), np.int64)
                sizes.append(len(ends))
                for column, part in zip(columns, (found[::2], found[1::2], points[starts], points[ends], ends - starts)):
                    column.append(part)
            if columns[0]:
                rows = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                rest = [pa.array(np.concatenate(c).astype(np.int64)) for c in columns]
                yield pa.RecordBatch.from_arrays([b.column("row").take(rows), b.column("doc_id").take(rows), *rest], names)

    columns = {"row": F.monotonically_increasing_id(), "doc_id": F.col(f"`{id_col}`").cast("long"), "text": text_col}
    return map_texts(docs, columns, ", ".join(f"{n} long" for n in names), run)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """One row a repeated run: id, start and end (code points), bytes, first_doc_id and ``removed``.

    A run is a stretch of adjacent repeated chunks. ``removed`` is false where
    the document has the first occurrence (smallest id, then smallest start),
    which a deduplicated corpus keeps.
    """
    chunks = chunk(docs, id_col, text_col)
    again = (chunks.groupBy("digest", "second").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc_id"))
             .where("n > 1").select("digest", "second", "first_doc_id"))
    again = stored(again, "chunk-digests")  # so that the join's sides are both shuffled, and a hot one can be split
    marked = chunks.join(again, ["digest", "second"]).withColumn("own", F.col("doc_id").eqNullSafe(F.col("first_doc_id")))
    place = F.row_number().over(Window.partitionBy("row", "digest", "second").orderBy("start"))
    kept = marked.repartition("row").withColumn("removed", ~F.col("own") | (place > 1))
    order = Window.partitionBy("row").orderBy("start")
    new = (F.col("start") != F.lag("end", 1, -1).over(order)) | (F.col("removed") != F.lag("removed", 1, False).over(order))
    runs = kept.withColumn("run", F.sum(new.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return (runs.groupBy("row", "run")
            .agg(F.min("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("end").alias("end"),
                 F.sum("bytes").alias("bytes"), F.min("first_doc_id").alias("first_doc_id"),
                 F.max("removed").alias("removed"))
            .where(F.col("bytes") >= min_run)
            .select("doc_id", "start", "end", "bytes", "first_doc_id", "removed"))
