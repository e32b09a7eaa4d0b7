"""Sharding by histogram sort (operator 10), with DataFrame functions only.

Rows are ordered by a key of their text's digest, so equal texts lie together,
then id, then a row number that the written key table keeps. Shards are to have
equal bytes: a group of equal texts goes whole to the shard in which its middle
byte lies, and a group of more than ``TOLERANCE`` of a shard is cut between
rows by the same rule.

The key is a hex string and a candidate boundary is a key prefix. Each round
counts, across all partitions, the exact bytes and rows below the candidate
boundaries; a bucket between two of them is refined by more of the key while a
splitter falls inside it and it can still be cut, or while it holds more than
``1 / MAX_BUCKETS`` of the rows. Then rows are exchanged once, by bucket; a
row's slot is its bucket's exact offset in the shard plus its place in the
bucket, so no task holds a whole shard.

Edge cases: a null text counts as no bytes and as the empty text; null ids sort
first; rows equal in all columns get different slots; an empty table
gives an empty result; with fewer rows than shards some shards stay empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pageflow.session import scratch_path

SHARDS = 16
TOLERANCE = 0.01
FIRST_HEX, STEP_HEX = 3, 1
MAX_BUCKETS = 2048
GROUP_HEX, KEY_HEX = 32, 65


@dataclass
class Bucket:
    prefix: str
    rows: int
    bytes: int
    low: str
    high: str

    def one_group(self) -> bool:
        """Whether all rows have the same text."""
        return self.low[:GROUP_HEX] == self.high[:GROUP_HEX]

    def deeper(self) -> int:
        """Prefix length that splits this bucket: past what its smallest and largest key share."""
        same = next((i for i, (a, b) in enumerate(zip(self.low, self.high)) if a != b), KEY_HEX)
        return min(KEY_HEX, same + STEP_HEX)


def key_of(text: Column, doc_id: Column, number: Column) -> Column:
    """65 hex digits that sort as (text digest, id with nulls first, number)."""
    unsigned = F.coalesce(doc_id, F.lit(0).cast("long")).bitwiseXOR(F.lit(-(1 << 63)))

    def digits(number: Column) -> Column:
        return F.lpad(F.lower(F.hex(number)), 16, "0")

    return F.concat(F.md5(F.coalesce(text, F.lit(""))), F.when(doc_id.isNull(), F.lit("0")).otherwise(F.lit("1")),
                    digits(unsigned), digits(number))


def _bucket_of(cuts: dict[str, int]) -> Column:
    """Prefix of the key at the depth that its bucket has; ``cuts``: refined prefix -> its new prefix length."""
    by_shape: dict[tuple[int, int], list[str]] = {}
    for prefix, depth in cuts.items():
        by_shape.setdefault((len(prefix), depth), []).append(prefix)
    bucket = F.substring("key", 1, FIRST_HEX)
    for (length, depth), prefixes in sorted(by_shape.items()):
        bucket = F.when(F.substring("key", 1, length).isin(prefixes), F.substring("key", 1, depth)).otherwise(bucket)
    return bucket


def _counted(keys: DataFrame, prefix: Column) -> list[Bucket]:
    found = keys.groupBy(prefix.alias("prefix")).agg(
        F.count("*").alias("n"), F.sum("size").alias("b"), F.min("key").alias("low"), F.max("key").alias("high"))
    return [Bucket(r["prefix"], r["n"], r["b"], r["low"], r["high"]) for r in found.collect()]


def histogram(keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> tuple[list[Bucket], dict[str, int]]:
    """Buckets in key order that splitters can be put between, and the cuts that made them.

    What comes to the driver is bounded: 16**FIRST_HEX buckets at first, and 16
    for each bucket that is refined, of which there are at most ``shards`` and
    ``MAX_BUCKETS`` a round.
    """
    buckets = sorted(_counted(keys, F.substring("key", 1, FIRST_HEX)), key=lambda b: b.prefix)
    cuts: dict[str, int] = {}
    while True:
        total, rows = sum(b.bytes for b in buckets), sum(b.rows for b in buckets)
        below, refine = 0, {}
        groups: dict[str, int] = {}
        for b in buckets:
            if b.one_group():
                groups[b.low[:GROUP_HEX]] = groups.get(b.low[:GROUP_HEX], 0) + b.bytes
        for b in buckets:
            split = (below + b.bytes) * shards // max(1, total) * total > below * shards  # a splitter is inside
            whole = b.one_group() and groups[b.low[:GROUP_HEX]] <= tolerance * total / shards
            if b.rows > 1 and ((split and not whole) or b.rows > max(rows / MAX_BUCKETS, 1000)):
                refine[b.prefix] = b.deeper()
            below += b.bytes
        if not refine:
            return buckets, cuts
        cuts |= refine
        lengths = sorted({len(p) for p in refine})
        inside = F.lit(False)
        for n in lengths:
            inside |= F.substring("key", 1, n).isin([p for p in refine if len(p) == n])
        finer = _counted(keys.where(inside), _bucket_of(cuts))
        buckets = sorted([b for b in buckets if b.prefix not in refine] + finer, key=lambda b: b.prefix)


def assign(buckets: list[Bucket], shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[tuple[str, int, int]]:
    """(prefix, shard, slots used before it in the shard) of each bucket, in key order."""
    total = max(1, sum(b.bytes for b in buckets))
    used, out, below = [0] * shards, [], 0
    units: list[list[Bucket]] = []  # buckets that stay together
    for b in buckets:
        if units and b.one_group() and units[-1][0].one_group() and units[-1][0].low[:GROUP_HEX] == b.low[:GROUP_HEX]:
            units[-1].append(b)
        else:
            units.append([b])
    for unit in units:
        size = sum(b.bytes for b in unit)
        for part in [unit] if size <= tolerance * total / shards else [[b] for b in unit]:
            size = sum(b.bytes for b in part)
            shard = min(shards - 1, (2 * below + size) * shards // (2 * total))
            for b in part:
                out.append((b.prefix, shard, used[shard]))
                used[shard] += b.rows
            below += size
    return out


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, size, text_crc32, shard and slot. The narrow key table is written once to the shared folder."""
    spark = docs.sparkSession
    text, doc_id = F.col(f"`{text_col}`"), F.col(f"`{id_col}`").cast("long")
    path = scratch_path(spark, "shard-keys")
    (docs.select(doc_id.alias("doc_id"), key_of(text, doc_id, F.monotonically_increasing_id()).alias("key"),
                 (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
                 F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32")).write.parquet(path))
    keys = spark.read.parquet(path)
    buckets, cuts = histogram(keys, shards)
    places = spark.createDataFrame(assign(buckets, shards), "bucket string, shard int, before long")
    # one row a bucket, a number that histogram() bounds
    placed = keys.withColumn("bucket", _bucket_of(cuts)).join(F.broadcast(places), "bucket")
    order = Window.partitionBy("bucket").orderBy("key")
    return placed.select("doc_id", "size", "text_crc32", "shard",
                         (F.col("before") + F.row_number().over(order) - 1).cast("long").alias("slot"))
