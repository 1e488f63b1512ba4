"""Helpers shared by the corpus operators: texts as bytes, Arrow batches, tables cut from their lineage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreflow.session import scratch_path

#: Rows that one Arrow batch hands to Python; texts may be long, so batches stay small.
BATCH_ROWS = 256

#: Spark's setting to remove the shuffle files of a job when it ends, not when the driver collects garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: The words of most contracts are what bytes.split() yields: runs without space, tab, LF, VT, FF, CR.
SPACES = b" \t\n\x0b\x0c\r"


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces_of(batch: pa.RecordBatch, size: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """A batch in slices of few rows, so that what is made of one slice stays small."""
    for start in range(0, batch.num_rows, size):
        yield batch.slice(start, size)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`work` on small slices of every Arrow batch; it yields batches of `schema`."""

    def run(batches):
        for batch in batches:
            for piece in pieces_of(batch):
                yield from work(piece)

    return df.mapInArrow(run, schema)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared scratch folder and read again: a lineage cut that
    survives lost executors. The shuffles behind it go once it is written."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def bytes_of(column: pa.Array) -> list[bytes]:
    """The values of a string column as UTF-8 bytes; null becomes empty."""
    return [x if x is not None else b"" for x in column.cast(pa.binary()).to_pylist()]


def texts_of(column: pa.Array) -> list[str]:
    return [x if x is not None else "" for x in column.to_pylist()]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_BYTE_VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def powers(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count-1) modulo 2**64."""
    out = np.full(count, np.uint64(base))
    if count:
        out[0] = 1
    return np.multiply.accumulate(out)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] for many ranges of one byte array, in one pass: prefix sums of
    random byte values times powers of an odd number, moved to a common origin."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * powers(_ODD, len(data)), out=sums[1:])
    back = powers(_INVERSE, len(data) + 1)
    lengths = (ends - starts).astype(np.uint64)
    return mixed((sums[ends] - sums[starts]) * back[starts] + lengths)


def word_bounds(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that `is_word` (256 flags) marks."""
    flags = np.zeros(len(data) + 2, np.int8)
    flags[1:-1] = is_word[data]
    steps = np.diff(flags)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def byte_flags(inside: Callable[[int], bool]) -> np.ndarray:
    return np.array([inside(b) for b in range(256)], np.int8)


NO_SPACE = byte_flags(lambda b: b not in SPACES)


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, across its tasks. Callers bound its size."""
    import sys
    import types

    module = sys.modules.setdefault("corpus_worker_caches", types.ModuleType("corpus_worker_caches"))
    return module.__dict__.setdefault(name, {})


class Words:
    """The words of several texts in one byte array: `start`, `end` and `text` (which text) of each,
    and a 64-bit hash of its bytes."""

    def __init__(self, texts: list[bytes], is_word: np.ndarray):
        self.data = np.frombuffer(b" ".join(texts), np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.origin = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.start, self.end = word_bounds(self.data, is_word)
        self.text = np.searchsorted(self.origin, self.start, "right") - 1
        self.hash = range_hashes(self.data, self.start, self.end)
        self.count = np.bincount(self.text, minlength=len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.count)])[:-1]

    def word(self, i: int) -> str:
        return self.data[self.start[i] : self.end[i]].tobytes().decode("utf-8", "replace")

    def shingles(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all runs of `length` words that lie in one text."""
        n = len(self.hash) - length + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        total = np.full(n, np.uint64(length))
        for i, power in enumerate(powers(_ODD, length)):
            total += self.hash[i : i + n] * power
        inside = np.flatnonzero(self.text[:n] == self.text[length - 1 :])
        return inside, mixed(total[inside])


BLOCK_WORDS = 1 << 13


def bitmap_of(df: DataFrame, column: str, bits: int):
    """A broadcast bitmap of a column of hashes: 2**bits bits whatever the rows.

    Spark makes its 64-bit words and joins them to blocks of 64 KB, which the driver puts side by side.
    """
    words = df.select(F.shiftrightunsigned(column, 64 - bits).alias("place")).groupBy(
        F.shiftright("place", 6).cast("int").alias("at")
    ).agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("flags"))
    dealt = words.select(F.shiftright("at", 13).alias("block"), "at", "flags").repartition("block")

    def run(batches):
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            block, at, flags = (batch.column(i).to_numpy() for i in range(3))
            for b in np.unique(block).tolist():
                own = block == b
                held = blocks.setdefault(b, np.zeros(BLOCK_WORDS, np.int64))
                held[at[own] - b * BLOCK_WORDS] = flags[own]
        yield pa.RecordBatch.from_pydict(
            {"block": list(blocks), "flags": [x.tobytes() for x in blocks.values()]},
            pa.schema([("block", pa.int32()), ("flags", pa.binary())]))

    flags = np.zeros(max(1 << (bits - 6), BLOCK_WORDS), np.int64)
    for row in dealt.mapInArrow(run, "block int, flags binary").collect():  # 64 KB each, 2**(bits - 19) of them
        flags[row["block"] * BLOCK_WORDS : (row["block"] + 1) * BLOCK_WORDS] = np.frombuffer(row["flags"], np.int64)
    return df.sparkSession.sparkContext.broadcast(flags.view(np.uint64))


def in_bitmap(hashes: np.ndarray, flags: np.ndarray, bits: int) -> np.ndarray:
    place = hashes >> np.uint64(64 - bits)
    return (flags[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def join_with_hot(rows: DataFrame, unique: DataFrame, keys: list[str], count: str) -> DataFrame:
    """`rows` joined to `unique`, which has one row for each key and, in `count`, how many of `rows` have it.

    Keys with over a thousandth of all rows, of which there are a thousand at most, are joined by
    broadcast, so none of their rows move; the others go through an ordinary join.
    """
    total = unique.agg(F.sum(count)).head()[0] or 0
    is_hot = F.col(count) * 1000 > total
    hot, rest = unique.where(is_hot), unique.where(~is_hot)
    near = rows.join(F.broadcast(hot), keys)
    far = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys)
    return near.unionByName(far)


def in_bitmap_column(hashes: Column, shared, bits: int) -> Column:
    """Whether a bitmap (`bitmap_of`) has a column of hashes."""

    def run(batch: pa.Array) -> pa.Array:
        return pa.array(in_bitmap(batch.to_numpy(zero_copy_only=False).view(np.uint64), shared.value, bits))

    return F.arrow_udf(run, "boolean")(hashes)


MAX_BITMAP_BITS = 27


def bits_for(count: int) -> int:
    """A bitmap's size for so many keys: eight bits each, from 64 K to 128 M bits."""
    return min(max((8 * count).bit_length(), 16), MAX_BITMAP_BITS)


def kept_rows(rows: DataFrame, decided: DataFrame, keys: list[str]) -> DataFrame:
    """Those of `rows` whose keys `decided` (keys..., _keep) keeps; one of the rows that share all keys. Null keys
    are values like others.

    Rows are large and keys small, so rows are not joined to keys. A bitmap of the keys that go, and of those
    that come twice, lets all other rows through at once; of the rest, rows pass a second bitmap, of the kept
    keys that the first one has by chance or twice. What both have is decided by a join on the keys: repeated
    rows and about one in a hundred others.
    """
    name = F.xxhash64(*keys)
    decided = stored(decided.groupBy(*keys).agg(F.max("_keep").alias("_keep"), F.count("*").alias("_times")).withColumn("_hash", name), "decided")
    barred = decided.where(~F.col("_keep") | (F.col("_times") > 1))
    count = barred.count()
    if not count:
        return rows
    bits = bits_for(count)
    first = bitmap_of(barred.select("_hash"), "_hash", bits)
    unclear = stored(decided.where("_keep").where(in_bitmap_column(F.col("_hash"), first, bits)).select(*keys, "_hash"), "unclear")
    more = bits_for(unclear.count())
    second = bitmap_of(unclear.select("_hash"), "_hash", more)
    marked = rows.withColumn("_hash", name)
    sure = marked.where(~in_bitmap_column(F.col("_hash"), first, bits))
    rest = marked.where(in_bitmap_column(F.col("_hash"), first, bits)).where(in_bitmap_column(F.col("_hash"), second, more))
    other = unclear.select(*(F.col(k).alias(f"_other_{k}") for k in keys))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_other_{k}"))
    settled = rest.join(other, same, "left_semi").dropDuplicates(keys)
    return sure.unionByName(settled).drop("_hash")
