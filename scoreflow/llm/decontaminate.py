"""Benchmark decontamination as a prefix-filtered set join.

A benchmark window (13 words, or a whole shorter item) is a set of shingles with places. For a
document to contain it, all its shingles must be there, so one of them is a sufficient prefix: the
rarest in the documents, by counts over all of them. Windows with a shingle that no document has are
out. Documents offer the places of prefix shingles with the words around; the join on the shingle is
followed by the bounds on place and length and by the comparison of all words of the window.

Documents are read past a bitmap of the wanted shingles. Its size is fixed whatever the benchmark's
size, so it can be broadcast; what it lets through wrongly meets nothing in the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreflow.llm.common import (
    Words, bitmap_of, bits_for, byte_flags, bytes_of, in_bitmap, in_bitmap_column, map_batches, stored, table,
)

WINDOW_WORDS = 13
SHINGLE_WORDS = 5
BITMAP_BITS = 26
MIN_PERCENT = 5

#: Words after lower-casing A-Z: digits, a-z and all bytes from 0x80.
WORD_BYTES = byte_flags(lambda b: b >= 0x80 or chr(b).isdigit() or "a" <= chr(b) <= "z")


def words_of(column: pa.Array) -> Words:
    return Words([t.lower() for t in bytes_of(column)], WORD_BYTES)


def item_windows(benchmark: DataFrame, window_words: int, shingle_words: int) -> DataFrame:
    """item_id, window (words joined by spaces), n, and the hashes of its shingles in order."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = words_of(batch.column("text"))
        rows = {"item_id": [], "window": [], "n": [], "shingles": []}
        by_length = {}
        for i, item in enumerate(batch.column("item_id").to_pylist()):
            count, first = int(words.count[i]), int(words.first[i])
            if not count:
                continue
            n = min(count, window_words)
            size = min(n, shingle_words)
            if size not in by_length:
                at, hashes = words.shingles(size)
                by_length[size] = dict(zip(at.tolist(), hashes.view(np.int64).tolist()))
            for start in range(first, first + count - n + 1):
                rows["item_id"].append(item)
                rows["window"].append(" ".join(map(words.word, range(start, start + n))))
                rows["n"].append(n)
                rows["shingles"].append([by_length[size][j] for j in range(start, start + n - size + 1)])
        yield pa.RecordBatch.from_pydict(rows, pa.schema([
            ("item_id", pa.string()), ("window", pa.string()), ("n", pa.int32()), ("shingles", pa.list_(pa.int64()))]))

    plain = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return map_batches(plain, work, "item_id string, window string, n int, shingles array<bigint>")


def find_hits(
    docs: DataFrame, benchmark: DataFrame, window_words: int = WINDOW_WORDS, shingle_words: int = SHINGLE_WORDS,
    bits: int = BITMAP_BITS,
) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, n_items, items_sha256: one row for each row of `docs`.

    Null texts have no words. Rows that repeat doc_id and text get the same counts; items without
    words are no windows; items with a null id mark words but are not listed. Empty tables are fine.
    """
    plain = docs.select(
        "doc_id", F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("text").cast("string").alias("text")
    )
    windows = stored(item_windows(benchmark, window_words, shingle_words), "windows")
    unique = windows.groupBy("window").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))
    placed = unique.select("window", "n", F.posexplode("shingles").alias("offset", "shingle"))
    sizes = [r[0] for r in windows.select(F.least("n", F.lit(shingle_words))).distinct().collect()]  # few numbers
    wanted = bitmap_of(placed, "shingle", bits)

    def count_wanted(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = words_of(batch.column("text"))
        for size in sizes:
            _, hashes = words.shingles(size)
            found, counts = np.unique(hashes[in_bitmap(hashes, wanted.value, bits)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], ["shingle", "seen"])

    seen = map_batches(plain.select("text"), count_wanted, "shingle bigint, seen bigint")
    seen = seen.groupBy("shingle").agg(F.sum("seen").alias("seen"))
    ranked = placed.join(seen, "shingle", "left").groupBy("window").agg(
        F.first("n").alias("n"), F.min_by(F.struct("shingle", "offset"), F.struct(F.coalesce("seen", F.lit(0)), "offset")).alias("rarest"),
        F.min(F.coalesce("seen", F.lit(0))).alias("seen"),
    )
    prefixes = stored(
        ranked.where("seen > 0").select("window", "n", "rarest.*", F.least("n", F.lit(shingle_words)).alias("size")), "prefixes"
    )
    probed = bitmap_of(prefixes, "shingle", bits)

    def offer(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = words_of(batch.column("text"))
        ids, hashes = batch.column("doc_id"), batch.column("text_hash")
        rows = batch.num_rows
        none = lambda n, kind: pa.nulls(n, kind)
        yield pa.RecordBatch.from_arrays(
            [ids, hashes, pa.array(words.count.astype(np.int64)), none(rows, pa.int64()), none(rows, pa.int32()),
             none(rows, pa.int64()), none(rows, pa.int32()), none(rows, pa.list_(pa.string()))], names)
        for size in sizes:
            at, shingle = words.shingles(size)
            hit = in_bitmap(shingle, probed.value, bits)
            at, shingle = at[hit], shingle[hit]
            if not len(at):
                continue
            text = words.text[at]
            first, last = words.first[text], words.first[text] + words.count[text]
            # A short item is its own shingle; others reach so far to both sides.
            reach = window_words - size if size == shingle_words else 0
            low, high = np.maximum(first, at - reach), np.minimum(last, at + size + reach)
            around = [[words.word(i) for i in range(a, b)] for a, b in zip(low.tolist(), high.tolist())]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(text)), hashes.take(pa.array(text)), none(len(at), pa.int64()),
                 pa.array(shingle.view(np.int64)), pa.array(np.full(len(at), size, np.int32)),
                 pa.array((at - first).astype(np.int64)), pa.array((at - low).astype(np.int32)),
                 pa.array(around, pa.list_(pa.string()))], names)

    names = ["doc_id", "text_hash", "n_words", "shingle", "size", "at", "before", "around"]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    offers = stored(map_batches(plain, offer, (
        f"doc_id {id_type}, text_hash bigint, n_words bigint, shingle bigint, size int, at bigint, before int, around array<string>"
    )), "offers")

    fits = (F.col("before") >= F.col("offset")) & (F.size("around") - F.col("before") >= F.col("n") - F.col("offset"))
    same = F.array_join(F.slice("around", F.col("before") - F.col("offset") + 1, F.col("n")), " ") == F.col("window")
    hits = offers.where("shingle is not null").join(prefixes, ["shingle", "size"]).where(
        F.when(fits, same).otherwise(False)
    ).select("doc_id", "text_hash", "window", (F.col("at") - F.col("offset")).alias("start"), "n")
    hits = stored(hits, "hits")
    key = ["doc_id", "text_hash"]
    ranges = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("stop"))))
    covered = F.aggregate(
        "ranges",
        F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("until")),
        lambda acc, x: F.struct(
            (acc["total"] + F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], acc["until"]))).alias("total"),
            F.greatest(acc["until"], x["stop"]).alias("until")),
        lambda acc: acc["total"],
    )
    hit_words = hits.groupBy(*key).agg(ranges.alias("ranges")).select(*key, covered.alias("n_hit"))
    hit_items = hits.select(*key, "window").distinct().join(windows.select("window", "item_id").distinct(), "window")
    hit_items = hit_items.groupBy(*key).agg(F.collect_set("item_id").alias("items"))
    found = hit_words.join(hit_items, [hit_words.doc_id.eqNullSafe(hit_items.doc_id), hit_words.text_hash == hit_items.text_hash])
    found = found.select(hit_words.doc_id.alias("hit_id"), hit_words.text_hash.alias("hit_hash"), "n_hit", "items")
    heads = offers.where("n_words is not null").select(*key, "n_words")
    joined = heads.join(found, [heads.doc_id.eqNullSafe(found.hit_id), heads.text_hash == found.hit_hash], "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        *key, "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= MIN_PERCENT * F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that are not contaminated, unchanged, repeated rows too."""
    bad = stored(find_hits(docs, benchmark, **options).where("contaminated").select(
        F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct(), "contaminated")
    count = bad.count()
    if not count:
        return docs
    # A bitmap of the texts that go lets all others through without a join, but for one in a hundred.
    bits = bits_for(count)
    flags = bitmap_of(bad.select("_bad_hash"), "_bad_hash", bits)
    hashed = docs.withColumn("_text_hash", F.xxhash64(F.col("text").cast("string")))
    met = in_bitmap_column(F.col("_text_hash"), flags, bits)
    same = F.col("doc_id").eqNullSafe(F.col("_bad_id")) & (F.col("_text_hash") == F.col("_bad_hash"))
    rest = hashed.where(met).join(bad, same, "left_anti")
    return hashed.where(~met).unionByName(rest).select(*(f"`{c}`" for c in docs.columns))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.drop("text_hash")
