"""Windows of a fixed length that occur more than once, over all documents.

Tasks cut each text into pieces: runs of windows that share an anchor, which the windows' own content
decides. Equal windows therefore have anchors of the same name, the key. Only keys that occur twice
go on; equal pieces count as one from then on, so a passage that is copied a million times is one
row. Keys with several different pieces are compared piece by piece, by the caller's method.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreflow.llm.common import _INVERSE, _ODD, bitmap_of, bytes_of, in_bitmap, join_with_hot, mixed, powers, stored

#: Units of a long text that are worked on at once.
SEGMENT = 1 << 20
BITMAP_BITS = 27
#: Different pieces of one key that a task compares; keys with more go window by window.
GROUP_PIECES = 20_000
#: Pieces that a task compares at once, in whole keys.
CHUNK_PIECES = 20_000


def value_range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of values[start:end] for many ranges of 64-bit values."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_ODD, len(values)), out=sums[1:])
    back = powers(_INVERSE, len(values) + 1)
    return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def runs_of(place: np.ndarray, *labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts (as indexes) and lengths of the runs of consecutive places with equal labels."""
    if not len(place):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.diff(place) != 1
    for label in labels:
        new |= label[1:] != label[:-1]
    new = np.flatnonzero(new) + 1
    first = np.concatenate([[0], new])
    return first, np.diff(np.concatenate([first, [len(place)]]))


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, text: a document is known by the first two; rows that repeat both are one."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


#: Pieces of a text: start, number of windows, anchor's distance from the start, key, hash of the piece.
Pieces = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]
OCCURRENCE = "doc_id bigint, text_hash bigint, start bigint, n int, anchor int, key bigint, piece bigint"
PIECE = ["key", "piece"]
ROW = ["doc_id", "text_hash"]


def occurrences(docs: DataFrame, cut: Callable[[list[bytes]], Iterator[tuple[int, Pieces]]], wanted=None, bits: int = BITMAP_BITS) -> DataFrame:
    """All pieces of `docs`, or those whose key is in the bitmap `wanted`."""
    names = ["doc_id", "text_hash", "start", "n", "anchor", "key", "piece"]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for text, (start, n, anchor, key, piece) in cut(bytes_of(part.column("text"))):
                    if wanted is not None:
                        hit = in_bitmap(key, wanted.value, bits)
                        text, start, n, anchor, key, piece = (x[hit] for x in (text, start, n, anchor, key, piece))
                    owner = pa.array(text)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(owner), part.column("text_hash").take(owner),
                         pa.array(start.astype(np.int64)), pa.array(n.astype(np.int32)), pa.array(anchor.astype(np.int32)),
                         pa.array(key.view(np.int64)), pa.array(piece.view(np.int64))], names)

    return docs.mapInArrow(run, OCCURRENCE)


def same_row(left: DataFrame, right: DataFrame, id_name: str, hash_name: str):
    return left["doc_id"].eqNullSafe(right[id_name]) & (left["text_hash"] == right[hash_name])


def candidates(docs: DataFrame, cut) -> tuple[DataFrame, DataFrame]:
    """(all occurrences of pieces whose key occurs twice, the different pieces with their counts)."""
    keys = occurrences(docs, cut).select("key").groupBy("key").count().where("count > 1").select("key")
    keys = stored(keys, "repeated-keys")
    met = occurrences(docs, cut, bitmap_of(keys, "key", BITMAP_BITS)).join(keys, "key", "left_semi")
    met = stored(met, "occurrences")
    pieces = met.groupBy(*PIECE).agg(
        F.count("*").alias("times"), F.min(F.struct("doc_id", "start", "text_hash")).alias("first"),
        F.first("n").alias("n"), F.first("anchor").alias("anchor"),
    )
    return met, stored(pieces, "pieces")


def with_bodies(docs: DataFrame, pieces: DataFrame, window: int, body: Callable[[bytes], Callable[[int, int], bytes]]) -> DataFrame:
    """Pieces with their units (`body`), read from the text of their first occurrence. Where rows repeat
    in full, each gives its pieces."""
    wanted = pieces.groupBy(F.col("first.doc_id").alias("of_id"), F.col("first.text_hash").alias("of_hash")).agg(
        F.collect_list(F.struct("key", "piece", "times", F.col("first.start").alias("start"), "n", "anchor")).alias("wanted")
    )  # the pieces of one document
    joined = docs.join(wanted, same_row(docs, wanted, "of_id", "of_hash")).select("doc_id", "text_hash", "text", "wanted")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                take = body(bytes_of(row.column("text"))[0])
                doc_id, text_hash = row.column("doc_id")[0].as_py(), row.column("text_hash")[0].as_py()
                rows = row.column("wanted")[0].as_py()
                yield pa.RecordBatch.from_pydict(
                    {**{k: [r[k] for r in rows] for k in ("key", "piece", "times", "start", "n", "anchor")},
                     "doc_id": [doc_id] * len(rows), "text_hash": [text_hash] * len(rows),
                     "body": [take(r["start"], r["start"] + r["n"] + window - 1) for r in rows]},
                    pa.schema([("key", pa.int64()), ("piece", pa.int64()), ("times", pa.int64()), ("start", pa.int64()),
                               ("n", pa.int32()), ("anchor", pa.int32()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("body", pa.binary())]))

    return joined.mapInArrow(run, "key bigint, piece bigint, times bigint, start bigint, n int, anchor int, doc_id bigint, text_hash bigint, body binary")


def compared(bodies: DataFrame, compare: Callable[[dict], np.ndarray]) -> DataFrame:
    """key, piece, low, high: the windows of each piece that `compare` marks, as ranges.

    Keys are dealt out by hash and come in order, so that a task holds a bounded number of pieces. A piece
    that comes again, from a row repeated in full, is one piece.
    """
    dealt = bodies.repartition("key").sortWithinPartitions(*PIECE)

    def run(batches):
        held: list[dict] = []

        def flush(rows):
            key = np.array([r["key"] for r in rows], np.int64)
            marks = compare({
                "key": key, "n": np.array([r["n"] for r in rows], np.int64), "anchor": np.array([r["anchor"] for r in rows], np.int64),
                "doc_id": [r["doc_id"] for r in rows], "text_hash": np.array([r["text_hash"] for r in rows], np.int64),
                "start": np.array([r["start"] for r in rows], np.int64),
                "body": [r["body"] for r in rows]})
            owner, low, high = marks
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[owner]), pa.array(np.array([r["piece"] for r in rows], np.int64)[owner]),
                 pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], ["key", "piece", "low", "high"])

        before = None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["key"], row["piece"]) != before:
                    held.append(row)
                    before = row["key"], row["piece"]
            if len(held) >= CHUNK_PIECES:
                last = held[-1]["key"]
                whole = len(held)
                while whole and held[whole - 1]["key"] == last:
                    whole -= 1
                if whole:
                    yield from flush(held[:whole])
                    held = held[whole:]
        if held:
            yield from flush(held)

    return dealt.mapInArrow(run, "key bigint, piece bigint, low int, high int")


def window_by_window(bodies: DataFrame, window: int, width: int, earlier: bool) -> DataFrame:
    """What `compared` gives, for keys of too many different pieces: every window of their pieces is a
    row with a 128-bit name, and Spark counts them, or finds the first."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                body = np.frombuffer(row["body"], np.uint8)
                values = body.astype(np.uint64) + np.uint64(1) if width == 1 else np.frombuffer(row["body"], ">u8").astype(np.uint64)
                starts = np.arange(row["n"])
                one = value_range_hashes(mixed(values), starts, starts + window)
                two = value_range_hashes(mixed(values ^ np.uint64(0xABCDEF)), starts, starts + window)
                same = lambda v, k: pa.array([v] * len(starts), k)
                yield pa.RecordBatch.from_arrays(
                    [same(row["key"], pa.int64()), same(row["piece"], pa.int64()), pa.array(starts.astype(np.int32)),
                     same(row["doc_id"], pa.int64()), pa.array(row["start"] + starts), same(row["text_hash"], pa.int64()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))],
                    ["key", "piece", "low", "doc_id", "at", "text_hash", "one", "two"])

    windows = bodies.mapInArrow(run, "key bigint, piece bigint, low int, doc_id bigint, at bigint, text_hash bigint, one bigint, two bigint")
    windows = stored(windows, "windows-of-hot-keys")
    facts = windows.groupBy("one", "two").agg(F.count("*").alias("times"), F.min(F.struct("doc_id", "at", "text_hash")).alias("first"))
    joined = windows.join(facts.where("times > 1"), ["one", "two"])
    if earlier:
        joined = joined.where(F.struct("doc_id", "at", "text_hash") > F.col("first"))
    return joined.select("key", "piece", "low", (F.col("low") + 1).alias("high"))


def repeated_ranges(
    docs: DataFrame, cut, window: int, width: int, body, compare, earlier: bool, group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """doc_id, text_hash, ranges: the units of each document that repeated windows cover.

    Repeated means that the window occurs elsewhere too; with `earlier`, elsewhere before it.
    """
    met, pieces = candidates(docs, cut)
    several = pieces.groupBy("key").agg(F.count("*").alias("different")).where("different > 1")
    unclear = with_bodies(docs, pieces.join(several, "key"), window, body)
    unclear = stored(unclear.join(several, "key"), "unclear-pieces")
    marks = compared(unclear.where(F.col("different") <= group_pieces), compare)
    hot = unclear.where(F.col("different") > group_pieces)
    if not hot.isEmpty():
        marks = marks.unionByName(window_by_window(hot, window, width, earlier))
    own = marks.groupBy(*PIECE).agg(F.collect_list(F.struct("low", "high")).alias("marks"))  # of one piece
    judged = stored(pieces.join(own, PIECE, "left"), "judged-pieces")
    whole = F.array(F.struct(F.lit(0).alias("low"), F.col("n").alias("high")))
    if earlier:
        again = join_with_hot(met.select(*PIECE, *ROW, "start"), judged.select(*PIECE, "times", "first", "n", "marks"), PIECE, "times")
        same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("start") == F.col("first.start")) & (F.col("text_hash") == F.col("first.text_hash"))
        marked = again.withColumn("marks", F.when(same, F.col("marks")).otherwise(whole))
    else:
        settled = judged.withColumn("marks", F.when(F.col("times") > 1, whole).otherwise(F.col("marks")))
        settled = settled.where("marks is not null").select(*PIECE, "times", "marks")
        marked = join_with_hot(met.select(*PIECE, *ROW, "start"), settled, PIECE, "times")
    spans = marked.where("marks is not null").select(*ROW, F.transform("marks", lambda m: F.struct(
        (F.col("start") + m["low"]).alias("low"), (F.col("start") + m["high"] + (window - 1)).alias("high"))).alias("spans"))
    return spans.groupBy(*ROW).agg(F.flatten(F.collect_list("spans")).alias("ranges"))  # of one document


def union_of(ranges: np.ndarray) -> np.ndarray:
    """Sorted, disjoint and not adjacent ranges that cover the same places; `ranges` is (n, 2)."""
    if not len(ranges):
        return ranges.reshape(0, 2)
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    until = np.maximum.accumulate(ranges[:, 1])
    new = np.flatnonzero(ranges[1:, 0] > until[:-1]) + 1
    first = np.concatenate([[0], new])
    last = np.concatenate([new, [len(ranges)]]) - 1
    return np.stack([ranges[first, 0], until[last]], axis=1)


def applied(docs: DataFrame, found: DataFrame, work: Callable[[int | None, bytes, np.ndarray], dict], schema: pa.Schema, ddl: str) -> DataFrame:
    """`work` on each document with the union of its ranges."""
    found = found.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "ranges")
    joined = docs.join(found, same_row(docs, found, "of_id", "of_hash"), "left").select(
        "doc_id", "text", F.col("ranges.low").alias("low"), F.col("ranges.high").alias("high"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows = []
                for doc_id, text, low, high in zip(
                    part.column("doc_id").to_pylist(), bytes_of(part.column("text")), part.column("low"), part.column("high")
                ):
                    ranges = np.zeros((0, 2), np.int64)
                    if low.is_valid:
                        ranges = np.stack([low.values.to_numpy(), high.values.to_numpy()], axis=1)
                    rows.append(work(doc_id, text, union_of(ranges)))
                yield pa.RecordBatch.from_pylist(rows, schema)

    return joined.mapInArrow(run, ddl)
