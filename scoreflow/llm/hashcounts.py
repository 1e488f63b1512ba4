"""How often hashes occur in a corpus, as a broadcast table of frequency classes.

Tasks count their hashes in slabs and pack the counts by bucket (the hash's top bits); Spark brings each
bucket together and adds the counts up. What returns is a table of 2**bits bytes that holds, at a hash's
top bits, the highest class of any hash there: the number of thresholds its count reaches. Counts are kept
by 40 bits of the hash, so a class is never too low; it is too high where hashes share a place. Callers
must be right whatever the classes are: they may order and prune with classes that are upper bounds.

The number of hashes of class 1 or more chooses the table's size, up to 2**MAX_BITS bytes. Executors write its
parts to the shared scratch folder, and each Python worker reads them from there when it first needs them, so the
table never passes through the driver. A scratch folder that workers can't open as files is broadcast instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreflow.llm.common import pieces_of, stored

KEY_BITS = 40
SLAB = 1 << 21
MAX_BITS = 26
MIN_BITS = 16
_TOP = np.uint64(64 - KEY_BITS)
_BYTES = KEY_BITS // 8


def _packed(keys: np.ndarray) -> np.ndarray:
    """Keys as rows of five bytes."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_BYTES]


def _unpacked(data: bytes) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(-1, _BYTES)
    wide = np.zeros((len(rows), 8), np.uint8)
    wide[:, :_BYTES] = rows
    return wide.view("<u8").reshape(-1)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, place = np.unique(keys, return_inverse=True)
    return unique, np.bincount(place, counts, len(unique)).astype(np.int64)


def slot_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


#: The last table a worker read, by its folder.
_READ: dict[str, np.ndarray] = {}


def _local_folder(path: str) -> str | None:
    """`path` as a folder of this machine, or None where it lies on another file system."""
    found = urlparse(path)
    return found.path if found.scheme in ("", "file") else None


def _table_in(folder: str, bits: int, own: int) -> np.ndarray:
    """The table from its parts (bucket, part) in `folder`."""
    table = _READ.get(folder)
    if table is None:
        table = np.zeros(1 << bits, np.uint8)
        for batch in ds.dataset(folder, format="parquet").to_batches(columns=["bucket", "part"], batch_size=16):
            for bucket, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                table[bucket << own : (bucket + 1) << own] = np.frombuffer(part.as_py(), np.uint8)
        _READ.clear()
        _READ[folder] = table
    return table


class Classes:
    """The table, broadcast or in a shared folder (`own` bits a bucket); `of` gives the classes of an array of hashes."""

    def __init__(self, shared, bits: int, folder: str | None = None, own: int = 0):
        self.shared, self.bits, self.folder, self.own = shared, bits, folder, own

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if self.folder is not None:
            return _table_in(self.folder, self.bits, self.own)[slot_of(hashes, self.bits)]
        if self.shared is None:
            return np.zeros(len(hashes), np.uint8)
        return self.shared.value[slot_of(hashes, self.bits)]


def frequency_classes(
    df: DataFrame, hashes_of: Callable[[pa.RecordBatch], np.ndarray], thresholds: tuple[int, ...], max_bits: int = MAX_BITS
) -> Classes:
    """Classes of the hashes that `hashes_of` finds in slices of `df`; repeats count. An empty table has class 0
    everywhere."""
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    bucket_bits = min(max(parts.bit_length() + 2, 8), 14)
    names = ["bucket", "keys", "counts"]

    def packed(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        buckets = (keys >> np.uint64(KEY_BITS - bucket_bits)).astype(np.int64)
        at = np.flatnonzero(np.diff(buckets, prepend=-1))
        ends = [*at[1:].tolist(), len(keys)]
        raw, n = _packed(keys), np.minimum(counts, 0xFFFF).astype("<u2")
        return pa.RecordBatch.from_arrays(
            [pa.array(buckets[at].astype(np.int32)), pa.array([raw[a:b].tobytes() for a, b in zip(at.tolist(), ends)], pa.binary()),
             pa.array([n[a:b].tobytes() for a, b in zip(at.tolist(), ends)], pa.binary())], names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for piece in pieces_of(batch):
                hashes = hashes_of(piece)
                held.append(hashes >> _TOP)
                size += len(hashes)
                if size >= SLAB:
                    yield packed(*np.unique(np.concatenate(held), return_counts=True))
                    held, size = [], 0
        if size:
            yield packed(*np.unique(np.concatenate(held), return_counts=True))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Buckets come one after the other; a bucket's slabs are added up when its last one is there."""
        current, keys, counts = None, [], []

        def total() -> pa.RecordBatch:
            unique, n = _summed(np.concatenate(keys), np.concatenate(counts))
            often = n >= thresholds[0]
            classes = np.searchsorted(thresholds, n[often], "right").astype(np.uint8)
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int32()), pa.array([_packed(unique[often]).tobytes()], pa.binary()),
                 pa.array([classes.tobytes()], pa.binary()), pa.array([int(often.sum())], pa.int64())],
                ["bucket", "keys", "classes", "kept"])

        for batch in batches:
            for bucket, raw, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if bucket != current and keys:
                    yield total()
                    keys, counts = [], []
                current = bucket
                keys.append(_unpacked(raw.as_py()))
                counts.append(np.frombuffer(n.as_py(), "<u2"))
        if keys:
            yield total()

    counted = df.mapInArrow(count, "bucket int, keys binary, counts binary")
    dealt = counted.repartition(parts, "bucket").sortWithinPartitions("bucket")
    often = stored(dealt.mapInArrow(add, "bucket int, keys binary, classes binary, kept bigint"), "frequent-hashes")
    kept = often.agg(F.sum("kept")).head()[0] or 0
    bits = min(max((8 * kept).bit_length(), MIN_BITS), max(max_bits, MIN_BITS))
    own = bits - bucket_bits

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, raw, marks in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                place = (_unpacked(raw.as_py()) >> np.uint64(KEY_BITS - bits)).astype(np.int64) - (bucket << own)
                classes = np.frombuffer(marks.as_py(), np.uint8)
                table = np.zeros(1 << own, np.uint8)
                for c in range(1, len(thresholds) + 1):
                    table[place[classes == c]] = c
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int32()), pa.array([table.tobytes()], pa.binary())], ["bucket", "part"])

    parts_of = often.where("kept > 0").select("bucket", "keys", "classes").mapInArrow(segment, "bucket int, part binary")
    if not kept:
        return Classes(None, bits)
    stored_parts = stored(parts_of, "class-table")
    folder = _local_folder(stored_parts.inputFiles()[0].rsplit("/", 1)[0]) if stored_parts.inputFiles() else None
    if folder is not None:
        return Classes(None, bits, folder, own)
    whole = np.zeros(1 << bits, np.uint8)
    for row in stored_parts.collect():  # the table itself, 2**max_bits bytes at most
        whole[row["bucket"] << own : (row["bucket"] + 1) << own] = np.frombuffer(row["part"], np.uint8)
    return Classes(spark.sparkContext.broadcast(whole), bits)
