"""Token ids in binary files: frequency-ranked ids in byte-aligned variable-length coding.

Documents are dealt out by ranges of doc_id and encoded in order. A token's id in the files is its
rank by frequency over all documents, so common tokens take one byte. Each group of four ranks has
its four lengths in one control byte; control bytes stand apart from the data bytes, and a reader
finds all lengths by one table lookup.

The file format is a folder. `ranks` has the id of every rank. `blocks` is a Parquet table, split by
`shard` (ascending ranges of doc_id), whose rows are numbered blocks in ascending order: doc_ids and
their numbers of tokens, control bytes, data bytes. Spark's writers commit it, so a lost executor
leaves no half file, and any file system that Spark reads will do.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoreflow.llm.common import map_batches, table, worker_cache
from scoreflow.session import scratch_path

END_ID = 2
BLOCK_TOKENS = 1 << 19
#: Chunks that a worker remembers, and their ids together; some 60 bytes a chunk.
REMEMBERED = 1_000_000
REMEMBERED_IDS = 8 * REMEMBERED
#: New chunks that go through the library as one text.
TOGETHER = 500
#: Bytes of texts that are encoded at once; a longer text is alone.
SLICE_BYTES = 1 << 23


def gathered(ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """ids[start : start + size] of many ranges, one behind the other."""
    ends = np.cumsum(size)
    return ids[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


class ByteEncoder:
    """Whole texts through the tokenizers library, each distinct chunk once.

    A single space or line feed between two signs always begins a token of the byte-level pattern, so
    the chunks before and after it can be encoded on their own. Texts are cut, and equal chunks of a slice
    meet, in Arrow; what a chunk's ids are is looked up once a slice. New chunks go through the library
    together, as one text that is cut again where tokens begin with white space. Texts with other
    white space, with two in a row or with a special token go through the library whole.
    """

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # A chunk that cannot stand alone: nothing, a line feed alone, other white space, a special token.
        self.odd = re.compile("|".join([r"\A\Z", r"\A\n\Z", r"[^\S\n]", r"[\x1c-\x1f]", *map(re.escape, special)])).search
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.signs = pa.array(list(".,;:!?"))
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for token, i in vocabulary.items() if token[0] in "\u0120\u010a"]] = True
        #: Chunks without their space, in the order of their numbers, which begin behind 0 and the signs. 0 has no ids.
        self.names = pa.array([], pa.string())
        #: Ids of all numbers, one number behind the other; where each begins, how many it has, in how many slices it came.
        self.ids = np.zeros(0, "<u4")
        self.start, self.size, self.seen = (np.zeros(1, np.int64) for _ in range(3))
        signs = self.library(self.signs.to_pylist())
        self.add(np.concatenate(signs), np.array([len(x) for x in signs]))
        self.fixed = len(self.start)

    def library(self, texts: list[str]) -> list[np.ndarray]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(c.ids, "<u4") for c in coded]

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Numbers of new ranges of ids."""
        first = len(self.start)
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.seen = np.concatenate([self.seen, np.zeros(len(sizes), np.int64)])
        self.ids = np.concatenate([self.ids, ids])
        return np.arange(first, len(self.start))

    def forget(self) -> None:
        """Leaves the chunks that came in several slices since the last time, if they are not too many."""
        stays = self.seen > 1
        if stays.sum() > REMEMBERED // 2 or self.size[stays].sum() > REMEMBERED_IDS // 2:
            stays[:] = False
        stays[: self.fixed] = True
        self.names = self.names.filter(pa.array(stays[self.fixed :]))
        size = self.size[stays]
        self.ids = gathered(self.ids, self.start[stays], size)
        self.start, self.size, self.seen = np.cumsum(size) - size, size, np.zeros(len(size), np.int64)

    def learn(self, names: pa.Array) -> np.ndarray:
        """Numbers of new chunks."""
        chunks, alone = names.to_pylist(), np.ones(len(names), bool)
        # One look at all chunks together finds most often that there is nothing to look for in each.
        if "" in chunks or "\n" in chunks or self.odd("".join(chunks)):
            alone = np.array([not self.odd(chunk) for chunk in chunks], bool)
            chunks = [chunk for chunk in chunks if not self.odd(chunk)]
        found, sizes = [np.zeros(0, "<u4")], []
        for start in range(0, len(chunks), TOGETHER):
            group = chunks[start : start + TOGETHER]
            spaced = [n if n[0] == "\n" else f" {n}" for n in group]
            ids = self.library(["".join(spaced)])[0]
            bounds = np.append(np.flatnonzero(self.begins[ids]), len(ids))
            if len(bounds) == len(group) + 1:
                found.append(ids)
                sizes += np.diff(bounds).tolist()
            else:  # another vocabulary than the pattern allows for
                found += (coded := self.library(spaced))
                sizes += map(len, coded)
        out = np.zeros(len(names), np.int64)
        out[alone] = self.add(np.concatenate(found), np.array(sizes, np.int64))
        self.names = pa.concat_arrays([self.names, names.filter(pa.array(alone))])
        return out

    def numbers_of(self, names: pa.Array) -> np.ndarray:
        """The number of each of the distinct chunks `names`; 0 is any that cannot stand alone."""
        if len(self.names) > REMEMBERED or max(len(self.ids), self.names.nbytes // 8) > REMEMBERED_IDS:
            self.forget()
        out = pc.fill_null(pc.index_in(names, value_set=self.names), -1).to_numpy().astype(np.int64) + self.fixed
        new = np.flatnonzero(out < self.fixed)
        if len(new):
            out[new] = self.learn(names.take(pa.array(new)))
        self.seen[out] += 1
        return out

    def ids_of(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct chunks, one behind the other, how many each has, and which can stand alone."""
        # A sign after a letter is a token of its own before white space, so only what precedes it is looked up.
        signed = pc.match_substring_regex(names, r"[A-Za-z][.,;:!?]\z")
        bare = pc.if_else(signed, pc.utf8_slice_codeunits(names, 0, -1), names).dictionary_encode()
        last = pc.index_in(pc.utf8_slice_codeunits(names, -1), value_set=self.signs)
        sign = np.where(signed.to_numpy(zero_copy_only=False), pc.fill_null(last, 0).to_numpy() + 1, 0)
        number = self.numbers_of(bare.dictionary)[bare.indices.to_numpy()]
        parts = np.stack([number, sign], axis=1)
        size = self.size[parts]
        return gathered(self.ids, self.start[parts].ravel(), size.ravel()), size.sum(axis=1), number > 0

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (strings, no nulls), one text behind the other, and how many each has; `end_id`, if
        given, comes behind each text."""
        # A chunk keeps the line feed before it; a space is left out of its name.
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        offsets = cut.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        named = cut.flatten().dictionary_encode()
        codes, names = named.indices.to_numpy(), named.dictionary
        heads, text = offsets[:-1], np.repeat(np.arange(len(texts)), np.diff(offsets))
        inner = np.ones(len(codes), bool)
        inner[heads] = False
        # Only what stands behind a space is looked up, so that a text without any is not encoded twice.
        wanted = np.zeros(len(names), bool)
        wanted[codes[inner]] = True
        ids, sizes, alone = self.ids_of(names.filter(pa.array(wanted)))
        place = np.cumsum(wanted) - 1
        chunk = place[codes]
        first = names.take(pa.array(codes[heads])).to_pylist()
        whole = np.array([head != "" and bool(self.odd(head)) for head in first], bool)
        if not alone.all():
            whole[text[inner & ~alone[chunk]]] = True
        own = self.library([texts[i].as_py() if w else head for i, (w, head) in enumerate(zip(whole.tolist(), first))])
        chunk[heads] = 0
        starts = np.cumsum(sizes) - sizes
        start, size = (x[chunk] if len(x) else np.zeros(len(chunk), np.int64) for x in (starts, sizes))
        if whole.any():
            size[whole[text]] = 0
        size[heads] = [len(x) for x in own]
        start[heads] = len(ids) + np.cumsum(size[heads]) - size[heads]
        pool = np.concatenate([ids, *own, np.array([] if end_id is None else [end_id], "<u4")])
        if end_id is not None:
            start, size = np.insert(start, offsets[1:], len(pool) - 1), np.insert(size, offsets[1:], 1)
            offsets = offsets + np.arange(len(offsets))
        before = np.concatenate([[0], np.cumsum(size)])
        return gathered(pool, start, size), np.diff(before[offsets])


def byte_encoder(shared) -> ByteEncoder:
    """The worker's encoder of a broadcast vocabulary file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    cache = worker_cache("tokenfiles")
    key = shared.value[0]
    if key not in cache:
        cache.clear()
        cache[key] = ByteEncoder(shared.value[1])
    return cache[key]


LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.int64)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = values.astype("<u4")
    lengths = 1 + (values >= 1 << 8).astype(np.uint8) + (values >= 1 << 16) + (values >= 1 << 24)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = lengths - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < lengths[:, None]]
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    places = np.cumsum(lengths) - lengths
    raw = np.frombuffer(data, np.uint8)
    values = raw[places].astype(np.uint32)
    for i in (1, 2, 3):
        longer = np.flatnonzero(lengths > i)
        values[longer] |= raw[places[longer] + i].astype(np.uint32) << np.uint32(8 * i)
    return values


def byte_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of some SLICE_BYTES of `text` each."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def encoded_blocks(docs: DataFrame, tokenizer_path: str, end_id: int, shards: int) -> DataFrame:
    """Blocks of documents in ascending doc_id order with plain ids, and a row of id counts for each shard."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast([tokenizer_path, file.read()])
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ordered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text).repartitionByRange(shards, "doc_id")
    # Rows that share a doc_id go by their texts, which are compared for those alone.
    ordered = ordered.sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, block = byte_encoder(shared), TaskContext.get().partitionId(), 0
        counts = np.zeros(1 << 16, np.int64)
        parts, tokens = [], 0

        def flush():
            nonlocal parts, tokens, block, counts
            doc_ids, lengths, ids = zip(*parts)
            joined = np.concatenate(ids)
            found = np.bincount(joined, minlength=len(counts))
            found[: len(counts)] += counts
            counts = found
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in map(pa.concat_arrays, (doc_ids, lengths))]
            row = [pa.array([shard], kinds[0]), pa.array([block], kinds[1]), *lists, pa.array([joined.tobytes()]), pa.nulls(1, kinds[5])]
            parts, tokens, block = [], 0, block + 1
            return pa.RecordBatch.from_arrays(row, names)

        for piece in (p for batch in batches for p in byte_slices(batch)):
            doc_ids = piece.column("doc_id")
            ids, lengths = encoder.encode(piece.column("text").cast(pa.string()), end_id)
            ends, done, at = np.cumsum(lengths), 0, 0
            while done < len(ends):
                # A block ends with the document that fills it.
                stop = min(int(np.searchsorted(ends, at + BLOCK_TOKENS - tokens)) + 1, len(ends))
                until = int(ends[stop - 1])
                parts.append((doc_ids.slice(done, stop - done), pa.array(lengths[done:stop], pa.int64()), ids[at:until]))
                tokens, done, at = tokens + until - at, stop, until
                if tokens >= BLOCK_TOKENS:
                    yield flush()
        if parts:
            yield flush()
        if block:
            row = [[shard], [None], [None], [None], [None], [counts.astype("<i8").tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names)

    kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
    names = ["shard", "block", "doc_ids", "lengths", "ids", "counts"]
    schema = "shard int, block int, doc_ids array<bigint>, lengths array<bigint>, ids binary, counts binary"
    return ordered.mapInArrow(run, schema)


def rank_table(blocks: DataFrame) -> DataFrame:
    """id, seen, rank over all shards; ids that never occur have no rank."""

    def spread(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for data in batch.column(0).to_pylist():
            counts = np.frombuffer(data, "<i8")
            longer, shorter = (counts, total) if len(counts) > len(total) else (total, counts)
            total = longer.copy()
            total[: len(shorter)] += shorter
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "seen"])

    seen = map_batches(blocks.where("counts is not null").select("counts"), spread, "id bigint, seen bigint")
    seen = seen.groupBy("id").agg(F.sum("seen").alias("seen"))
    return seen.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("seen"), "id")) - 1)  # one row for each token of the vocabulary


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, shards: int | None = None) -> None:
    """Writes the token files of `docs` (doc_id, text) into the folder `path`.

    Null texts are empty and have the end id alone; rows with a null doc_id come first; rows that
    repeat a doc_id stand side by side; other columns are ignored.
    """
    spark = docs.sparkSession
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    plain = scratch_path(spark, "plain-ids")
    encoded_blocks(docs, tokenizer_path, end_id, shards).write.option("compression", "zstd").parquet(plain)
    blocks = spark.read.parquet(plain)
    rank_table(blocks).write.parquet(f"{path}/ranks")
    ranked = spark.read.parquet(f"{path}/ranks").collect()  # the vocabulary at most
    of_id = np.zeros(max([r["id"] for r in ranked], default=0) + 1, np.uint32)
    for r in ranked:
        of_id[r["id"]] = r["rank"]
    shared = spark.sparkContext.broadcast(of_id)

    def code(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            control, data = pack(shared.value[np.frombuffer(row.column("ids")[0].as_py(), "<u4")])
            yield pa.RecordBatch.from_arrays(
                [*(row.column(n) for n in ("shard", "block", "doc_ids", "lengths")), pa.array([control]), pa.array([data])],
                ["shard", "block", "doc_ids", "lengths", "control", "data"])

    coded = map_batches(blocks.where("ids is not null").select("shard", "block", "doc_ids", "lengths", "ids"), code,
                        "shard int, block int, doc_ids array<bigint>, lengths array<bigint>, control binary, data binary")
    coded.write.partitionBy("shard").parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian 32-bit bytes) of the files in `path`, one row for each
    document; start is the number of ids before it."""
    blocks = spark.read.schema(
        "block int, doc_ids array<bigint>, lengths array<bigint>, control binary, data binary, shard int"
    ).parquet(f"{path}/blocks")
    ranked = spark.read.parquet(f"{path}/ranks").collect()  # the vocabulary at most
    id_of = np.zeros(len(ranked), np.uint32)
    for r in ranked:
        id_of[r["rank"]] = r["id"]
    shared = spark.sparkContext.broadcast(id_of)
    total = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x)
    sizes = blocks.select("shard", "block", total.alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("n"))  # one row for each shard
    shards = shards.select("shard", before(Window.orderBy("shard")).alias("shard_start"))
    starts = sizes.withColumn("in_shard", before(Window.partitionBy("shard").orderBy("block"))).join(shards, "shard")
    starts = starts.select("shard", "block", (F.col("shard_start") + F.col("in_shard")).alias("start"))

    def decode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            lengths = np.array(row["lengths"], np.int64)
            ends = np.cumsum(lengths)
            ids = shared.value[unpack(row["control"], row["data"], int(lengths.sum()))].astype("<u4").tobytes()
            starts = ends - lengths
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + starts), pa.array(lengths),
                 pa.array([ids[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())], pa.binary())],
                ["doc_id", "start", "n_tokens", "ids"])

    placed = blocks.join(starts, ["shard", "block"])
    return map_batches(placed, decode, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def byte_vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, byte_vocabulary_path())
    read = read_token_files(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
