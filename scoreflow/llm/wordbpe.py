"""Word-level BPE: encoding and decoding with a public vocabulary whose words end in a marker.

Texts are cut at white space, normalised (NFC, lower case) and cut into letters, single digits and
other signs. A short word is merged in a contiguous rank array: its parts and the rank of every adjacent
pair stand side by side; the smallest rank is looked up, its boundary deleted and the two ranks
beside it refreshed. numpy does so for many words at once, a row each. That is quadratic in a word's
length, so a word of over LONG_WORD bytes takes a heap; both give the same parts. Workers remember
what they have encoded, up to a fixed number of words.

Two texts of equal words are the same to this vocabulary, so decoding gives the tokens joined by
spaces, as the vocabulary file names no decoder.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreflow.llm.common import map_batches, table, texts_of, worker_cache

LONG_WORD = 200
REMEMBERED = 300_000
NO_RANK = 1 << 30

#: Fixed value: the mark at the end of a word's last part.
WORD_END = "</w>"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    moved = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(moved)) for b in range(256)]


class Vocabulary:
    """Ids, merge ranks and special tokens of a vocabulary file; small, so it travels with the tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids, letters = spec["model"]["vocab"], byte_letters()
        self.inner = [ids[c] for c in letters]
        self.last = [ids[c + WORD_END] for c in letters]
        self.rank, self.merged = {}, []
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.rank[ids[a] << 20 | ids[b]] = rank
            self.merged.append(ids[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = word_pattern()
        tokens = {**ids, **self.special}
        self.tokens = [""] * (max(tokens.values()) + 1)
        for token, i in tokens.items():
            self.tokens[i] = token


class PairRanks:
    """Ranks of pairs of ids by array: an open table with linear probing."""

    BITS = 19

    def __init__(self, rank: dict[int, int]):
        self.keys = np.full(1 << self.BITS, -1, np.int64)
        self.ranks = np.full(1 << self.BITS, NO_RANK, np.int64)
        pairs = np.fromiter(rank.keys(), np.int64, len(rank))
        ranks = np.fromiter(rank.values(), np.int64, len(rank))
        slots = self.slot(pairs)
        self.probes = 1
        while len(pairs):
            free = self.keys[slots] < 0
            _, first = np.unique(slots, return_index=True)
            placed = np.zeros(len(pairs), bool)
            placed[first] = True
            placed &= free
            self.keys[slots[placed]], self.ranks[slots[placed]] = pairs[placed], ranks[placed]
            pairs, ranks = pairs[~placed], ranks[~placed]
            slots = (slots[~placed] + 1) & ((1 << self.BITS) - 1)
            self.probes += 1

    def slot(self, pairs: np.ndarray) -> np.ndarray:
        spread = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.BITS)).astype(np.int64)

    def __getitem__(self, pairs: np.ndarray) -> np.ndarray:
        slots = self.slot(pairs)
        out = np.where(self.keys[slots] == pairs, self.ranks[slots], NO_RANK)
        open_ = np.flatnonzero((self.keys[slots] != pairs) & (self.keys[slots] >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            slots[open_] = (slots[open_] + 1) & ((1 << self.BITS) - 1)
            here = self.keys[slots[open_]]
            hit = here == pairs[open_]
            out[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (here >= 0)]
        return out


def merge_rows(parts: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary, ranks_of: PairRanks) -> list[bytes]:
    """The merged ids of many short words at once: row i of `parts` has counts[i] ids.

    Each row is a contiguous rank array. A step finds every row's smallest rank, deletes that boundary
    in parts and ranks, and refreshes the ranks beside it; rows without a rank left are done.
    """
    n, width = parts.shape
    out: list[bytes] = [b""] * n
    rows = np.arange(n)
    places = np.arange(width)
    merged = np.array(vocabulary.merged, np.int64)
    ranks = np.full((n, width), NO_RANK, np.int64)
    pair = places[:-1] < counts[:, None] - 1
    ranks[:, :-1][pair] = ranks_of[(parts[:, :-1] << 20 | parts[:, 1:])[pair]]
    while len(rows):
        at = ranks.argmin(axis=1)
        every = np.arange(len(rows))
        best = ranks[every, at]
        done = best == NO_RANK
        if done.any():
            for i in np.flatnonzero(done):
                out[rows[i]] = parts[i, : counts[i]].astype("<u4").tobytes()
            left = ~done
            rows, parts, ranks, counts = rows[left], parts[left], ranks[left], counts[left]
            at, best = at[left], best[left]
            every = np.arange(len(rows))
            if not len(rows):
                break
        take = np.minimum(places + (places > at[:, None]), width - 1)
        parts = np.take_along_axis(parts, take, 1)
        take = np.minimum(places + (places >= at[:, None]), width - 1)
        ranks = np.take_along_axis(ranks, take, 1)
        ranks[:, -1] = NO_RANK
        parts[every, at] = merged[best]
        counts = counts - 1
        before = np.flatnonzero(at > 0)
        ranks[before, at[before] - 1] = ranks_of[parts[before, at[before] - 1] << 20 | parts[before, at[before]]]
        after = np.flatnonzero(at < counts - 1)
        ranks[after, at[after]] = ranks_of[parts[after, at[after]] << 20 | parts[after, at[after] + 1]]
    return out


def merge_words(words: list[bytes], vocabulary: Vocabulary, ranks_of: PairRanks) -> list[bytes]:
    """The ids of each word (not empty) as little-endian 32-bit bytes."""
    out: list[bytes] = [b""] * len(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    inner, last = np.array(vocabulary.inner, np.int64), np.array(vocabulary.last, np.int64)
    low = 0
    for width in (8, 12, 16, 24, 48, LONG_WORD):
        chosen = np.flatnonzero((sizes > low) & (sizes <= width))
        low = width
        for start in range(0, len(chosen), 8192):
            some = chosen[start : start + 8192]
            counts = sizes[some]
            data = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in some), np.uint8).reshape(-1, width)
            parts = inner[data]
            parts[np.arange(len(some)), counts - 1] = last[data[np.arange(len(some)), counts - 1]]
            for i, ids in zip(some, merge_rows(parts, counts, vocabulary, ranks_of)):
                out[i] = ids
    for i in np.flatnonzero(sizes > LONG_WORD):
        parts = [vocabulary.inner[b] for b in words[i][:-1]] + [vocabulary.last[words[i][-1]]]
        out[i] = np.array(merge_long(parts, vocabulary), "<u4").tobytes()
    return out


def merge_long(parts: list[int], vocabulary: Vocabulary) -> list[int]:
    """The same merges in O(n log n), with links between the parts left."""
    rank_of, n = vocabulary.rank.get, len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (rank := rank_of(parts[i] << 20 | parts[j], NO_RANK)) != NO_RANK:
            heapq.heappush(heap, (rank, i, parts[i], j, parts[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        rank, i, left, j, right = heapq.heappop(heap)
        if parts[i] != left or after[i] != j or parts[j] != right:
            continue
        parts[i], parts[j] = vocabulary.merged[rank], -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        after[j] = n + 1
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [p for p in parts if p >= 0]


def word_pattern() -> str:
    """The vocabulary's cutting of a text into words. Which code points are letters and numbers is asked of the
    tokenizers library, whose Unicode tables are not Python's."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    every = "".join(map(chr, points.tolist()))

    def ranges(kind: str) -> str:
        found = Split(Regex(f"[\\p{{{kind}}}]+"), "removed", invert=True).pre_tokenize_str(every)
        return "".join(f"\\U{ord(run[0]):08x}-\\U{ord(run[-1]):08x}" for run, _ in found)

    letters, numbers = ranges("L"), ranges("N")
    spaces = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    return f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+"


def library_normalizer():
    """Composed and lower-cased letter by letter, by the library's tables."""
    from tokenizers.normalizers import NFC, Lowercase, Sequence

    return Sequence([NFC(), Lowercase()]).normalize_str


class Encoder:
    """Encodes texts in groups; remembers chunks between white space and words, up to REMEMBERED each."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.ranks_of = PairRanks(vocabulary.rank)
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.find = re.compile(vocabulary.pattern).findall
        self.normalized = library_normalizer()
        self.special = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")") if vocabulary.special else None
        # str.split() also cuts at these four; to the vocabulary they are signs.
        self.odd = re.compile("[\x1c-\x1f]").search
        self.spaces = re.compile(r"[^\S\x1c-\x1f]+").split

    def split(self, text: str) -> list[str]:
        return list(filter(None, self.spaces(text))) if self.odd(text) else text.split()

    def learn(self, chunks: set[str]) -> None:
        """Puts these chunks, and the words in them, into memory."""
        cut = {}
        for chunk in chunks:
            cut[chunk] = self.find(chunk.lower() if chunk.isascii() else self.normalized(chunk))
        words = list({w for found in cut.values() for w in found if w not in self.words})
        coded = merge_words([w.encode("utf-8") for w in words], self.vocabulary, self.ranks_of)
        self.words.update(zip(words, coded))
        ids = self.words.__getitem__
        for chunk, found in cut.items():
            self.chunks[chunk] = ids(found[0]) if len(found) == 1 else b"".join(map(ids, found))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit bytes."""
        if len(self.chunks) > REMEMBERED:
            self.chunks.clear()
        if len(self.words) > REMEMBERED:
            self.words.clear()
        special = self.vocabulary.special
        parts = []  # of each text: lists of chunks, or the id of a special token
        for text in texts:
            if self.special is None or not self.special.search(text):
                parts.append([self.split(text)])
            else:
                parts.append([special[p] if p in special else self.split(p) for p in self.special.split(text)])
        unknown: set[str] = set()
        for part in parts:
            for chunks in part:
                if isinstance(chunks, list):
                    unknown.update(filterfalse(self.chunks.__contains__, chunks))
        self.learn(unknown)
        ids = self.chunks.__getitem__
        return [
            b"".join(b"".join(map(ids, c)) if isinstance(c, list) else c.to_bytes(4, "little") for c in part)
            for part in parts
        ]

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def groups(texts: list[str], chars: int = 4_000_000) -> Iterator[list[str]]:
    """The texts in groups of about so many characters."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def encoder_of(shared) -> Encoder:
    """The worker's encoder for a broadcast vocabulary; words it knows outlive a task."""
    cache = worker_cache("wordbpe")
    if shared.id not in cache:
        cache.clear()
        cache[shared.id] = Encoder(shared.value[0])
    return cache[shared.id]


class SharedVocabulary:
    """A vocabulary (a file of a few MB) as a broadcast, with a name for the worker's memory of it."""

    def __init__(self, spark: SparkSession, path: str):
        self.broadcast = spark.sparkContext.broadcast([Vocabulary(path)])
        self.id = path

    @property
    def value(self):
        return self.broadcast.value


REPORT = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
])


def round_trip_column(text: Column, shared: SharedVocabulary) -> Column:
    """n_tokens, ids_sha256, decoded_sha256 of each text, encoded and decoded again."""

    def run(batch: pa.Array) -> pa.Array:
        encoder = encoder_of(shared)
        rows = []
        for ids in (x for some in groups(texts_of(batch)) for x in encoder.encode(some)):
            decoded = encoder.decode(ids).encode("utf-8", "replace")
            rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        kinds = (pa.int64(), pa.string(), pa.string())
        columns = list(zip(*rows)) or [[], [], []]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], REPORT.names)

    return F.arrow_udf(run, REPORT)(text.cast("string"))


def token_report(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: one row for each row of `docs` (doc_id, text).

    Null and empty texts have no tokens and the hashes of nothing; repeated rows stay; an empty table
    gives no rows; other columns are ignored.
    """
    shared = SharedVocabulary(docs.sparkSession, path)
    return docs.select("doc_id", round_trip_column(F.col("text"), shared).alias("_r")).select("doc_id", "_r.*")


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (array<int>), decoded: what the pipeline hands on; a null text is empty."""
    shared = SharedVocabulary(docs.sparkSession, path)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared)
        start = 0
        for some in groups(texts_of(batch.column("text"))):
            coded = encoder.encode(some)
            sizes = np.fromiter((len(x) // 4 for x in coded), np.int64, len(coded))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), "<i4"), pa.int32()))
            decoded = pa.array(map(encoder.decode, coded), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(start, len(some)), pa.array(sizes), ids, decoded], ["doc_id", "n_tokens", "ids", "decoded"])
            start += len(some)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return map_batches(plain, work, f"doc_id {id_type}, n_tokens bigint, ids array<int>, decoded string")


def word_vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_report(table(spark, sf_dir, "documents"), word_vocabulary_path())
