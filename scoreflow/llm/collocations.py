"""Phrase mining on a weighted de Bruijn graph.

Every place of a text's piece gives one gram: its four words, or fewer where the piece ends or where the next
pair of words is too rare for any candidate. Four-word grams are the edges of the graph, between its nodes of
three words; shorter grams are corrections for pieces that end there. A node's count is the flow out of it, the
edges that begin with it, plus its corrections; two words and one word follow alike from the level above. So
only the longest grams are counted over the corpus.

Chains of edges without a branch, all of one weight, are compacted by pointer doubling: one row for a passage of
any length, and the phrases inside it are windows of that row. Edges in a circle stay single.

Words and pairs are taken for rare by `hashcounts`, whose counts are never too low. What a rare word or pair hides
are counts under the minimum, which no candidate, and no part of one, can have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoreflow.llm.common import _ODD, Words, byte_flags, bytes_of, map_batches, mixed, powers, stored, table
from scoreflow.llm.hashcounts import frequency_classes

MIN_COUNT = 30
TOP = 2000
MAX_WORDS = 4
#: A candidate goes if a longer one around it has so many hundredths of its count.
COVERED_PERCENT = 80
SCALE = 2_000_000
UNKNOWN = "und"
#: First places are chosen in so many parts of a language before they meet.
SALTS = 64

PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_BYTES = byte_flags(lambda b: b not in PIECE_ENDS and b not in b" \t")
ENDS = byte_flags(lambda b: b in PIECE_ENDS).astype(bool)


class Pieces(Words):
    """The words of lower-cased texts; `joined[i]` tells whether word i + 1 follows word i in the same piece."""

    def __init__(self, texts: list[bytes], langs: list[str | None]):
        super().__init__([t.lower() for t in texts], WORD_BYTES)
        names = sorted({UNKNOWN if x is None else x for x in langs})
        self.langs = [UNKNOWN if x is None else x for x in langs]
        numbers = {name: hash_of(name) for name in names}
        lang = np.array([numbers[x] for x in self.langs], np.uint64)
        self.lang_hash = lang[self.text] if len(self.text) else np.zeros(0, np.uint64)
        ended = np.concatenate([[0], np.cumsum(ENDS[self.data])])
        n = len(self.start)
        self.joined = np.zeros(n, bool)
        if n > 1:
            same = self.text[1:] == self.text[:-1]
            self.joined[:-1] = same & (ended[self.start[1:]] == ended[self.end[:-1]])

    def grams(self, length: int) -> np.ndarray:
        """Hashes of the language and the `length` words from each place on; the last places are not there."""
        n = max(len(self.hash) - length + 1, 0)
        total = self.lang_hash[:n] + np.uint64(length)
        for i, power in enumerate(powers(_ODD, length)):
            total = total + self.hash[i : i + n] * power
        return mixed(total)


def hash_of(name: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass"))


def pieces_in(batch: pa.RecordBatch) -> Pieces:
    return Pieces(bytes_of(batch.column("text")), batch.column("lang").to_pylist())


def word_and_pair_hashes(batch: pa.RecordBatch) -> np.ndarray:
    pieces = pieces_in(batch)
    pairs = pieces.grams(2)
    return np.concatenate([pieces.grams(1), pairs[pieces.joined[: len(pairs)]]])


def longest_grams(docs: DataFrame, min_count: int) -> DataFrame:
    """lang, words, size, count: the gram that begins at each place, and one row without words for each language
    with the number of all its words."""
    plain = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    classes = frequency_classes(plain, word_and_pair_hashes, (min_count,))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pieces = pieces_in(batch)
        n = len(pieces.hash)
        if not n:
            return
        pairs = pieces.grams(2)
        follows = np.zeros(n + MAX_WORDS, bool)
        follows[: len(pairs)] = pieces.joined[: len(pairs)] & (classes.of(pairs) > 0)
        size, on = np.ones(n, np.int64), np.ones(n, bool)
        for i in range(MAX_WORDS - 1):
            on = on & follows[i : i + n]
            size += on
        # A rare word is no part of any candidate.
        wanted = np.flatnonzero((size > 1) | (classes.of(pieces.grams(1)) > 0))
        gram = np.zeros(n, np.uint64)
        for length in range(1, MAX_WORDS + 1):
            own = wanted[size[wanted] == length]
            gram[own] = pieces.grams(length)[own]
        _, first, counts = np.unique(gram[wanted], return_index=True, return_counts=True)
        at = wanted[first]
        lengths = size[at]
        start, end = pieces.start[at].tolist(), pieces.end[at + lengths - 1].tolist()
        data = pieces.data.tobytes()
        words = [b" ".join(data[a:b].split(None) if k > 1 else [data[a:b]]) for a, b, k in zip(start, end, lengths.tolist())]
        langs = [pieces.langs[t] for t in pieces.text[at].tolist()]
        sums: dict[str, int] = {}
        for lang, count in zip(pieces.langs, pieces.count.tolist()):
            sums[lang] = sums.get(lang, 0) + count
        yield pa.RecordBatch.from_arrays(
            [pa.array([*langs, *sums], pa.string()),
             pa.array([*words, *[b""] * len(sums)], pa.binary()).cast(pa.string()),
             pa.array(np.concatenate([lengths, np.zeros(len(sums), np.int64)]).astype(np.int32)),
             pa.array(np.concatenate([counts, np.fromiter(sums.values(), np.int64, len(sums))]))],
            ["lang", "words", "size", "count"])

    found = map_batches(plain, work, "lang string, words string, size int, count bigint")
    return found.groupBy("lang", "words", "size").agg(F.sum("count").alias("count"))


def first_words(count: int) -> Column:
    return F.substring_index("words", " ", count)


def last_words(count: int) -> Column:
    return F.substring_index("words", " ", -count)


def flow_counts(grams: DataFrame, min_count: int) -> dict[int, DataFrame]:
    """(lang, words, count) of all phrases with `min_count` or more, by their number of words: the flow out of a node
    plus the pieces that end there."""
    level = grams.where(F.col("size") == MAX_WORDS).select("lang", "words", "count")
    out = {}
    for size in range(MAX_WORDS, 0, -1):
        if size < MAX_WORDS:
            ended = grams.where(F.col("size") == size).select("lang", "words", "count")
            level = level.select("lang", first_words(size).alias("words"), "count").unionByName(ended)
            level = stored(level.groupBy("lang", "words").agg(F.sum("count").alias("count")), f"flow-{size}")
        out[size] = level.where(F.col("count") >= min_count)
    return out


def unary_paths(edges: DataFrame) -> DataFrame:
    """lang, words (array), count: the edges (lang, words, count) of four words, compacted.

    Two edges are one path where the node between them has one edge in, one out, and both have the same weight.
    """
    joint = lambda words: edges.select("lang", words.alias("node"), F.col("words").alias("edge"), "count")
    def degree(rows, tag):
        return rows.groupBy("lang", "node").agg(
            F.count("*").alias(f"n_{tag}"), F.first("edge").alias(tag), F.first("count").alias(f"w_{tag}"))
    into, out = degree(joint(last_words(MAX_WORDS - 1)), "came"), degree(joint(first_words(MAX_WORDS - 1)), "went")
    plain = into.join(out, ["lang", "node"]).where(
        (F.col("n_came") == 1) & (F.col("n_went") == 1) & (F.col("w_came") == F.col("w_went")) & (F.col("came") != F.col("went")))
    before = plain.select("lang", F.col("went").alias("words"), F.col("came").alias("head"))
    # Every edge points to the one before it, or to itself at a path's head; pointers double until none moves.
    state = edges.select("lang", "words", "count").join(before, ["lang", "words"], "left").select(
        "lang", "words", "count", F.coalesce("head", "words").alias("head"), F.col("head").isNotNull().cast("bigint").alias("steps"))
    state = stored(state, "pointers")
    rounds = max(state.count(), 1).bit_length() + 1
    for _ in range(rounds):
        to = state.select("lang", F.col("words").alias("head"), F.col("head").alias("next"), F.col("steps").alias("more"))
        moved = state.join(to, ["lang", "head"])
        state = stored(moved.select(
            "lang", "words", "count", F.col("next").alias("head"), (F.col("steps") + F.col("more")).alias("steps"),
            (F.col("next") != F.col("head")).alias("moved")), "pointers")
        if state.where("moved").isEmpty():
            break
    # Pointers that still move run in circles.
    circle = F.col("moved") if "moved" in state.columns else F.lit(False)
    state = state.select(
        "lang", "words", "count", F.when(circle, F.col("words")).otherwise(F.col("head")).alias("head"),
        F.when(circle, F.lit(0)).otherwise(F.col("steps")).alias("steps"))
    paths = state.groupBy("lang", "head").agg(
        F.array_sort(F.collect_list(F.struct("steps", F.substring_index("words", " ", -1).alias("word")))).alias("chain"),
        F.first("count").alias("count"))
    words = F.concat(F.slice(F.split("head", " "), 1, MAX_WORDS - 1), F.transform("chain", lambda c: c["word"]))
    return paths.select("lang", words.alias("words"), "count")


def path_edges(paths: DataFrame) -> DataFrame:
    """lang, words, count: the windows of four words of compacted paths, which are the graph's edges again."""
    window = F.explode(F.transform(
        F.sequence(F.lit(1), F.size("words") - (MAX_WORDS - 1)), lambda i: F.array_join(F.slice("words", i, MAX_WORDS), " ")))
    return paths.select("lang", window.alias("words"), "count")


def scored(counts: dict[int, DataFrame]) -> DataFrame:
    """lang, phrase, a, l, r, score: all candidates at the cut that scores lowest, the first of equal ones."""
    every = stored(
        counts[1].withColumn("size", F.lit(1))
        .unionByName(counts[2].withColumn("size", F.lit(2)))
        .unionByName(counts[3].withColumn("size", F.lit(3)))
        .unionByName(counts[4].withColumn("size", F.lit(4))), "phrases")
    candidates = every.where("size > 1")
    place = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut")
    cuts = candidates.select("lang", F.col("words").alias("phrase"), F.col("count").alias("a"), "size", place).select(
        "lang", "phrase", "a", "cut", F.expr("substring_index(phrase, ' ', cut)").alias("left"),
        F.expr("substring_index(phrase, ' ', cut - size)").alias("right"))
    def parts(side, name):
        return every.select("lang", F.col("words").alias(side), F.col("count").alias(name))
    met = cuts.join(parts("left", "l"), ["lang", "left"]).join(parts("right", "r"), ["lang", "right"])
    score = F.expr(f"cast({SCALE} as decimal(7,0)) * cast(a as decimal(19,0)) div cast(l + r as decimal(20,0))")
    lowest = met.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    return lowest.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def covered(counts: dict[int, DataFrame], percent: int = COVERED_PERCENT) -> DataFrame:
    """lang, phrase: candidates that lie inside a longer candidate with enough of their count."""
    inside = None
    for size in (3, 4):
        for length in range(2, size):
            for start in range(1, size - length + 2):
                words = F.array_join(F.slice(F.split("words", " "), start, length), " ")
                rows = counts[size].select("lang", words.alias("words"), F.col("count").alias("longer"))
                inside = rows if inside is None else inside.unionByName(rows)
    most = inside.groupBy("lang", "words").agg(F.max("longer").alias("longer"))
    own = counts[2].unionByName(counts[3])
    wide = lambda number, name: F.lit(number).cast("decimal(3,0)") * F.col(name).cast("decimal(19,0)")
    return own.join(most, ["lang", "words"]).where(wide(100, "longer") >= wide(percent, "count")).select(
        "lang", F.col("words").alias("phrase"))


def phrases(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` phrases.

    Null texts are empty and null languages `und`; repeated rows count as often as they come; an empty table gives
    no rows; other columns are ignored. Equal scores and counts go by the phrase's UTF-8 bytes.
    """
    grams = stored(longest_grams(docs, min_count), "grams")
    counts = flow_counts(grams, min_count)
    counts[MAX_WORDS] = stored(path_edges(unary_paths(counts[MAX_WORDS])), "edges")
    totals = grams.where("size = 0").select("lang", F.col("count").alias("n"))
    kept = stored(scored(counts).join(covered(counts), ["lang", "phrase"], "left_anti"), "scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = kept.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order)))
    best = first.where(F.col("_place") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    best = best.where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases(table(spark, sf_dir, "documents"))
