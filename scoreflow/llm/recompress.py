"""Long repeats over words, found by recompression.

The words of all documents are rewritten in rounds: a maximal run of one symbol becomes one symbol,
then, with all symbols split into left and right ones by their names, each left one followed by a
right one becomes one symbol. A new symbol is named by a 64-bit hash of what it stands for, so every
task of every round gives equal things equal names without asking; Spark then counts the names.

A symbol depends on the words it stands for and on few around, and each symbol keeps exactly which.
If they all lie in a window, every other occurrence of the window has the same symbol at the same
place. So each window of 20 words is filed under one such symbol, by the name of all the words that
decide about it. Names that two places share reveal windows that may be equal; the windows' own words
verify it. A window without such a symbol, as in one word repeated, is filed under itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from scoreflow.llm.common import NO_SPACE, Words, mixed, table
from scoreflow.llm.repeats import Pieces, applied, identified, repeated_ranges, runs_of, value_range_hashes

WINDOW = 20
ROUNDS = 3
#: Words that decide about a symbol, at least and at most, for it to be preferred.
FEW, MANY = 7, 11
#: Words worked on at once.
GROUP_WORDS = 1 << 18
FAR = 1 << 40


class Symbols:
    """A sequence of symbols: name, text, first and last word, and the words that decide about it."""

    def __init__(self, name, text, first, last, low, high):
        self.name, self.text, self.first, self.last, self.low, self.high = name, text, first, last, low, high

    def after(self, values: np.ndarray, fill: int) -> np.ndarray:
        """The next symbol's value in the same text; `fill` at its end."""
        out = np.full(len(values), fill, np.int64)
        if len(values) > 1:
            out[:-1] = np.where(self.text[1:] == self.text[:-1], values[1:], fill)
        return out

    def before(self, values: np.ndarray, fill: int) -> np.ndarray:
        out = np.full(len(values), fill, np.int64)
        if len(values) > 1:
            out[1:] = np.where(self.text[1:] == self.text[:-1], values[:-1], fill)
        return out


def join_runs(s: Symbols) -> Symbols:
    if not len(s.name):
        return s
    start = np.flatnonzero(np.concatenate([[True], (s.name[1:] != s.name[:-1]) | (s.text[1:] != s.text[:-1])]))
    end = np.concatenate([start[1:], [len(s.name)]]) - 1
    length = (end - start + 1).astype(np.uint64)
    # That a run ends depends on the symbols at both sides, and so on all that they depend on; where the
    # text ends, on more than words.
    low = np.minimum.reduceat(np.minimum(s.low, np.minimum(s.before(s.low, -FAR), s.after(s.low, FAR))), start)
    high = np.maximum.reduceat(np.maximum(s.high, np.maximum(s.before(s.high, -FAR), s.after(s.high, FAR))), start)
    name = np.where(length > 1, mixed(s.name[start] + length * np.uint64(0x9E3779B97F4A7C15)), s.name[start])
    return Symbols(name, s.text[start], s.first[start], s.last[end], low, high)


def join_pairs(s: Symbols, round_: int) -> Symbols:
    if not len(s.name):
        return s
    is_left = (mixed(s.name + np.uint64(round_)) & np.uint64(1)) == 0
    next_right = s.after((~is_left).astype(np.int64), 0) == 1
    opens = is_left & next_right
    closes = np.concatenate([[False], opens[:-1]])
    # A left symbol that stays alone depends on the one after it, a right one on the one before.
    low = np.where(is_left, np.minimum(s.low, s.after(s.low, FAR)), np.minimum(s.low, s.before(s.low, -FAR)))
    high = np.where(is_left, np.maximum(s.high, s.after(s.high, FAR)), np.maximum(s.high, s.before(s.high, -FAR)))
    name = s.name.copy()
    pair = np.flatnonzero(opens)
    name[pair] = mixed(s.name[pair] * np.uint64(0xD6E8FEB86659FD93) + s.name[pair + 1] + np.uint64(round_))
    last = s.last.copy()
    last[pair] = s.last[pair + 1]
    low[pair] = np.minimum(s.low[pair], s.low[pair + 1])
    high[pair] = np.maximum(s.high[pair], s.high[pair + 1])
    keep = ~closes
    return Symbols(name[keep], s.text[keep], s.first[keep], last[keep], low[keep], high[keep])


def anchors(name: np.ndarray, text: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """For the window that starts at each word: the first word of the symbol it is filed under, or -1, and
    the name. `text` tells which words belong together."""
    n = len(name)
    place = np.arange(n)
    s = Symbols(name, text, place, place + 1, place, place + 1)
    best = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    at = np.full(n, FAR, np.int64)
    for round_ in range(1, rounds + 1):
        s = join_pairs(join_runs(s), round_)
        inside = np.flatnonzero((s.low >= 0) & (s.high - s.low <= window) & (s.high <= n))
        if not len(inside):
            break
        # Symbols that stand on a middling number of words come first: fewer are common, more lie in few
        # windows. Then the smallest name of all those words, then the leftmost.
        words = (s.high - s.low)[inside]
        preferred = np.select([(words >= FEW) & (words <= MANY), words > MANY], [0, 1], 2).astype(np.uint64)
        content = value_range_hashes(name, s.low[inside], s.high[inside])
        rank = (preferred << np.uint64(62)) | (content >> np.uint64(2))
        first, low, high = s.first[inside], np.maximum(s.high[inside] - window, 0), s.low[inside]
        order = np.lexsort((-first, ~rank))  # the best is written last
        rank, first, low, high = rank[order], first[order], low[order], high[order]
        # Every symbol writes its number at each place it covers, at most a window of them, in one go; the
        # last (best) write wins.
        length = np.clip(high - low + 1, 0, window)
        total = int(length.sum())
        if not total:
            continue
        origin = np.repeat(np.cumsum(length) - length - low, length)
        to = np.arange(total) - origin
        which = np.full(n, -1, np.int64)
        which[to] = np.repeat(np.arange(len(rank)), length)
        covered = np.flatnonzero(which >= 0)
        winner = which[covered]
        here, where = rank[winner], first[winner]
        was, was_at = best[covered], at[covered]
        better = (here < was) | ((here == was) & (where < was_at))
        best[covered[better]], at[covered[better]] = here[better], where[better]
    return np.where(at < FAR, at, -1), best


def groups(texts: list[bytes], window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text number, place in the text and name of words, some GROUP_WORDS at a time. A long text comes in
    parts that overlap by a window less one; `-1` ends each part."""
    held, size = [], 0
    for i, text in enumerate(texts):
        words = Words([text], NO_SPACE).hash
        for at in range(0, max(len(words) - window + 1, 0), GROUP_WORDS):
            part = words[at : at + GROUP_WORDS + window - 1]
            held.append((i, at, part))
            size += len(part)
            if size >= GROUP_WORDS:
                yield held
                held, size = [], 0
    if held:
        yield held


def cut(texts: list[bytes], window: int = WINDOW) -> Iterator[tuple[np.ndarray, Pieces]]:
    for held in groups(texts, window):
        sizes = np.array([len(p) for _, _, p in held])
        name = np.concatenate([p for _, _, p in held])
        part = np.repeat(np.arange(len(held)), sizes)
        origin = np.cumsum(sizes) - sizes
        place = np.flatnonzero(np.concatenate([part[window - 1 :] == part[: len(part) - window + 1], np.zeros(window - 1, bool)]))
        at, rank = anchors(name, part, window)
        at, rank = at[place], rank[place]
        alone = at < 0
        own = value_range_hashes(name, place, place + window)
        key = np.where(alone, mixed(own + np.uint64(1)), mixed(rank + np.uint64(2)))
        at = np.where(alone, place, at)
        first, n = runs_of(place, at, key)
        start, anchor, key = place[first], at[first], key[first]
        piece = mixed(value_range_hashes(name, start, start + n + window - 1) + (anchor - start).astype(np.uint64))
        owner = part[start]
        shift = np.array([a for _, a, _ in held])[owner] - origin[owner]
        yield np.array([i for i, _, _ in held])[owner], (start + shift, n, anchor - start, key, piece)


def body(text: bytes):
    names = Words([text], NO_SPACE).hash.astype(">u8")
    return lambda start, end: names[start:end].tobytes()


def compare(rows: dict, window: int = WINDOW):
    """The ranges of windows that occur earlier in another piece of the same key."""
    n = rows["n"]
    values = np.frombuffer(b"".join(rows["body"]), ">u8").astype(np.uint64)
    sizes = n + window - 1
    origin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    one = value_range_hashes(mixed(values), origin[owner] + inside, origin[owner] + inside + window)
    two = value_range_hashes(mixed(values ^ np.uint64(0xABCDEF)), origin[owner] + inside, origin[owner] + inside + window)
    known = np.array([-(1 << 62) if d is None else d for d in rows["doc_id"]], np.int64)
    order = np.lexsort((rows["text_hash"][owner], rows["start"][owner] + inside, known[owner], two, one, rows["key"][owner]))
    same = np.concatenate([[False], (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
                           & (rows["key"][owner][order][1:] == rows["key"][owner][order][:-1])])
    hit = np.sort(order[same])
    first, length = runs_of(hit, owner[hit])
    low = inside[hit[first]]
    return owner[hit[first]], low, low + length


def removed(doc_id, text: bytes, ranges: np.ndarray) -> dict:
    words = text.split()
    kept, at = [], 0
    for low, high in ranges.tolist():
        kept += words[at:low]
        at = high
    kept += words[at:]
    return {"doc_id": doc_id, "n_words": len(words), "n_removed": len(words) - len(kept),
            "kept_sha256": hashlib.sha256(b" ".join(kept)).hexdigest()}


REPORT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def repeated_words(docs: DataFrame, **options) -> DataFrame:
    """doc_id, text_hash, ranges (low, high): the words of each document that lie in a window which starts
    earlier too. Documents without any have no row."""
    return repeated_ranges(identified(docs), cut, WINDOW, 8, body, compare, True, **options)


def word_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: one row for each row of `docs` (doc_id, text).

    Null texts have no words; texts under WINDOW words lose nothing; a null doc_id is before all others;
    rows that repeat doc_id and text are one document and get the same result; an empty table gives no
    rows; other columns are ignored.
    """
    ddl = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    return applied(identified(docs), repeated_words(docs, **options), removed, REPORT, ddl)


def op5_recompress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_report(table(spark, sf_dir, "documents"))
