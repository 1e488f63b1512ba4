"""Exact substring dedup over bytes, with suffixes sorted deep-shallow.

Every string of 200 bytes has one anchor: of its 32-byte grams, the one with the smallest hash, the
leftmost of equals. Runs of strings with one anchor are a piece, and equal strings lie in pieces whose
anchors have the same gram. For the pieces of a gram, two sets of suffixes are sorted: the bytes from
the anchor on, and the bytes before it backwards. Two strings whose anchors lie j bytes inside are
equal if and only if the pieces agree in j bytes to the left and 200 - j to the right, which common
prefixes of neighbours in sorted order tell for all j.

Sorting is multikey quicksort, eight bytes to a character, down to a shallow depth. Groups that still
agree there are ordered by a blind trie, which looks at branching bytes only and compares each suffix
in full with just one other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from scoreflow.llm.common import _BYTE_VALUE, _ODD, mixed, range_hashes, table
from scoreflow.llm.repeats import SEGMENT, Pieces, applied, identified, repeated_ranges, runs_of

WINDOW = 200
GRAM = 32
SHALLOW = 64
CHARACTER = 8


def segments(texts: list[bytes], window: int = WINDOW) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Groups of about SEGMENT bytes: text numbers, offsets, bytes. Long texts come in parts that overlap
    by a window less one, so that every window lies in one part."""
    owners, offsets, parts, size = [], [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - window + 1, 0), SEGMENT):
            owners.append(i)
            offsets.append(at)
            parts.append(text[at : at + SEGMENT + window - 1])
            size += len(parts[-1])
            if size >= SEGMENT:
                yield owners, offsets, parts
                owners, offsets, parts, size = [], [], [], 0
    if parts:
        yield owners, offsets, parts


def cut(texts: list[bytes], window: int = WINDOW, gram: int = GRAM) -> Iterator[tuple[np.ndarray, Pieces]]:
    for owners, offsets, parts in segments(texts, window):
        data = np.frombuffer(b"".join(parts), np.uint8)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        origin = np.concatenate([[0], np.cumsum(sizes)])
        grams, reach, power = _BYTE_VALUE[data], 1, _ODD
        while reach < gram:
            grams = grams[:-reach] * np.uint64(power) + grams[reach:]
            reach, power = reach * 2, power * power % (1 << 64)
        # The order of grams and, of equals, the leftmost: 40 bits of hash over 24 of place.
        rank = mixed(grams) >> np.uint64(24) << np.uint64(24) | np.arange(len(grams), dtype=np.uint64)
        reach, count = 1, window - gram + 1
        while reach * 2 <= count:
            rank = np.minimum(rank[:-reach], rank[reach:])
            reach *= 2
        if reach < count:
            rank = np.minimum(rank[: len(rank) - (count - reach)], rank[count - reach :])
        place = np.concatenate([np.arange(a, b - window + 1) for a, b in zip(origin[:-1], origin[1:])])
        anchor = (rank[place] & np.uint64((1 << 24) - 1)).astype(np.int64)
        first, n = runs_of(place, anchor)
        start, anchor = place[first], anchor[first]
        part = np.searchsorted(origin, start, "right") - 1
        piece = mixed(range_hashes(data, start, start + n + window - 1) + (anchor - start).astype(np.uint64))
        shift = np.array(offsets, np.int64)[part] - origin[part]
        yield np.array(owners, np.int64)[part], (start + shift, n, anchor - start, grams[anchor], piece)


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - 1 - (differ.bit_length() - 1) // 8


class BlindTrie:
    """Orders strings that agree to some depth. Inner nodes know their depth and one byte for each child;
    byte -1 is the end of a string. Leaves are lists of equal strings."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root = None

    def add(self, i: int) -> None:
        text = self.strings[i]
        if self.root is None:
            self.root = [i]
            return
        node, path = self.root, []
        while isinstance(node, tuple):  # blindly: missing bytes take any child
            depth, children = node
            path.append(node)
            byte = text[depth] if depth < len(text) else -1
            node = children[byte] if byte in children else next(iter(children.values()))
        other = self.strings[node[0]]
        shared = common_prefix(text, other)
        if shared == len(text) == len(other):
            node.append(i)
            return
        parent, below = None, self.root
        while isinstance(below, tuple) and below[0] < shared:
            parent, byte = below, text[below[0]]
            below = below[1][byte]
        mine = text[shared] if shared < len(text) else -1
        if isinstance(below, tuple) and below[0] == shared:
            below[1][mine] = [i]
            return
        theirs = other[shared] if shared < len(other) else -1
        inner = (shared, {mine: [i], theirs: below})
        if parent is None:
            self.root = inner
        else:
            parent[1][byte] = inner

    def ordered(self) -> Iterator[tuple[int, int]]:
        """Numbers in order, each with the length of what it shares with the one before."""
        stack, shared = [(self.root, 0)], 0
        while stack:
            node, shared = stack.pop()
            if isinstance(node, tuple):
                depth, children = node
                bytes_ = sorted(children, reverse=True)
                stack += [(children[b], depth) for b in bytes_[:-1]]
                stack.append((children[bytes_[-1]], shared))
            else:
                for k, i in enumerate(node):
                    yield i, shared if k == 0 else len(self.strings[i])


def deep_shallow(strings: list[bytes], chosen: list[int], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """`chosen` in the order of their strings, and the length of each one's common prefix with the one
    before it in that order (0 for the first)."""
    order, shared = [], []
    stack = [(chosen, 0, 0)]  # group, depth to which it agrees, what its first shares with the one before
    while stack:
        group, depth, before = stack.pop()
        if len(group) == 1:
            order.append(group[0])
            shared.append(before)
        elif depth >= shallow:
            trie = BlindTrie(strings)
            for i in group:
                trie.add(i)
            for k, (i, common) in enumerate(trie.ordered()):
                order.append(i)
                shared.append(common if k else before)
        else:
            characters = [strings[i][depth : depth + CHARACTER] for i in group]
            pivot = sorted((characters[0], characters[len(group) // 2], characters[-1]))[1]
            less = [i for i, c in zip(group, characters) if c < pivot]
            equal = [i for i, c in zip(group, characters) if c == pivot]
            more = [i for i, c in zip(group, characters) if c > pivot]
            if len(pivot) < CHARACTER:  # these strings end here and are equal
                tail = [(g, depth + len(pivot)) for g in ([i] for i in equal)]
            else:
                tail = [(equal, depth + CHARACTER)]
            parts = [(less, depth)] * bool(less) + tail + [(more, depth)] * bool(more)
            # What neighbours share at the seams is found from the strings when they meet.
            for k in range(len(parts) - 1, -1, -1):
                stack.append((*parts[k], before if k == 0 else -1))
    for k in range(1, len(order)):
        if shared[k] < 0:
            shared[k] = common_prefix(strings[order[k - 1]], strings[order[k]])
    return order, shared


def classes_by_depth(order: list[int], shared: np.ndarray, size: int):
    """A function from a length to class numbers: equal for strings that agree in so many bytes."""
    place = np.empty(size, np.int64)
    place[np.array(order, np.int64)] = np.arange(size)
    return lambda depth: np.cumsum(shared < depth)[place]


def compare(rows: dict, window: int = WINDOW):
    """The ranges of windows that occur in another piece of the same key."""
    key, n, anchor, bodies = rows["key"], rows["n"], rows["anchor"], rows["body"]
    size = len(key)
    right = [b[a:] for b, a in zip(bodies, anchor.tolist())]
    left = [b[:a][::-1] for b, a in zip(bodies, anchor.tolist())]
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [size]]).tolist()
    sorted_ = []
    for strings in (right, left):
        order, shared = [], []
        for a, b in zip(bounds, bounds[1:]):
            some, common = deep_shallow(strings, list(range(a, b)))
            order += some
            shared += [-1, *common[1:]]  # keys never agree
        sorted_.append(classes_by_depth(order, np.array(shared, np.int64), size))
    of_right, of_left = sorted_
    owners, places = [], []
    for inside in range(int(anchor.max()) + 1):
        active = np.flatnonzero((anchor >= inside) & (anchor - n + 1 <= inside))
        if len(active) < 2:
            continue
        pair = of_right(window - inside)[active] * (size + 1) + of_left(inside)[active]
        _, label, counts = np.unique(pair, return_inverse=True, return_counts=True)
        hit = active[counts[label] > 1]
        owners.append(hit)
        places.append(anchor[hit] - inside)
    if not owners:
        none = np.zeros(0, np.int64)
        return none, none, none
    owner, place = np.concatenate(owners), np.concatenate(places)
    order = np.lexsort((place, owner))
    owner, place = owner[order], place[order]
    first, length = runs_of(place, owner)
    return owner[first], place[first], place[first] + length


def body(text: bytes):
    return lambda start, end: text[start:end]


def removed(doc_id, text: bytes, ranges: np.ndarray) -> dict:
    digest, at = hashlib.sha256(), 0
    for low, high in ranges.tolist():
        digest.update(text[at:low])
        at = high
    digest.update(text[at:])
    return {"doc_id": doc_id, "n_bytes": len(text), "n_removed": int((ranges[:, 1] - ranges[:, 0]).sum()),
            "n_spans": len(ranges), "kept_sha256": digest.hexdigest()}


REPORT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                    ("kept_sha256", pa.string())])


def repeated_bytes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, text_hash, ranges (low, high): the bytes of each document that lie in a string of WINDOW
    bytes which starts elsewhere too. Documents without any have no row."""
    return repeated_ranges(identified(docs), cut, WINDOW, 1, body, compare, False, **options)


def substring_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row for each row of `docs` (doc_id, text).

    Null texts are empty; texts under WINDOW bytes lose nothing; rows that repeat doc_id and text lose
    what they share with each other; an empty table gives no rows; other columns are ignored.
    """
    ddl = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return applied(identified(docs), repeated_bytes(docs, **options), removed, REPORT, ddl)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_report(table(spark, sf_dir, "documents"))
