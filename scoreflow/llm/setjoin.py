"""Jaccard join of word n-gram sets by prefix trees.

One global order holds for all n-grams: by how often the corpus has them (classes of `hashcounts`), rare first,
then by hash. Two sets as similar as asked share an n-gram among the first few of each, so sets meet through
those; n-grams that occur once meet nothing and are left out. In a large corpus most such meetings are by chance and
hang nearly all sets together, so sets that meet must meet again: n-grams are dealt by hash into more parts than similar
sets have differences, so that these have equal parts. Sets that meet both times, directly or through others, form a
unit. Only their n-grams move. A unit's sets are stored in a trie, frequent n-grams first, so that similar sets share long paths. Every set
walks down the trie and takes the overlap of a path with it; a subtree goes where the n-grams that are left,
there or in the set, cannot make up the overlap that its sizes ask for, or where all its sets already hang
together with the walker.

Texts of equal sets are one class throughout. A unit that is too large for a task is taken apart: its sets are compared
with its most ordinary one, then each n-gram whose sets do not all hang together by then is a unit of its own, and one
with too many sets is dealt into blocks, which meet in pairs. Before that, the sets of such an n-gram are compared with
its most ordinary one, and blocks whose sets all hang together by then need no meeting. Nothing is left out.

N-grams are told apart by 64-bit hashes of their words, sets by two such sums over all their n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreflow.llm.common import NO_SPACE, Words, bitmap_of, bytes_of, in_bitmap, join_with_hot, map_batches, mixed, stored, table
from scoreflow.llm.components import connected
from scoreflow.llm.hashcounts import Classes, frequency_classes

SHINGLE_WORDS = 3
MIN_PERCENT = 90
#: Documents that have an n-gram, by class of frequency.
THRESHOLDS = (2, 8, 64, 512, 4096)
#: N-grams of all sets of a unit that one task takes.
UNIT_GRAMS = 1 << 20
_SECOND = np.uint64(0xA0761D6478BD642F)
_THIRD = np.uint64(0xE7037ED1A0B428DB)


class Sets:
    """The distinct n-grams of several texts: `gram` and `text`, by text and hash, and each text's first place.
    A text of fewer words is one n-gram as a whole."""

    def __init__(self, texts: list[bytes], length: int):
        words = Words([t.lower() for t in texts], NO_SPACE)
        at, gram = words.shingles(length)
        text = words.text[at]
        for size in range(1, length):
            short = np.flatnonzero(words.count == size)
            if len(short):
                at, whole = words.shingles(size)
                own = np.isin(words.text[at], short)
                text, gram = np.concatenate([text, words.text[at[own]]]), np.concatenate([gram, whole[own]])
        order = np.lexsort((gram, text))
        text, gram = text[order], gram[order]
        new = np.ones(len(gram), bool)
        new[1:] = (text[1:] != text[:-1]) | (gram[1:] != gram[:-1])
        self.text, self.gram = text[new], gram[new]
        self.size = np.bincount(self.text, minlength=len(texts))
        self.first = np.cumsum(self.size) - self.size

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit names of each set."""
        out = []
        for values in (mixed(self.gram), mixed(self.gram ^ _SECOND)):
            sums = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
            out.append(mixed(sums[self.first + self.size] - sums[self.first] + self.size.astype(np.uint64)))
        return out[0], out[1]

    def ordered(self, classes: Classes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """N-grams of each text in the global order, their classes, and their places in it."""
        kinds = classes.of(self.gram)
        order = np.lexsort((self.gram, kinds, self.text))
        place = np.arange(len(order)) - self.first[self.text]
        return self.gram[order], kinds[order], place


def sets_in(batch: pa.RecordBatch, length: int) -> Sets:
    return Sets(bytes_of(batch.column("text")), length)


def needed_overlap(sizes: int, percent: int) -> int:
    """The least number of common members of two sets, with `sizes` members taken together, that link."""
    return -(-percent * sizes // (100 + percent))


def _band_starts() -> np.ndarray:
    starts = [0, 1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, starts[-1] * 4 // 3))
    return np.array(starts)


#: Least sizes of bands of similar sizes.
BANDS = _band_starts()


def part_names(sets: Sets, texts: np.ndarray, kinds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of parts of the sets `texts` (ascending), and which text each is of. Two different sets as similar as `percent`
    have a name in common. `kinds` are the classes of the sets' n-grams.

    Sets of a band of sizes are cut into parts by the n-grams' hashes. Two that link differ in `most` n-grams or
    fewer, so with `most` + 1 + `spare` parts at least `spare` + 1 are equal, and the largest equal one is among the
    `most` + 1 largest of both: those are named. A set near the end of its band has parts for the next one, too. A part
    with an n-gram that occurs once is equal to no other.
    """
    names, owners = [], []
    size = sets.size[texts]
    band = np.searchsorted(BANDS, size, "right") - 1
    last = np.searchsorted(BANDS, 100 * size // percent, "right") - 1
    while len(texts):
        most = 2 * (BANDS[band + 1] - 1) * (100 - percent) // (100 + percent)
        count = most + 1 + most // 8 + 1
        start = np.cumsum(count) - count
        of = np.repeat(np.arange(len(texts)), size)
        at = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + sets.first[texts][of]
        gram = sets.gram[at]
        # In the order of the hashes, so a part's n-grams stand side by side.
        part = start[of] + ((gram >> np.uint64(32)) * count[of].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        held = np.bincount(part, minlength=int(count.sum()))
        rare = np.bincount(part[kinds[at] == 0], minlength=len(held)) > 0
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(gram ^ _THIRD), dtype=np.uint64)])
        ends = np.cumsum(held)
        total = sums[ends] - sums[ends - held]
        owner = np.repeat(np.arange(len(texts)), count)
        index = np.arange(len(held)) - start[owner]
        order = np.lexsort((index, -held, owner))
        named = order[(np.arange(len(order)) - start[owner] <= most[owner]) & ~rare[order]]
        where = mixed((band[owner[named]] << 40 | index[named]).astype(np.uint64))
        names.append(mixed(total[named] + where))
        owners.append(texts[owner[named]])
        more = last > band
        texts, size, band, last = texts[more], size[more], band[more] + 1, last[more]
    return (np.concatenate(names), np.concatenate(owners)) if names else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _cut(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def prefixed_sets(docs: DataFrame, classes: Classes, length: int, percent: int) -> DataFrame:
    """doc_id, name1, name2, n, prefix, parts: each document's set, those of its first n-grams that others have, and, where
    there are any, the names of its parts."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sets = sets_in(batch, length)
        gram, kind, place = sets.ordered(classes)
        size = sets.size[sets.text]
        inside = (place <= size - (-(-percent * size // 100))) & (kind > 0)
        one, two = sets.names()
        firsts = np.bincount(sets.text[inside], minlength=batch.num_rows)
        names, owner = part_names(sets, np.flatnonzero(firsts), classes.of(sets.gram), percent)
        by_text = np.argsort(owner, kind="stable")
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(sets.size.astype(np.int64)),
             _cut(gram[inside].view(np.int64), firsts, pa.int64()),
             _cut(names[by_text].view(np.int64), np.bincount(owner, minlength=batch.num_rows), pa.int64())],
            ["doc_id", "name1", "name2", "n", "prefix", "parts"])

    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return map_batches(plain, work, f"doc_id {id_type}, name1 bigint, name2 bigint, n bigint, prefix array<bigint>, parts array<bigint>")


def members_of(docs: DataFrame, wanted: DataFrame, classes: Classes, length: int) -> DataFrame:
    """node, n, component, grams for the sets of `wanted` (node, name1, name2, n, component): the n-grams that occur more
    than once, as 64-bit numbers. Texts are read past a bitmap of the wanted names and cut into n-grams again."""
    bits = min(max((8 * wanted.count()).bit_length(), 16), 27)
    flags = bitmap_of(wanted.select("name1"), "name1", bits)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sets = sets_in(batch, length)
        one, two = sets.names()
        found = np.flatnonzero(in_bitmap(one, flags.value, bits))
        if not len(found):
            return
        _, first = np.unique(one[found], return_index=True)  # copies within the slice
        rows = []
        for t in found[first].tolist():
            grams = sets.gram[sets.first[t] : sets.first[t] + sets.size[t]]
            rows.append((one[t : t + 1].view(np.int64)[0], two[t : t + 1].view(np.int64)[0], grams[classes.of(grams) > 0].astype("<u8").tobytes()))
        columns = list(zip(*rows))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())],
            ["name1", "name2", "grams"])

    found = map_batches(docs.select(F.col("text").cast("string").alias("text")), work, "name1 bigint, name2 bigint, grams binary")
    whole = found.groupBy("name1", "name2").agg(F.first("grams").alias("grams"))
    return whole.join(wanted, ["name1", "name2"]).select("node", "n", "component", "grams")


class Trie:
    """Sorted sequences as a trie whose chains are single nodes.

    A node's sequences stand side by side, from `low` to `high`; those that end in it come first. Nodes come
    parents first, and `after` is the place behind a node's subtree. `edge` has the numbers on the way from its
    parent, `depth` how many there are from the root on.
    """

    def __init__(self, sequences: list[np.ndarray], sizes: np.ndarray):
        lengths = np.array([len(s) for s in sequences])
        found = [(0, 0, len(sequences))]  # low, depth, high
        path = [(0, 0)]  # depth, low
        for i, sequence in enumerate(sequences):
            if len(sequence) > path[-1][0]:
                path.append((len(sequence), i))
            shared, low = common_prefix(sequence, sequences[i + 1]) if i + 1 < len(sequences) else 0, i
            while path[-1][0] > shared:
                depth, low = path.pop()
                found.append((low, depth, i + 1))
            if path[-1][0] < shared:
                path.append((shared, low))
        found.sort()
        self.low, self.depth, self.high = map(list, zip(*found))
        self.parent, self.after, self.edge = [-1] * len(found), [len(found)] * len(found), []
        above: list[int] = []
        for k, (low, depth, _) in enumerate(found):
            while above and self.high[above[-1]] <= low:
                self.after[above.pop()] = k
            if above:
                self.parent[k] = above[-1]
            self.edge.append(sequences[low][self.depth[above[-1]] if above else 0 : depth])
            above.append(k)
        spans = list(zip(self.low, self.high))
        self.least = [int(sizes[a:b].min()) for a, b in spans]
        self.most = [int(sizes[a:b].max()) for a, b in spans]
        self.longest = [int(lengths[a:b].max()) for a, b in spans]


def common_prefix(a: np.ndarray, b: np.ndarray) -> int:
    least = min(len(a), len(b))
    differ = np.flatnonzero(a[:least] != b[:least])
    return int(differ[0]) if len(differ) else least


def trie_links(grams: list[np.ndarray], sizes: np.ndarray, sides: np.ndarray, kinds_of, percent: int) -> list[tuple[int, int]]:
    """Links that join the sets into their components: pairs of places in `grams`. Sets of side 0 meet those of
    side 1, or all meet all where there is one side."""
    if not grams:
        return []
    unique, rank, seen = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    number = np.empty(len(unique), np.int64)
    number[np.lexsort((unique, kinds_of(unique)))] = np.arange(len(unique))
    sequences, start = [], 0
    for own in grams:
        ranks = rank[start : start + len(own)]
        start += len(own)
        # What only one set has here is in no overlap.
        sequences.append(np.sort(number[ranks[seen[ranks] > 1]])[::-1])
    place = sorted(range(len(grams)), key=lambda i: sequences[i].astype(">u4").tobytes())
    one_side = len(np.unique(sides)) == 1
    stored_sets = place if one_side else [i for i in place if sides[i] == 0]
    walkers = place if one_side else [i for i in place if sides[i] != 0]
    trie = Trie([sequences[i] for i in stored_sets], sizes[stored_sets])
    group = np.arange(len(grams))
    group_at = np.array(stored_sets)  # the same, by place in the trie
    present = np.zeros(len(unique), bool)
    overlaps = [0] * len(trie.edge)
    links = []
    for turn, x in enumerate(walkers):
        own, size = sequences[x], int(sizes[x])
        present[own] = True
        ascending = own[::-1]
        smallest, largest = -(-percent * size // 100), 100 * size // percent
        node = 0
        while node < len(trie.edge):
            low, high = trie.low[node], trie.high[node]
            if (
                trie.most[node] < smallest or trie.least[node] > largest
                or (one_side and high <= turn + 1)
                or (group_at[low:high] == group[x]).all()
            ):
                node = trie.after[node]
                continue
            edge, up, depth = trie.edge[node], trie.parent[node], trie.depth[node]
            overlap, rest = (overlaps[up] if up >= 0 else 0), len(own)
            if len(edge):
                overlap += int(np.count_nonzero(present[edge]))
                rest = int(np.searchsorted(ascending, edge[-1]))
            overlaps[node] = overlap
            if overlap + min(rest, trie.longest[node] - depth) < needed_overlap(size + max(trie.least[node], smallest), percent):
                node = trie.after[node]
                continue
            for k in range(low, high):
                y = stored_sets[k]
                if len(sequences[y]) != depth:
                    break
                if group[y] != group[x] and (not one_side or k > turn) and overlap >= needed_overlap(size + int(sizes[y]), percent):
                    links.append((x, y))
                    gone, stays = group[y], group[x]
                    group[group == gone] = stays
                    group_at[group_at == gone] = stays
            node += 1
        present[own] = False
    return links


def links_within(rows: DataFrame, classes: Classes, percent: int) -> DataFrame:
    """node, other: links that hold the components of each unit together; rows (unit, first, second, side, node, n, grams)."""

    def work(batch: pa.Table) -> pa.Table:
        node = batch.column("node").to_numpy()
        grams = [np.frombuffer(x, "<u8") for x in batch.column("grams").to_pylist()]
        found = trie_links(grams, batch.column("n").to_numpy(), batch.column("side").to_numpy(), classes.of, percent)
        left, right = zip(*found) if found else ((), ())
        return pa.table({"node": pa.array(node[list(left)], pa.int64()), "other": pa.array(node[list(right)], pa.int64())})

    return rows.groupBy("unit", "first", "second").applyInArrow(work, "node bigint, other bigint")


def linked_pairs(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Those of `pairs` (node, other) whose sets are similar enough."""

    def common(a: pa.Array, b: pa.Array) -> pa.Array:
        left, right = (({x: np.frombuffer(x, "<u8") for x in set(c.to_pylist())}) for c in (a, b))
        return pa.array([len(np.intersect1d(left[x], right[y], True)) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.int64())

    one = members.select("node", F.col("n").alias("n1"), F.col("grams").alias("grams1"))
    two = members.select(F.col("node").alias("other"), F.col("n").alias("n2"), F.col("grams").alias("grams2"))
    weights = pairs.groupBy("other").agg(F.count("*").alias("met"))
    met = join_with_hot(pairs.join(one, "node"), two.join(weights, "other"), ["other"], "met")
    overlap = F.arrow_udf(common, "bigint")("grams1", "grams2")
    rows = met.select("node", "other", (F.col("n1") + F.col("n2")).alias("sizes"), overlap.alias("overlap"))
    return rows.where((100 + percent) * F.col("overlap") >= percent * F.col("sizes")).select("node", "other")


def membership(edges: DataFrame) -> DataFrame:
    """node, component for every node of `edges`."""
    found = connected(edges)
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())


def met_again(sets: DataFrame, units: DataFrame) -> DataFrame:
    """node, component for the sets of `units` (node, component) that meet others of their component by equal parts,
    directly or through others; sets (node, parts)."""
    parts = sets.join(units, "node").select("node", "component", F.explode("parts").alias("part")).select(
        "node", F.xxhash64("component", "part").alias("part"))
    stats = stored(parts.groupBy("part").agg(F.count("*").alias("m"), F.min("node").alias("other")).where("m > 1"), "parts")
    met = join_with_hot(parts, stats, ["part"], "m").where("node <> other").select("node", "other")
    return membership(met.distinct())


def taken_apart(met: DataFrame, members: DataFrame, unit_grams: int, classes: Classes, percent: int) -> DataFrame:
    """Links of the sets `met` (gram, node, n, ordinary, component) of units too large for a task: those of each unit's most
    ordinary set, then n-gram by n-gram."""
    middles = met.groupBy("component").agg(F.max_by("node", F.struct("ordinary", "node")).alias("other"))
    near = met.select("node", "component").distinct().join(F.broadcast(middles), "component").where("node <> other")
    middle = stored(linked_pairs(near.select("node", "other"), members, percent), "links-middle")
    known = membership(middle).withColumnRenamed("component", "whole")
    met = stored(met.join(known, "node", "left").select(
        F.xxhash64("component", "gram").alias("gram"), "node", "n", "ordinary", F.coalesce("whole", "node").alias("whole")), "meetings-apart")
    # N-grams of the same sets are one unit.
    stats = stored(met.groupBy("gram").agg(
        F.count("*").alias("m"), F.sum("n").alias("weight"), F.max_by("node", F.struct("ordinary", "node")).alias("pivot"),
        F.expr("bit_xor(xxhash64(node))").alias("sets1"), F.expr("bit_xor(xxhash64(node, 1))").alias("sets2"),
        F.min("whole").alias("low"), F.max("whole").alias("high"),
    ).where("low <> high").dropDuplicates(["sets1", "sets2", "m"]).drop("low", "high"), "grams-apart")
    few = stats.where(F.col("weight") <= unit_grams).select("gram")
    units = met.join(few, "gram", "left_semi").select(
        F.col("gram").alias("unit"), F.lit(0).alias("first"), F.lit(0).alias("second"), F.lit(0).alias("side"), "node")
    links = stored(middle.unionByName(links_within(units.join(members, "node"), classes, percent)), "links-apart")
    hot = stats.where(F.col("weight") > unit_grams).select("gram", "pivot")
    if hot.isEmpty():
        return links
    rows = stored(met.join(F.broadcast(hot) if hot.count() < 10000 else hot, "gram").select("gram", "node", "n", "pivot"), "hot-sets")
    star = rows.where("node <> pivot").select("node", F.col("pivot").alias("other")).distinct()
    links = stored(links.unionByName(linked_pairs(star, members, percent)), "links-star")
    known = membership(links)
    rows = rows.join(known, "node", "left").select("gram", "node", "n", F.coalesce("component", "node").alias("component"))
    parts = rows.groupBy("gram", "component").agg(F.sum("n").alias("own"))
    parts = parts.join(parts.groupBy("gram").agg(F.sum("own").alias("all"), F.count("*").alias("several")), "gram").where("several > 1")
    # A component that fills blocks has its own; the others are dealt together.
    large = F.col("own") > unit_grams
    parts = stored(parts.select(
        "gram", "component", F.when(large, F.col("component")).otherwise(F.lit(-1)).alias("alone"),
        F.ceil(F.when(large, F.col("own")).otherwise(F.col("all")) / unit_grams).alias("blocks")), "hot-parts")
    deal = F.when(F.col("alone") >= 0, F.xxhash64("node")).otherwise(F.xxhash64("component"))
    rows = stored(rows.join(parts, ["gram", "component"]).select(
        "gram", "node", "alone", F.xxhash64("alone", F.pmod(deal, "blocks")).alias("block")), "hot-blocks")
    blocks = rows.select("gram", "alone", "block").distinct()
    other = blocks.select("gram", F.col("alone").alias("alone2"), F.col("block").alias("second"))
    pairs = blocks.withColumnRenamed("block", "first").join(other, "gram").where(
        (F.col("first") <= F.col("second")) & ((F.col("alone") != F.col("alone2")) | (F.col("alone") < 0)))
    pairs = stored(pairs.select("gram", "first", "second"), "block-pairs")
    ends = pairs.withColumn("side", F.lit(0)).withColumn("block", F.col("first")).unionByName(
        pairs.where("first <> second").withColumn("side", F.lit(1)).withColumn("block", F.col("second")))
    units = ends.join(rows.select("gram", "block", "node"), ["gram", "block"]).select(
        F.col("gram").alias("unit"), "first", "second", "side", "node")
    return stored(links.unionByName(links_within(units.join(members, "node"), classes, percent)), "links-apart")


def similar_sets(
    docs: DataFrame, length: int = SHINGLE_WORDS, percent: int = MIN_PERCENT, unit_grams: int = UNIT_GRAMS
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, name1, name2, n) for each row of `docs`, and (name1, name2, n, texts, component_id) for each set."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    classes = frequency_classes(texts, lambda batch: sets_in(batch, length).gram, THRESHOLDS)
    rows = stored(prefixed_sets(docs, classes, length, percent), "sets-of-rows")
    key = ["name1", "name2", "n"]
    sets = rows.where("n > 0").groupBy(*key).agg(
        F.min("doc_id").alias("lowest"), F.count("*").alias("texts"), F.first("prefix").alias("prefix"), F.first("parts").alias("parts"))
    sets = stored(sets.withColumn("node", F.monotonically_increasing_id()), "sets")
    postings = sets.select("node", "n", F.size("prefix").alias("ordinary"), F.explode("prefix").alias("gram"))
    stats = stored(postings.groupBy("gram").agg(
        F.count("*").alias("m"), F.max_by("node", F.struct("ordinary", "node")).alias("pivot")).where("m > 1"), "grams")
    met = stored(join_with_hot(postings, stats, ["gram"], "m").select("gram", "node", "n", "ordinary", "pivot"), "meetings")
    hung = stored(membership(met.where("node <> pivot").select("node", F.col("pivot").alias("other")).distinct()), "hung-together")
    units = stored(met_again(sets, hung), "units")
    named = units.join(sets.select("node", *key), "node")
    members = stored(members_of(docs, named.select("node", *key, "component"), classes, length), "members")
    weights = named.groupBy("component").agg(F.sum("n").alias("weight"))
    large = stored(weights.where(F.col("weight") > unit_grams).select("component"), "large-units")
    # Members know their unit, so n-grams move once, to the task of the unit.
    small = members.join(large, "component", "left_anti").select(
        F.col("component").alias("unit"), F.lit(0).alias("first"), F.lit(0).alias("second"), F.lit(0).alias("side"), "node", "n", "grams")
    links = stored(links_within(small, classes, percent), "links")
    members = members.drop("component")
    if not large.isEmpty():
        inside = units.join(large, "component", "left_semi")
        links = links.unionByName(taken_apart(met.drop("pivot").join(inside, "node"), members, unit_grams, classes, percent))
    linked = membership(links)
    found = sets.join(linked, "node", "left").select(
        *key, "texts", "lowest", F.coalesce("component", "node").alias("component"))
    lows = found.groupBy("component").agg(F.min("lowest").alias("component_id"))
    return rows, stored(found.join(lows, "component").select(*key, "texts", "component_id"), "components")


def jaccard_components(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id: one row for each row of `docs` (doc_id, text).

    Texts without words, null included, have no n-grams and are linked with nothing. Rows with a null doc_id link
    like others and count for no component_id, which is null where none is reachable. Repeated rows come as often
    as they are there; an empty table gives no rows; other columns are ignored.
    """
    rows, sets = similar_sets(docs, **options)
    empty = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    full = join_with_hot(rows.where("n > 0").drop("prefix", "parts"), sets, ["name1", "name2", "n"], "texts")
    return full.select("doc_id", "n", "component_id").unionByName(empty).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")


def op11_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
