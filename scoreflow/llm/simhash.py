"""SimHash near-duplicates, linked by multi-index hashing.

A 64-bit fingerprint is cut into two 32-bit segments. Two fingerprints within 3 bits differ in at
most 1 bit in one of them, so a ball of radius 1 round each segment, looked up in a table of that
segment's values, finds every pair; the whole distance is then verified. A pair that differs in one
bit of a segment is found by whichever side has that bit set, so the ball needs only the value
itself and the values with one set bit cleared: about 17 probes instead of 33.

Equal fingerprints form one node, so copies are never paired. A table bucket with more than
`hot_bucket` fingerprints is split by the four bytes of the other segment: of the at most 3 bits
left, none can lie in all four, so some byte is equal. Nothing is dropped.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreflow.llm.common import bytes_of, join_with_hot, kept_rows, stored, table
from scoreflow.llm.components import connected

SHINGLE_WORDS = 3
SEED = 42
MAX_DISTANCE = 3
HOT_BUCKET = 1000


def fingerprint_of(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bits set in over half the XXH64 hashes of the lower-cased text's word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    votes = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(text: pa.Array) -> pa.Array:
    found = np.fromiter(map(fingerprint_of, bytes_of(text)), np.uint64, len(text))
    return pa.array(found.view(np.int64))


def fingerprints(text: Column) -> Column:
    return F.arrow_udf(_fingerprints, T.LongType())(text.cast("string"))


def _segment(name: str, index: int) -> Column:
    return F.shiftrightunsigned(F.col(name), 32 * index).bitwiseAND(F.lit(0xFFFFFFFF))


def _byte_keys(name: str, other: Column) -> Column:
    """Four keys, one for each byte of the other segment with its place."""
    return F.array(*(
        F.lit(i * 256) + F.shiftrightunsigned(other, 8 * i).bitwiseAND(F.lit(255)) for i in range(4)
    ))


def linked_pairs(prints: DataFrame, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """left, right: pairs of different fingerprints of `prints` (fingerprint bigint, distinct) within
    3 bits. A pair may come more than once."""
    entries = prints.select(
        "fingerprint",
        F.explode(F.array(*(
            F.struct(F.lit(i).alias("segment"), _segment("fingerprint", i).alias("value"),
                     _segment("fingerprint", 1 - i).alias("other"))
            for i in range(2)
        ))).alias("e"),
    ).select("fingerprint", "e.*")
    cleared = F.expr(
        "transform(filter(sequence(0, 31), i -> (value & shiftleft(1L, i)) <> 0), i -> value ^ shiftleft(1L, i))"
    )
    probes = entries.select(
        F.col("fingerprint").alias("probe"), "segment", "other",
        F.explode(F.concat(F.array("value"), cleared)).alias("value"),
    )
    keys = ["segment", "value"]
    hot = stored(entries.groupBy(*keys).count().where(F.col("count") > hot_bucket).select(*keys), "hot-buckets")
    table_side, probe_side = entries, probes
    if not hot.isEmpty():
        hot = hot.withColumn("hot", F.lit(True))
        def split(side):
            byte = F.when(F.col("hot"), _byte_keys("b", F.col("other"))).otherwise(F.array(F.lit(-1)))
            return side.join(hot, keys, "left").withColumn("byte", F.explode(byte))
        table_side, probe_side = split(entries), split(probes)
        keys = [*keys, "byte"]
    met = probe_side.drop("other", "hot").join(table_side.drop("other", "hot"), keys)
    apart = F.bit_count(F.col("probe").bitwiseXOR(F.col("fingerprint")))
    return met.where((F.col("probe") != F.col("fingerprint")) & (apart <= MAX_DISTANCE)).select(
        F.col("probe").alias("left"), F.col("fingerprint").alias("right")
    )


def fingerprint_components(docs: DataFrame, hot_bucket: int = HOT_BUCKET, *also: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fingerprint, `also`) per row of `docs`, and (fingerprint, texts, component, component_id)
    per fingerprint.

    component names the fingerprints that are linked; component_id is the smallest doc_id reachable over
    fingerprints within 3 bits. A doc_id with several texts links nothing. Rows whose doc_id is null get a
    fingerprint, link nothing and have a null component_id unless others share theirs.
    """
    printed = stored(docs.select("doc_id", fingerprints(F.col("text")).alias("fingerprint"), *also), "fingerprints")
    classes = printed.groupBy("fingerprint").agg(F.min("doc_id").alias("lowest"), F.count("*").alias("texts"))
    nodes = classes.where("lowest is not null")
    pairs = linked_pairs(nodes.select("fingerprint"), hot_bucket)
    merged = connected(pairs.select(F.col("left").alias("node"), F.col("right").alias("other")))
    merged = merged.unionByName(merged.select(F.col("component").alias("node"), "component").distinct())  # roots
    lows = nodes.join(merged, nodes["fingerprint"] == merged["node"]).groupBy("component").agg(F.min("lowest").alias("low"))
    named = merged.join(lows, "component")
    components = classes.join(named, classes["fingerprint"] == named["node"], "left").select(
        "fingerprint", "texts", F.coalesce("component", "fingerprint").alias("component"),
        F.coalesce("low", "lowest").alias("component_id"),
    )
    return printed, stored(components, "components")


def simhash_duplicates(docs: DataFrame, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row for each row of `docs` (doc_id, text).

    A text without words, null included, has fingerprint zero and links like any other. Repeated rows
    are returned as often as they come; an empty table gives no rows; other columns are ignored.
    """
    printed, components = fingerprint_components(docs, hot_bucket)
    return join_with_hot(printed, components, ["fingerprint"], "texts").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one_per_component(docs: DataFrame, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """One row of `docs` for each component, with the same columns: the one with the smallest doc_id, null
    after all others; then the smallest fingerprint, then the smallest hash of the row.

    Rows that repeat in full stay once. Rows with a null doc_id link nothing, but copies of a text that is
    kept already go.
    """
    # Maps have no hash; rows that differ only in one count as equal.
    names = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    values = [x for n in names for x in (F.col(f"`{n}`").isNull(), F.col(f"`{n}`"))]
    keys = ["_keeper_id", "_keeper_row"]
    marked = docs.withColumns({keys[0]: F.coalesce(F.col("doc_id").cast("string"), F.lit("")), keys[1]: F.xxhash64(*values)})
    printed, components = fingerprint_components(marked, hot_bucket, *keys)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "fingerprint", "_keeper_row", "_keeper_id")
    firsts = printed.groupBy("fingerprint").agg(F.min(place).alias("first"))
    keepers = firsts.join(components, "fingerprint").groupBy("component").agg(F.min("first").alias("first"))
    keepers = keepers.select(*(F.col(f"first.{k}").alias(k) for k in keys)).distinct().withColumn("_found", F.lit(True))
    decided = printed.select(*keys).join(keepers, keys, "left").select(*keys, F.col("_found").isNotNull().alias("_keep"))
    return kept_rows(marked, decided, keys).select(*(f"`{c}`" for c in docs.columns))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(table(spark, sf_dir, "documents"))
