"""Quality rules whose thresholds come from the corpus itself.

Every text is measured; the measures of each (language, source) go into KLL quantile sketches, which
merge: sources into their language, languages into the corpus. A threshold is an upper fence, an
upper quantile plus a multiple of the spread between the median and it, so it moves with what is
usual in that source; word length has a lower fence too, alike. Groups of too few texts take their
language's sketch, then the corpus's. The few threshold rows are joined back and the texts outside
a fence go.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreflow.llm.common import BATCH_ROWS, stored, table, texts_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
SPACE_CHARS = " \t\n\x0b\x0c\r"

#: A group needs so many texts for thresholds of its own.
MIN_GROUP = 200
#: Fence: q + max(FENCE_WIDTH * (q - median), the measure's least distance), q being its upper quantile.
FENCE_WIDTH = 3.0
#: Measures, each per word or per line, with the upper quantile and the least distance of the fence from it.
#: Few texts repeat lines or words and still are good, so there the quantile lies further up than for symbols.
MEASURES = {"symbol_rate": (0.9, 0.05), "dup_line_rate": (0.97, 0.1), "repeat_rate": (0.97, 0.05), "word_length": (0.9, 0.3)}
#: Measures with a lower fence too.
TWO_SIDED = ("word_length",)
#: The sketches' k: their ranks are wrong by about 0.4 per cent, by 1.3 at Spark's own 200, too much for q97.
SKETCH_ITEMS = 1000

#: Groups whose fences are broadcast; some 150 bytes each.
MAX_BROADCAST = 100_000

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def measure(text: str) -> tuple[int, int, int, int, int, int]:
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n_words = len(words)
    word_chars = len(text) - sum(map(text.count, SPACE_CHARS))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = data.split(b"\n")
    n_lines = dup_lines = 0
    if len(lines) > 1:
        seen = set()
        for line in lines:
            if line and not line.isspace():
                n_lines += 1
                if line in seen:
                    dup_lines += 1
                else:
                    seen.add(line)
    elif n_words:
        n_lines = 1
    repeat_words = 0
    if n_words >= 4:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            counts, until = Counter(windows), 0
            for at, window in enumerate(windows):
                if counts[window] > 1:
                    repeat_words += at + 3 - max(at, until)
                    until = at + 3
    return n_words, word_chars, n_symbols, dup_lines, repeat_words, n_lines


def _measured(text: pa.Array) -> pa.Array:
    some = (x for start in range(0, len(text), BATCH_ROWS) for x in texts_of(text.slice(start, BATCH_ROWS)))
    columns = list(zip(*map(measure, some))) or [[]] * len(FEATURES)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], FEATURES)


def measured(text: Column) -> Column:
    kind = T.StructType([T.StructField(name, T.LongType()) for name in FEATURES])
    # So marked, no filter or projection copies it: a text is measured once in a pass.
    return F.arrow_udf(_measured, kind).asNondeterministic()(text.cast("string"))


def with_measures(docs: DataFrame) -> DataFrame:
    """`docs` with the column `_m` of counts, its rates, and the fixed rules' verdict."""
    out = docs.withColumn("_m", measured(F.col("text")))
    words, lines = F.greatest(F.col("_m.n_words"), F.lit(1)), F.greatest(F.col("_m.n_lines"), F.lit(1))
    rates = {
        "symbol_rate": F.col("_m.n_symbols") / words,
        "dup_line_rate": F.col("_m.n_dup_lines") / lines,
        "repeat_rate": F.col("_m.n_repeat_words") / words,
        "word_length": F.col("_m.word_chars") / words,
    }
    failed = (F.col("_m.n_words") < MIN_WORDS) | (
        100 * F.col("_m.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_m.n_words")
    )
    return out.withColumn("_rates", F.struct(*(v.alias(k) for k, v in rates.items()))).withColumn("_base_failed", failed)


def thresholds(rates: DataFrame, min_group: int = MIN_GROUP, width: float = FENCE_WIDTH) -> DataFrame:
    """lang, source, _fences: the fences of every group of `rates` (lang, source, rates...). The upper ones
    have the names of their measures, the lower ones end in `_low`."""
    sketches = [F.kll_sketch_agg_double(name, SKETCH_ITEMS).alias(name) for name in MEASURES]
    merged = [F.kll_merge_agg_double(name, SKETCH_ITEMS).alias(name) for name in MEASURES]
    by_source = stored(rates.groupBy("lang", "source").agg(F.count("*").alias("n"), *sketches), "sketches")
    by_lang = by_source.groupBy("lang").agg(F.sum("n").alias("n"), *merged)
    overall = by_source.agg(F.sum("n").alias("n"), *merged)
    level = lambda df, tag, keep: df.select(*keep, F.struct("n", *MEASURES).alias(tag))
    joined = (
        level(by_source, "own", ["lang", "source"])
        .join(level(by_lang, "wide", [F.col("lang").alias("_lang")]), F.col("lang").eqNullSafe(F.col("_lang")))
        .join(F.broadcast(level(overall, "all", [])), F.lit(True))  # one row
    )
    def quantile(name, rank):
        sketch = (
            F.when(F.col("own.n") >= min_group, F.col(f"own.{name}"))
            .when(F.col("wide.n") >= min_group, F.col(f"wide.{name}"))
            .otherwise(F.col(f"all.{name}"))
        )
        return F.kll_sketch_get_quantile_double(sketch, F.lit(rank))

    def upper(name, rank, least):
        high = quantile(name, rank)
        return (high + F.greatest(width * (high - quantile(name, 0.5)), F.lit(least))).alias(name)

    def lower(name, rank, least):
        low = quantile(name, 1 - rank)
        return (low - F.greatest(width * (quantile(name, 0.5) - low), F.lit(least))).alias(f"{name}_low")

    fences = [upper(k, *v) for k, v in MEASURES.items()] + [lower(k, *MEASURES[k]) for k in TWO_SIDED]
    return joined.select("lang", "source", F.col("own.n").alias("_texts"), F.struct(*fences).alias("_fences"))


def group_key() -> Column:
    """One string for each language and source; nulls are groups of their own."""
    part = lambda c: F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-"))
    return F.concat(part("lang"), part("source"))


def with_fences(rated: DataFrame, rates: DataFrame, min_group: int, width: float, max_broadcast: int) -> DataFrame:
    """`rated` with `_fences`, which come from `rates`: by broadcast if there are `max_broadcast` groups at most.
    Of more, those with over a thousandth of all texts are broadcast, and the other rows joined by group."""
    fences = stored(thresholds(rates, min_group, width).select(group_key().alias("_group"), "_texts", "_fences"), "fences")
    rows, own = rated.withColumn("_group", group_key()), fences.select("_group", "_fences")
    if fences.count() <= max_broadcast:
        return rows.join(F.broadcast(own), "_group", "left")
    total = fences.agg(F.sum("_texts")).head()[0]
    hot = F.broadcast(fences.where(F.col("_texts") * 1000 > total).select("_group", "_fences"))
    near = rows.join(hot, "_group")
    return near.unionByName(rows.join(hot, "_group", "left_anti").join(own, "_group", "left"))


def judged(rated: DataFrame, rates: DataFrame, min_group: int = MIN_GROUP, width: float = FENCE_WIDTH,
           max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Measured texts (`with_measures`) with `_kept`: false if the fixed rules fail or a rate lies
    outside its group's fences. Thresholds come from `rates`, those of the texts that pass the fixed rules.

    A null text has no words and fails; null languages and sources are groups of their own; repeated
    rows count and stay; an empty table gives no rows; other columns pass through unchanged.
    """
    joined = with_fences(rated, rates, min_group, width, max_broadcast)
    within = F.lit(True)
    for name in MEASURES:
        within = within & F.coalesce(F.col(f"_rates.{name}") <= F.col(f"_fences.{name}"), F.lit(True))
    for name in TWO_SIDED:
        within = within & F.coalesce(F.col(f"_rates.{name}") >= F.col(f"_fences.{name}_low"), F.lit(True))
    return joined.withColumn("_kept", ~F.col("_base_failed") & within)


def measures_of(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, _m, _rates, _base_failed, stored: small rows, without the texts."""
    return stored(with_measures(docs.select("doc_id", "text", "lang", "source")).drop("text"), "measures")


def passing(rated: DataFrame) -> DataFrame:
    return rated.where(~F.col("_base_failed")).select("lang", "source", "_rates.*")


def quality_report(docs: DataFrame, **options) -> DataFrame:
    """One row for each row of `docs`, measured once: the small rows of counts are stored, not the texts."""
    rated = measures_of(docs)
    rows = judged(rated, passing(rated), **options)
    return rows.select(
        "doc_id", "_m.n_words", "_m.word_chars", "_m.n_symbols", "_m.n_dup_lines", "_m.n_repeat_words",
        F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"),
    )


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that pass, unchanged, whatever their columns are called. Texts are measured for the
    fences, and again where they are read to be kept or dropped: no text is written or shuffled in between."""
    packed = docs.select(F.struct("*").alias("row")).select("row", "row.text", "row.lang", "row.source")
    return judged(with_measures(packed), passing(measures_of(docs)), **options).where("_kept").select("row.*")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))
