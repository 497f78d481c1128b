"""Quality rules: hashed n-gram log-likelihood ratio after a few base rules.

Native DataFrame expressions only.  Every text is cut into runs of letters and
digits and runs of other visible characters; the runs (unigrams) and neighbouring
runs (bigrams) are hashed into ``buckets`` counts.  Two multinomials are estimated, one
over the trusted target documents and one over the raw corpus (all documents); both get
the same prior count per bucket, so that rare n-grams weigh little.  A document's score is the mean log ratio of its n-grams, so its
length does not matter; it is kept at ``threshold`` or more.

Scale: corpus counts are one aggregate into at most ``buckets`` groups with map-side
partial sums; a text never leaves its row.  The bucket weights are
``buckets`` numbers, bounded by that parameter, and one literal of the scoring
projection.  The trusted ids meet the texts in a join on the id that Spark
plans by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.llm.common import SPACE, SPACE_CHARS, let, stored

BUCKETS = 1 << 16
#: Added to both sides of a bucket's observed and expected target count.
PRIOR = 4.0
THRESHOLD = -0.2
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
RUNS = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words between ASCII white space; an empty array for none."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE)).otherwise(F.array().cast("array<string>"))


def shifted(a: Column, by: int) -> Column:
    """The array without its first ``by`` elements."""
    return F.slice(a, by + 1, F.greatest(F.size(a) - by, F.lit(0)))


def pairs(hashes: Column, by: int = 1) -> Column:
    """Hash of each element with the one ``by`` places on; the last ``by`` elements meet null."""
    return let(hashes, lambda h: F.zip_with(h, shifted(h, by), lambda a, b: F.xxhash64(a, b)))


def windows(hashes: Column) -> Column:
    """Hashes of all windows of 8 elements, in linear steps (windows of 2, 4 and 8); empty
    where too few windows of 4 repeat for any of 8 to repeat (each such holds 5 of 4)."""
    def eight(four: Column) -> Column:
        n = F.size(four) - 3
        inner = F.slice(four, 1, F.greatest(n, F.lit(0)))
        all8 = let(pairs(four, 4), lambda x: F.slice(x, 1, F.greatest(F.size(x) - 7, F.lit(0))))
        return F.when(F.size(F.array_distinct(inner)) <= n - 5, all8).otherwise(F.array().cast("array<bigint>"))

    return let(let(let(hashes, lambda h: pairs(h, 1)), lambda p: pairs(p, 2)), eight)


def repeated_words(w: Column) -> Column:
    """Words inside ``WINDOW``-word windows that occur twice or more, first included."""
    def covered(x: Column) -> Column:
        # windows in order of (hash, position); those equal to a neighbour occur twice or more
        order = F.array_sort(F.transform(x, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))
        def twice(s: Column) -> Column:
            n = F.size(s)
            none = F.array(F.lit(None).cast("struct<h:bigint,p:int>"))
            near = F.arrays_zip(s.alias("s"), F.concat(none, F.slice(s, 1, n - 1)).alias("a"),
                                F.concat(F.slice(s, 2, n - 1), none).alias("b"))
            hit = F.filter(near, lambda z: F.coalesce(z["s"]["h"] == z["a"]["h"], F.lit(False))
                           | F.coalesce(z["s"]["h"] == z["b"]["h"], F.lit(False)))
            return F.array_sort(F.transform(hit, lambda z: z["s"]["p"]))
        def union(p: Column) -> Column:
            gaps = F.zip_with(p, F.concat(F.slice(p, 2, F.size(p)), F.array(F.element_at(p, -1) + WINDOW)),
                              lambda a, b: F.least(F.lit(WINDOW), b - a))
            return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda acc, g: acc + g)
        return let(let(order, twice), union)

    hashes = F.transform(w, lambda x: F.xxhash64(x))
    return let(windows(hashes),
               lambda x: F.when(F.size(F.array_distinct(x)) < F.size(x), covered(x)).otherwise(F.lit(0).cast("bigint")))


def measures(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    base_failed (names after ``prefix``).  A null text counts as empty."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE_CHARS))) > 0)
    counts = let(words(text), lambda w: F.struct(
        F.size(w).alias("words"), F.length(F.array_join(w, "")).alias("chars"), repeated_words(w).alias("repeat")))
    own = f"{prefix}_of_words"
    out = docs.withColumn(own, counts).withColumns({
        f"{prefix}n_words": F.col(f"`{own}`.words").cast("long"),
        f"{prefix}word_chars": F.col(f"`{own}`.chars").cast("long"),
        f"{prefix}n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
        f"{prefix}n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        f"{prefix}n_repeat_words": F.col(f"`{own}`.repeat"),
    }).drop(own)
    failed = (F.col(f"{prefix}n_words") < MIN_WORDS) | (
        F.lit(100) * F.col(f"{prefix}n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col(f"{prefix}n_words"))
    return out.withColumn(f"{prefix}base_failed", failed)


def features(text: Column) -> Column:
    """Hashes of a text's runs and of neighbouring runs (array of longs; empty for no runs)."""
    runs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(RUNS), F.lit(0))
    return let(F.transform(runs, lambda x: F.xxhash64(x)),
               lambda h: F.concat(h, F.slice(pairs(h), 1, F.greatest(F.size(h) - 1, F.lit(0)))))


def bucket_weights(spark: SparkSession, docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", buckets: int = BUCKETS) -> list[float]:
    """Log of target over raw probability for each of the ``buckets`` buckets (smoothed).  ``trusted`` holds the ids of target documents in its
    first column; ids that are null or not in ``docs`` have no effect."""
    ids = trusted.select(F.col(trusted.columns[0]).alias("_tid")).filter("_tid is not null").distinct().withColumn("_in", F.lit(1))
    texts = docs.select(F.col(f"`{id_col}`").alias("_did"), F.col(f"`{text_col}`").cast("string").alias("_t"))
    # the ids are the hashed side, so the texts are not sorted
    src = texts.join(ids.hint("shuffle_hash"), F.col("_did") == F.col("_tid"), "left").select(
        F.coalesce("_in", F.lit(0)).alias("_in"), F.explode(features(F.col("_t"))).alias("_f"))
    counts = (src.groupBy(F.pmod("_f", F.lit(buckets)).cast("int").alias("b"))
              .agg(F.count("*").alias("raw"), F.sum("_in").alias("target")))
    counts = spark.range(buckets).select(F.col("id").cast("int").alias("b")).join(counts, "b", "left").fillna(0)
    counts = stored(spark, counts, "ngram-counts")  # at most ``buckets`` rows
    total = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    share = (total["target"] or 0) / (total["raw"] or 1)
    weight = F.log((F.col("target") + F.lit(PRIOR)) / (F.col("raw") * F.lit(share) + F.lit(PRIOR)))
    return [r["w"] for r in counts.select("b", weight.alias("w")).orderBy("b").collect()]


def judge(spark: SparkSession, docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          buckets: int = BUCKETS, threshold: float = THRESHOLD, prefix: str = "") -> DataFrame:
    """``docs`` with the measures, ``score`` (mean log ratio; 0 for a text without
    n-grams) and ``kept`` (not base_failed and score >= threshold), all named after
    ``prefix``, which must keep them apart from columns of ``docs``.

    Every row is judged by itself: null texts count as empty and fail the base
    rules, repeated rows are judged alike, an id may be null or repeated, an empty
    table gives an empty result.  Without trusted documents all weights are zero."""
    weights = bucket_weights(spark, docs, trusted, id_col, text_col, buckets)
    out = measures(docs, text_col, prefix)
    vector = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")  # folded to one literal
    score = let(vector, lambda v: let(
        features(F.col(f"`{text_col}`").cast("string")),
        lambda f: F.aggregate(f, F.lit(0.0), lambda acc, x: acc + F.get(v, F.pmod(x, F.lit(buckets)).cast("int")))
        / F.greatest(F.size(f), F.lit(1))))
    out = out.withColumn(f"{prefix}score", score)
    return out.withColumn(f"{prefix}kept", ~F.col(f"{prefix}base_failed") & (F.col(f"{prefix}score") >= F.lit(threshold)))
