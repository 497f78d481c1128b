"""Benchmark decontamination by template canonicalisation.

Native DataFrame expressions only.  Texts become sequences of words and numbers;
numbers, names (capitalised words that do not start a sentence) and units after a
number turn into the typed placeholders <num>, <name> and <unit>, all other
words are case-folded.  White space is collapsed first, so line breaks and repeated spaces do
not change a token.  Windows of five of these tokens, and of the case-folded words and numbers
themselves, are hash-joined between documents and benchmark items.  A document holds an item when
at least ``similarity`` (0.8) of the item's distinct literal windows occur in it, whatever their case,
or as many of its template windows and the slots agree: along the
best alignment, what the document has in place of one filler of the item must be
one and the same filler everywhere (0.8 of the slots at least).  A question whose
numbers and names were exchanged is caught; a text that only shares the shape of
its sentences with conflicting fillers is not.

Windows with fewer than two literal words say little and are left out of an item
that has others; an item without others is matched only with identical fillers.

Scale: a text's windows are built inside its row and exploded into (id, hash), a window
without fillers once for both kinds; the
item windows are broadcast only when their counted rows are at most
``broadcast_rows``, else both sides are shuffled by the window hash.  The matches are
reduced per (document, item, window) map-side; texts are read again only for the
candidate documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vaultspark.llm.common import let, stored

WINDOW = 5
SIMILARITY = 0.8
MIN_LITERALS = 2
#: At about 32 bytes a row, 32 MB.
BROADCAST_ROWS = 1_000_000
#: Marks put before names and units while the text is still whole.
NAME_MARK, UNIT_MARK = "\u0002", "\u0003"
UNITS = (
    "mm|cm|km|m|meters?|metres?|kilometers?|kilometres?|inch(?:es)?|ft|feet|foot|yards?|miles?|mg|g|kg|grams?|kilograms?|"
    "tons?|lbs?|pounds?|oz|ounces?|ml|l|liters?|litres?|gallons?|seconds?|secs?|s|minutes?|mins?|hours?|hrs?|h|days?|weeks?|"
    "months?|years?|percent|dollars?|cents?|euros?|usd|eur|mph|kmh|hz|khz|mhz|ghz|watts?|kw|volts?|degrees?|kb|mb|gb|tb"
)
#: White space of any kind: what Java's \\s takes, the next-line control and the separators of Unicode.
BLANKS = "\t\n\x0b\x0c\r\u0085\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# Both patterns begin with a character that is rare, so most places of a text are passed at once.
NAME_PLACE = r" (?=\p{Lu}\p{Ll})(?<=[\p{Ll}\p{N}],{0,1} )"
UNIT_PLACE = rf"(\d {{0,1}})(?=(?:{UNITS})\b)"
TOKEN = rf"[{NAME_MARK}{UNIT_MARK}]?[\p{{L}}\p{{M}}]+|[$€£]?\d+(?:[.,:]\d+)*%?"


def raw_tokens(text: Column) -> Column:
    """Words and numbers in order, names and units with their mark."""
    # one pass drops marks that are in the text and makes all white space blanks
    plain = F.translate(F.coalesce(text, F.lit("")), BLANKS + NAME_MARK + UNIT_MARK, " " * len(BLANKS))
    clean = F.regexp_replace(plain, "  +", " ")
    marked = F.regexp_replace(F.regexp_replace(clean, UNIT_PLACE, "$1" + UNIT_MARK), NAME_PLACE, " " + NAME_MARK)
    return F.regexp_extract_all(marked, F.lit(TOKEN), F.lit(0))


def placeholder(token: Column) -> Column:
    """<num>, <name> or <unit>; null for a literal word."""
    c = F.ascii(token)
    return (F.when(c == 2, F.lit("<name>")).when(c == 3, F.lit("<unit>"))
            .when(c.between(48, 57) | c.isin(36, 163, 8364) | token.rlike(r"^\p{N}"), F.lit("<num>")))


def folded(token: Column) -> Column:
    """The token without regard to case."""
    return F.lower(F.upper(token))


def literal(tokens: Column) -> Column:
    """Words and numbers as they stand, without their marks and case."""
    return F.transform(tokens, lambda x: folded(F.translate(x, NAME_MARK + UNIT_MARK, "")))


def canonical(tokens: Column) -> Column:
    def one(x: Column) -> Column:
        c = F.ascii(x)
        return (F.when(c > 64, F.when(c.isin(163, 8364), F.lit("<num>")).otherwise(folded(x)))
                .when(c == 2, F.lit("<name>")).when(c == 3, F.lit("<unit>")).otherwise(F.lit("<num>")))

    return F.transform(tokens, one)


def window_hashes(tokens: Column, size: int = WINDOW) -> Column:
    """Hash of every window of ``size`` tokens; of the whole sequence when it is shorter; empty for none."""
    def joined(step: int):
        return lambda x: F.zip_with(x, F.slice(x, step + 1, F.greatest(F.size(x) - step, F.lit(0))), lambda a, b: F.xxhash64(a, b))

    def build(h: Column) -> Column:
        n, out, width = F.size(h), h, 1
        while width < size:  # windows of 1, 2, 4, ... elements: a hash of two overlapping or adjacent windows each time
            step = min(width, size - width)
            out = let(out, joined(step))
            width += step
        return (F.when(n >= size, F.slice(out, 1, n - size + 1))
                .when(n > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>")))

    return let(F.transform(tokens, lambda x: F.xxhash64(x)), build)


def item_windows(items: DataFrame, item_col: str, text_col: str, size: int = WINDOW) -> DataFrame:
    """(item_id, q, hash, fillers, open, plain): the windows an item is searched by.  ``fillers``
    holds null for literal words; ``open`` counts the literals; ``plain`` is false for an
    item without a window of enough literals."""
    tokens = items.select(F.col(f"`{item_col}`").alias("item_id"), raw_tokens(F.col(f"`{text_col}`").cast("string")).alias("raw"))
    tokens = tokens.withColumn("canon", canonical("raw"))
    rows = tokens.select("item_id", "raw", F.posexplode(window_hashes(F.col("canon"), size)).alias("q", "hash"))
    part = F.slice(F.col("raw"), F.col("q") + 1, F.lit(size))
    rows = rows.select("item_id", "q", "hash", F.transform(part, lambda x: F.when(placeholder(x).isNotNull(), x)).alias("fillers"))
    rows = rows.withColumn("open", F.size(F.filter("fillers", lambda x: x.isNull())))
    enough = F.col("open") >= F.least(F.lit(MIN_LITERALS), F.size("fillers"))
    rows = rows.withColumn("enough", enough)
    some = F.max("enough").over(W.partitionBy("item_id"))
    return rows.withColumn("plain", some).filter("enough or not plain").drop("enough")


def literal_windows(items: DataFrame, item_col: str, text_col: str, size: int = WINDOW) -> DataFrame:
    """(item_id, hash): the distinct literal windows of every item."""
    tokens = raw_tokens(F.col(f"`{text_col}`").cast("string"))
    return items.select(F.col(f"`{item_col}`").alias("item_id"), F.explode(window_hashes(literal(tokens), size)).alias("hash")).distinct()


def contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", size: int = WINDOW,
                 similarity: float = SIMILARITY, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per (doc_id, item_id) held: windows of the item, those matched, similarity (of
    the template windows or the literal ones, whichever more of were found), slots along the best alignment, those in agreement, those whose filler changed, and
    ``kind`` ('verbatim' or 'reparameterised').

    Null or empty texts and items hold nothing.  A sequence of fewer than ``size`` tokens is one
    window, so a shorter item is found only as a whole equally short document.  Rows
    repeated under one id count as one text set; null ids are grouped as one id.  An empty
    table on either side gives an empty result; other columns are not read."""
    wanted = stored(spark, item_windows(items, item_col, item_text, size), "item-windows")
    both = wanted.select("item_id", "hash", F.lit(1).alias("shape"), F.lit(0).alias("word")).union(
        literal_windows(items, item_col, item_text, size).select("item_id", "hash", F.lit(0), F.lit(1)))
    probe = stored(spark, both.groupBy("item_id", "hash").agg(F.max("shape").alias("shape"), F.max("word").alias("word")), "probe")
    sizes = probe.groupBy("item_id").agg(F.sum("shape").alias("windows"), F.sum("word").alias("words"))
    few = probe.count() <= broadcast_rows
    small = (lambda df: F.broadcast(df)) if few else (lambda df: df)  # counted above
    text = F.col(f"`{text_col}`").cast("string")
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    hashes = let(raw_tokens(F.col("text")), lambda raw: F.array_distinct(
        F.concat(window_hashes(canonical(raw), size), window_hashes(literal(raw), size))))
    seen = src.select("doc_id", F.explode(hashes).alias("hash"))
    met = seen.join(small(probe), "hash").distinct().groupBy("doc_id", "item_id").agg(
        F.sum("shape").alias("matched"), F.sum("word").alias("said"))
    found = met.join(small(sizes), "item_id")
    found = found.withColumn("literal", F.col("said") >= F.lit(similarity) * F.col("words"))
    found = found.filter(F.col("literal") | (F.col("matched") >= F.lit(similarity) * F.col("windows")))
    found = stored(spark, found.select("doc_id", "item_id", "windows", "matched", "words", "said", "literal"), "candidates")

    # slots: align the candidates' windows with the item's and compare the fillers
    ids = found.select(F.col("doc_id").alias("_cid")).distinct()
    again = src.join(ids, F.col("doc_id").eqNullSafe(F.col("_cid")), "left_semi")
    again = again.distinct().withColumn("raw", raw_tokens(F.col("text")))  # copies under one id say the same
    again = again.select("doc_id", "raw", F.posexplode(window_hashes(canonical(F.col("raw")), size)).alias("p", "hash"))
    again = again.select("doc_id", "p", "hash", F.slice("raw", F.col("p") + 1, F.lit(size)).alias("got"))
    pairs = again.join(small(wanted), "hash").join(
        found.select(F.col("doc_id").alias("_d"), F.col("item_id").alias("_i")),
        F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("item_id").eqNullSafe(F.col("_i")), "left_semi")
    pairs = pairs.withColumn("diagonal", F.col("p") - F.col("q"))
    weight = pairs.groupBy("doc_id", "item_id", "diagonal").agg(F.count("*").alias("on"))
    best = weight.groupBy("doc_id", "item_id").agg(F.max(F.struct("on", -F.col("diagonal"))).alias("m"))
    best = best.select(F.col("doc_id").alias("_d"), F.col("item_id").alias("_i"), (-F.col("m.col2")).alias("_diag"))
    # one document window per item window: the one nearest to the best diagonal
    near = F.struct(F.abs(F.col("diagonal") - F.col("_diag")).alias("far"), "p", "got", "fillers")
    chosen = (pairs.join(best, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("item_id").eqNullSafe(F.col("_i")))
              .groupBy("doc_id", "item_id", "q", "plain").agg(F.min(near).alias("n")))
    slot = F.filter(F.transform("n.fillers", lambda x, k: F.struct((F.col("q") + k).alias("at"), x.alias("want"), F.get("n.got", k).alias("got"))),
                    lambda z: z["want"].isNotNull())
    slots = chosen.select("doc_id", "item_id", "plain", F.explode(slot).alias("s"))
    slots = slots.groupBy("doc_id", "item_id", "plain", "s.at", "s.want").agg(F.min("s.got").alias("got"))  # windows overlap: a slot counts once
    tally = slots.groupBy("doc_id", "item_id", "plain", "want", "got").agg(F.count("*").alias("n"))
    tally = tally.groupBy("doc_id", "item_id", "plain", "want").agg(
        F.sum("n").alias("n"), F.max("n").alias("most"), F.sum(F.when(F.col("want") != F.col("got"), F.col("n")).otherwise(0)).alias("changed"))
    tally = tally.groupBy(F.col("doc_id").alias("_d"), F.col("item_id").alias("_i"), "plain").agg(
        F.sum("n").alias("slots"), F.sum("most").alias("agreeing"), F.sum("changed").alias("changed"))
    out = found.join(tally, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("item_id").eqNullSafe(F.col("_i")), "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("slots", "agreeing", "changed")})
    agree = (F.col("agreeing") >= F.lit(similarity) * F.col("slots")) & (F.coalesce("plain", F.lit(True)) | (F.col("changed") == 0))
    more = F.col("said") * F.col("windows") > F.col("matched") * F.col("words")  # the kind of window of which more were found
    out = out.filter(F.col("literal") | agree).withColumns(
        {"windows": F.when(more, F.col("words")).otherwise(F.col("windows")), "matched": F.when(more, F.col("said")).otherwise(F.col("matched"))})
    return out.select(
        "doc_id", "item_id", "windows", "matched", (F.col("matched") / F.col("windows")).alias("similarity"),
        "slots", "agreeing", "changed", F.when(F.col("changed") == 0, "verbatim").otherwise("reparameterised").alias("kind"))


def remove_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` without the rows whose own text holds an item.  Every text is judged by itself, under
    its hash, so rows that share an id, or have none, do not decide about each other; ``id_col``
    is not read."""
    text = F.col(f"`{text_col}`").cast("string")
    key = F.sha2(text, 256)
    judged = contaminated(spark, docs.select(key.alias("_key"), text.alias("text")), items, id_col="_key", **kw)
    bad = stored(spark, judged.select(F.col("doc_id").alias("_bad")).distinct(), "contaminated")
    return docs.join(bad, key == F.col("_bad"), "left_anti")
