"""Benchmark decontamination by winnowing, with DataFrame functions alone.

Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case.  An item's windows are its runs of
13 words; an item with fewer is one window.  Of every ``w`` k-gram hashes in a row a text keeps the smallest, so any
shared span of ``k + w - 1`` words leaves a common fingerprint.  Fingerprints of documents and items are joined, and
each hit is extended along its diagonal by comparing the words themselves, so a hash collision costs time only.

With k = 8, w = 6 a span of 13 words is found.  Shorter items have classes of their own (k = 8, 4, 2, 1, w by the
shortest item of the class), used only if the benchmark has such items.

Null and empty texts have no words; items without words have no windows.  Rows that repeat a doc_id are told apart by
their text; equal rows each get the same result.  Repeated items count once; items without an id mark words but are
not counted.  Extra columns are ignored.  An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from unirec.functions.shared import stored
from unirec.llm.text import CONTENT_WORD, lower_ascii

SPAN = 13
# (class, shortest, longest, k); w = shortest item of the class - k + 1.
CLASSES = ((0, SPAN, None, 8), (1, 8, SPAN - 1, 8), (2, 4, 7, 4), (3, 2, 3, 2), (4, 1, 1, 1))
POSITION_BITS = 31
POSITION = (1 << POSITION_BITS) - 1
HASH_BITS = 29


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(CONTENT_WORD), F.lit(0))


def _pairs(values: Column, step: int, combine) -> Column:
    """combine(values[i], values[i + step]) for all i."""
    n = F.greatest(F.size(values) - step, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(1 + step), n), combine)


def with_fingerprints(df: DataFrame, classes: list[tuple[int, int, int]]) -> DataFrame:
    """Adds ``prints``: the kept k-grams of the column ``words``, packed as class, hash and position.

    ``classes``: (class, k, w).  Both k-gram hashes and sliding minima are made by doubling: a run of 8 from two of 4.
    """
    df = df.withColumn("_h1", F.transform("words", lambda x: F.xxhash64(x)))
    for k in (2, 4, 8):
        if max(k_ for _, k_, _ in classes) >= k:
            df = df.withColumn(f"_h{k}", _pairs(F.col(f"_h{k // 2}"), k // 2, lambda x, y: F.xxhash64(x, y)))
    kept = []
    for number, k, w in classes:
        packed = F.transform(F.col(f"_h{k}"), lambda x, i: F.shiftleft(
            F.shiftrightunsigned(x, 64 - HASH_BITS).bitwiseOR(F.lit(number << HASH_BITS).cast("long")), POSITION_BITS).bitwiseOR(i.cast("long")))
        least, run = f"_m{number}", 1
        df = df.withColumn(least, packed)
        while run < w:
            step = min(run, w - run)
            df = df.withColumn(least + f"_{run + step}", _pairs(F.col(least), step, lambda x, y: F.least(x, y)))
            least, run = least + f"_{run + step}", run + step
        kept.append(F.array_distinct(F.col(least)))
    df = df.withColumn("prints", kept[0] if len(kept) == 1 else F.concat(*kept))
    return df.drop(*[c for c in df.columns if c.startswith(("_h", "_m"))])


def benchmark_items(benchmark: DataFrame) -> tuple[DataFrame, list[tuple[int, int, int]]]:
    """The distinct items with words, and the classes that they need."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0).distinct()
    items = stored(items.withColumn("item", F.monotonically_increasing_id()), "items")
    n = F.size("words")
    inside = {c: n >= low if high is None else n.between(low, high) for c, low, high, _ in CLASSES}
    shortest = items.agg(*[F.min(F.when(inside[c], n)).alias(str(c)) for c in inside]).first()
    classes = [(c, k, (SPAN if c == 0 else shortest[str(c)]) - k + 1) for c, _, _, k in CLASSES if shortest[str(c)] is not None]
    label = F.coalesce(*[F.when(inside[c], F.lit(c)) for c in inside])
    return items.withColumn("class", label), classes


def find_windows(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Returns ``(rows, hits)``: per row of ``docs`` doc_id, text_key, n_words; and per occurrence of a window in a
    document doc_id, text_key, item_id, first, length (in words, from 0)."""
    items, classes = benchmark_items(benchmark)
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    texts = keyed.select("doc_id", "text_key", words_of(F.col("text")).alias("words"))
    if not classes:
        rows = texts.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"))
        none = rows.limit(0).select("doc_id", "text_key", F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id"),
                                    F.lit(0).alias("first"), F.lit(0).alias("length"))
        return rows, none
    # One negative element per document carries its number of words through the explode.
    prints = with_fingerprints(texts, classes).select(
        "doc_id", "text_key", F.explode(F.concat(F.array(-1 - F.size("words").cast("long")), F.col("prints"))).alias("v"))
    prints = prints.withColumn("print", F.when(F.col("v") >= 0, F.shiftright("v", POSITION_BITS)))
    # Exploded behind a first element of its own: of the bare column the optimiser would infer a filter, for which it copies
    # the whole chain of expressions into itself (a plan of megabytes).
    known = with_fingerprints(items, classes).select(
        "item", "class", F.explode(F.concat(F.array(F.lit(-1).cast("long")), F.col("prints"))).alias("i")).filter("i >= 0")
    known = known.withColumn("print", F.shiftright("i", POSITION_BITS)).filter(F.shiftright("print", HASH_BITS) == F.col("class"))
    known = stored(known.select("print", "item", F.col("i").bitwiseAND(F.lit(POSITION)).alias("at_item")), "item-prints")
    met = prints.join(known, "print", "left").filter((F.col("v") < 0) | F.col("item").isNotNull())
    met = stored(met.select("doc_id", "text_key", "v", "item", "at_item"), "prints-met")

    rows = met.filter("v < 0").select("doc_id", "text_key", (-1 - F.col("v")).alias("n_words"))
    diagonal = (F.col("v").bitwiseAND(F.lit(POSITION)) - F.col("at_item")).cast("int")
    lines = met.filter("v >= 0").select("doc_id", "text_key", "item", diagonal.alias("d")).distinct()
    lines = lines.join(items.select("item", "item_id", F.col("words").alias("item_words")), "item")
    lines = lines.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("d", "item_id", "item_words")).alias("lines"))
    lines = stored(lines, "diagonals")
    # Always by merge: a switch to a broadcast at some size would change what is shuffled.
    near = keyed.alias("k").join(lines.alias("l").hint("merge"), F.col("k.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("k.text_key") == F.col("l.text_key")))
    near = near.select("k.doc_id", "k.text_key", words_of(F.col("k.text")).alias("words"), "l.lines").dropDuplicates(["doc_id", "text_key"])

    def extended(line: Column, words: Column) -> Column:
        """Starts of the windows on a diagonal whose words are all equal."""
        length = F.least(F.size(line["item_words"]), F.lit(SPAN))
        first = F.greatest(F.lit(0), -line["d"])
        last = F.least(F.size(line["item_words"]), F.size(words) - line["d"]) - length
        places = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        same = F.filter(places, lambda j: F.slice(words, j + line["d"] + 1, length) == F.slice(line["item_words"], j + 1, length))
        return F.transform(same, lambda j: F.struct(line["item_id"].alias("item_id"), (j + line["d"]).alias("first"), length.alias("length")))

    hits = near.select("doc_id", "text_key", F.inline(F.flatten(F.transform("lines", lambda x: extended(x, F.col("words"))))))
    return rows, hits


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_key."""
    rows, hits = find_windows(docs, benchmark)
    hits = stored(hits.distinct(), "window-hits")
    before = Window.partitionBy("doc_id", "text_key").orderBy("first", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("first") + F.col("length")
    covered = hits.withColumn("reach", F.coalesce(F.max(end).over(before), F.lit(0)))
    covered = covered.withColumn("new", F.greatest(F.lit(0), end - F.greatest("first", "reach")))
    per = covered.groupBy("doc_id", "text_key").agg(
        F.sum("new").alias("n_hit"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    out = rows.alias("r").join(per.alias("p"), F.col("r.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("r.text_key") == F.col("p.text_key")), "left")
    n_hit = F.coalesce("p.n_hit", F.lit(0)).cast("long")
    return out.select(
        "r.doc_id", "r.n_words", n_hit.alias("n_hit"), F.coalesce(F.size("p.ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "p.ids"), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("r.n_words"))).alias("contaminated"), "r.text_key")
