"""Mixing sources to target weights, with DataFrame functions alone.

The words of a source, in order of doc_id, are one stream that is cut into blocks of ``block_words`` words (the last
one shorter).  The mix draws a quota of blocks from each source: first the blocks of one keyed permutation of the
stream, then, for what exceeds the stream, those of a second one; the last block drawn is cut, so that the words
taken are exactly the rounded target and no word is taken more than twice.

The quotas are dealt to output shards by a splitting tree.  A node holds a range of shards and, per source, the
range of draws that belongs to it; its left half gets a multivariate hypergeometric share (one hypergeometric draw
per source, given the ones before), the right half the rest.  Leaves own disjoint ranges of each permutation and
order their blocks by a hash.  All randomness is hashed from the seed, so reruns agree.

Null and empty texts have no words and are never taken.  Null sources are one source, ordered last.  Rows that
repeat a doc_id are rows of their own.  Other columns are ignored; an empty table gives an empty mix.  The tables of
sources and tree nodes have one row per source and per range of shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from unirec.functions.shared import stored
from unirec.llm.placing import with_running_total
from unirec.llm.text import word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
ROUNDS = 24


def uniform(*parts: Column) -> Column:
    """A hash of the parts in the open interval (0, 1)."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / float(1 << 53)


def permuted(index: Column, n: Column, *seed: Column) -> Column:
    """Where a keyed permutation of 0 .. n-1 sends ``index``: swap-or-not, so nothing is sorted.

    Each round pairs every place with one other and swaps the pair or not, by a hash of the pair.
    """
    def one_round(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(r, *seed), n) - x, n)
        return F.when(F.xxhash64(r, F.greatest(x, other), *seed).bitwiseAND(F.lit(1)) == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index, one_round)


def let(value: Column, body) -> Column:
    """``body(value)``, with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def hypergeometric(u: Column, total: Column, good: Column, draws: Column) -> Column:
    """How many of ``draws`` taken from ``total`` are among the ``good``: inversion, outward from the mode.

    The weights follow from their neighbours, starting with 1 at the mode.  The walk covers 12 standard deviations
    and 30 places either way; what is beyond is too small for a double.
    """
    def ranges(c: Column) -> Column:
        n, g, d = c["total"].cast("double"), c["good"].cast("double"), c["draws"].cast("double")
        low = F.greatest(F.lit(0).cast("long"), c["draws"] - c["total"] + c["good"])
        high = F.least(c["good"], c["draws"])
        mode = F.least(high, F.greatest(low, F.floor((g + 1) * (d + 1) / (n + 2)).cast("long")))
        share = g / F.greatest(n, F.lit(1.0))
        span = F.ceil(F.sqrt(d * share * (1 - share) * (n - d) / F.greatest(n - 1, F.lit(1.0))) * 12 + 30).cast("long")
        return F.struct(c["total"].alias("total"), c["good"].alias("good"), c["draws"].alias("draws"), low.alias("low"), high.alias("high"),
                        mode.alias("mode"), span.alias("span"))

    def drawn(c: Column) -> Column:
        rest = c["total"] - c["good"] - c["draws"]

        def up(k: Column) -> Column:  # weight of k+1 over weight of k
            return (c["good"] - k) * (c["draws"] - k) / ((k + 1) * (rest + k + 1))

        def down(k: Column) -> Column:  # weight of k-1 over weight of k
            return k * (rest + k) / ((c["good"] - k + 1) * (c["draws"] - k + 1))

        def places(first: Column, last: Column, by: int) -> Column:
            going = first <= last if by > 0 else first >= last
            return F.when(going, F.sequence(first, last, F.lit(by).cast("long"))).otherwise(F.array().cast("array<bigint>"))

        def weighed(steps: Column, ratio) -> Column:
            begin = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"))
            return F.aggregate(steps, begin, lambda a, k: let(
                a["w"] * ratio(k), lambda w: F.struct(w.alias("w"), (a["s"] + w).alias("s"))))["s"]

        def reached(steps: Column, ratio, aim: Column, by: int) -> Column:
            """The first place where the running weight reaches ``aim``; null if none does."""
            begin = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"), F.lit(None).cast("long").alias("k"))
            return F.aggregate(steps, begin, lambda a, k: let(a["w"] * ratio(k), lambda w: F.struct(
                w.alias("w"), (a["s"] + w).alias("s"),
                F.coalesce(a["k"], F.when(a["s"] + w >= aim, k + by)).cast("long").alias("k"))))["k"]

        ups = places(c["mode"], F.least(c["high"], c["mode"] + c["span"]) - 1, 1)
        downs = places(c["mode"], F.greatest(c["low"], c["mode"] - c["span"]) + 1, -1)
        sums = F.struct(ups.alias("ups"), downs.alias("downs"), weighed(ups, up).alias("above"), weighed(downs, down).alias("below"))

        def chosen(t: Column) -> Column:
            aim = u * (1 + t["above"] + t["below"])
            return F.when(aim <= 1, c["mode"]).when(aim <= 1 + t["above"], F.coalesce(reached(t["ups"], up, aim - 1, 1), c["mode"])).otherwise(
                F.coalesce(reached(t["downs"], down, aim - 1 - t["above"], -1), c["mode"]))

        return let(sums, chosen)

    given = F.struct(total.alias("total"), good.alias("good"), draws.alias("draws"))
    return let(given, lambda g: let(ranges(g), drawn))


def source_targets(sizes: DataFrame) -> DataFrame:
    """``sizes``: source, size.  Returns per source: source, s (its rank), source_size, target, quota (words).

    Targets fill up together, in proportion to the weights, each stopping at its limit: with the sources in order of
    limit over weight, a source stops when the level at which it does is reachable with what is left.
    """
    by_code = Window.orderBy(F.col("source").isNull(), "source")
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("s", (F.row_number().over(by_code) - 1).cast("long"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("s") % len(WEIGHTS) + 1).cast("int"))
    per = per.withColumns({"w": weight, "most": F.col("source_size") * float(MOST)})
    rising = Window.orderBy(F.col("most") / F.col("w"), "s").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    per = per.withColumns({
        "all_": F.sum("source_size").over(whole) * SHARE, "all_w": F.sum("w").over(whole),
        "to_most": F.sum("most").over(rising), "to_w": F.sum("w").over(rising),
    })
    stops = F.col("to_most") + F.col("most") / F.col("w") * (F.col("all_w") - F.col("to_w")) <= F.col("all_")
    per = per.withColumn("stops", stops)
    left = F.col("all_") - F.sum(F.when(F.col("stops"), F.col("most")).otherwise(0.0)).over(whole)
    left_w = F.col("all_w") - F.sum(F.when(F.col("stops"), F.col("w")).otherwise(0.0)).over(whole)
    per = per.withColumn("target", F.when(F.col("stops"), F.col("most")).otherwise(F.least("most", F.col("w") * left / left_w)))
    return per.select("source", "s", "source_size", "target", F.least(F.round("target").cast("long"), F.col("source_size") * MOST).alias("quota"))


def stream_stats(targets: DataFrame, block_words: int, seed: int) -> DataFrame:
    """Per source the number of blocks, the length of the last one, and per pass over the stream (0, 1): the words
    taken, the place of the short block in the permutation, and the number of blocks drawn."""
    b = F.lit(block_words).cast("long")
    t = targets.withColumn("n", F.ceil(F.col("source_size") / b).cast("long"))
    t = t.withColumn("last_len", F.col("source_size") - (F.col("n") - 1) * b)
    t = t.withColumns({"r0": F.least("quota", "source_size"), "r1": F.greatest(F.lit(0), F.col("quota") - F.col("source_size"))})
    for e in (0, 1):
        short = permuted(F.col("n") - 1, F.greatest("n", F.lit(1)), F.lit(seed), F.col("s"), F.lit(e))
        t = t.withColumn(f"short{e}", short)
        r, p = F.col(f"r{e}"), F.col(f"short{e}")
        before = F.least(p + 1, F.ceil(r / b))
        after = F.greatest(F.lit(0), F.least(F.col("n"), F.ceil((r + b - F.col("last_len")) / b)) - (p + 1))
        t = t.withColumn(f"q{e}", F.when(r > 0, before + after).otherwise(0).cast("long"))
    return t


def splitting_tree(stats: DataFrame, shard_blocks: int, seed: int) -> DataFrame:
    """Deals the draws of all sources to shards.  Returns the leaves' ranges: shard, s, first (draw), n (draws)."""
    total = stats.agg(F.coalesce(F.sum(F.col("q0") + F.col("q1")), F.lit(0))).first()[0]  # one number
    shards = max(1, -(-total // shard_blocks))
    part = F.struct("s", F.lit(0).cast("long").alias("first"), (F.col("q0") + F.col("q1")).alias("n"))
    nodes = stats.filter("q0 + q1 > 0").agg(F.array_sort(F.collect_list(part)).alias("parts")).filter(F.size("parts") > 0)
    nodes = nodes.select(F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), "parts")

    def until(x: Column) -> Column:  # draws in the shards before x
        return F.floor(x.cast("decimal(38,0)") * F.lit(total).cast("decimal(38,0)") / F.lit(shards).cast("decimal(38,0)")).cast("long")

    def split(lo: Column, mid: Column, hi: Column, parts: Column) -> Column:
        begin = F.struct((until(hi) - until(lo)).alias("pop"), (until(mid) - until(lo)).alias("draws"), F.array().cast("array<bigint>").alias("left"))

        def one(acc: Column, x: Column) -> Column:
            k = hypergeometric(uniform(F.lit(seed), lo, hi, x["s"]), acc["pop"], x["n"], acc["draws"])
            return F.struct((acc["pop"] - x["n"]).alias("pop"), (acc["draws"] - k).alias("draws"), F.concat(acc["left"], F.array(k)).alias("left"))

        return F.aggregate(parts, begin, one)["left"]

    for level in range((shards - 1).bit_length()):
        if level % 6 == 5:
            nodes = stored(nodes.repartition("lo"), "mix-nodes")
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("long")
        nodes = nodes.withColumn("mid", mid)
        left = F.when(F.col("hi") - F.col("lo") > 1, split(F.col("lo"), F.col("mid"), F.col("hi"), F.col("parts")))
        nodes = nodes.withColumn("left", left)
        halves = F.expr("""
            CASE WHEN left IS NULL THEN array(struct(lo, hi, parts)) ELSE array(
              struct(lo AS lo, mid AS hi, filter(zip_with(parts, left, (p, k) -> struct(p.s AS s, p.first AS first, k AS n)), p -> p.n > 0) AS parts),
              struct(mid AS lo, hi AS hi, filter(zip_with(parts, left, (p, k) -> struct(p.s AS s, p.first + k AS first, p.n - k AS n)), p -> p.n > 0) AS parts)) END""")
        nodes = nodes.select(F.inline(halves))
    return nodes.select(F.col("lo").alias("shard"), F.inline("parts"))


def mix(docs: DataFrame, block_words: int, shard_blocks: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Returns ``(rows, draws)``.

    rows: one per row of ``docs``: row_id, doc_id, size, source_size, target.
    draws: the pieces of documents in the mix: shard, place (of the block in its shard), row_id, first_word, n_words,
    in_pass.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    sized = stored(sized, "mix-sizes")
    stats = stored(stream_stats(source_targets(sized), block_words, seed), "mix-sources")
    # The join is null-safe, and a source may hold a third of the rows: its partition can be split.
    ranked = sized.join(stats, sized["source"].eqNullSafe(stats["source"])).select("doc_id", "size", "s", "source_size", "target")
    placed = with_running_total(ranked, ["s"], ["doc_id", "size"], "size", "start", "mix-places")
    placed = stored(placed.withColumn("row_id", F.monotonically_increasing_id()), "mix-rows")

    b = F.lit(block_words).cast("long")
    pieces = placed.filter("size > 0").select(
        "row_id", "s", "start", "size",
        F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))).alias("i"))
    pieces = pieces.join(stats.drop("source", "source_size", "target"), "s")
    passes = []
    for e in (0, 1):
        place = permuted(F.col("i"), F.col("n"), F.lit(seed), F.col("s"), F.lit(e))
        p = pieces.filter(F.col(f"r{e}") > 0).withColumns({"p": place, "in_pass": F.lit(e)})
        short = F.col(f"short{e}")
        begins = F.col("p") * b - F.when(F.col("p") > short, b - F.col("last_len")).otherwise(0)
        length = F.when(F.col("p") == short, F.col("last_len")).otherwise(b)
        p = p.withColumn("taken", F.least(length, F.greatest(F.lit(0), F.col(f"r{e}") - begins)))
        p = p.withColumn("g", F.col("p") + (F.col("q0") if e else 0))
        passes.append(p)
    both = passes[0].unionByName(passes[1])
    from_ = F.greatest("start", F.col("i") * b)
    to = F.least(F.col("start") + F.col("size"), F.col("i") * b + F.col("taken"))
    both = both.withColumns({"first_word": from_ - F.col("start"), "n_words": to - from_}).filter("n_words > 0")

    leaves = splitting_tree(stats, shard_blocks, seed)
    slots = leaves.select("shard", "s", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("g"))
    order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "shard", "s", "g"), "s", "g")
    slots = slots.withColumn("place", F.row_number().over(order) - 1)
    # A plain merge: the planner takes the exploded ranges for as small as the table they come from.
    draws = both.join(slots.hint("merge"), ["s", "g"]).select("shard", "place", "row_id", "first_word", "n_words", "in_pass")
    return placed.select("row_id", "doc_id", "size", "source_size", "target"), draws


def taken_words(docs: DataFrame, block_words: int, shard_blocks: int, seed: int) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken, and ``blocks``: where its pieces stand in the mix, as
    ``shard:place:first_word:n_words`` in that order, joined by commas (empty for a document that is not taken)."""
    rows, draws = mix(docs, block_words, shard_blocks, seed)
    piece = F.struct("shard", "place", "first_word", "n_words")
    taken = draws.groupBy("row_id").agg(F.sum("n_words").alias("taken"), F.array_sort(F.collect_list(piece)).alias("pieces"))
    blocks = F.array_join(F.transform("pieces", lambda p: F.concat_ws(":", p["shard"], p["place"], p["first_word"], p["n_words"])), ",")
    return rows.join(taken, "row_id", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce(blocks, F.lit("")).alias("blocks"))
