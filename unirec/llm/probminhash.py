"""Near-duplicates by ProbMinHash, banding and verification.

Shingles are runs of five words (letters, digits and characters beyond ASCII, A-Z in lower case) with the weight
1 + ln(count).  Every shingle is a Poisson process of its weight whose arrivals fall on random registers; a register
keeps the shingle that arrives first, and a text stops when no later arrival can be first anywhere.  Two registers
agree with the probability Jaccard of the two texts.  120 registers make 24 bands of 5.  A text whose counts are not
all 1 is signed a second time with the weight 1 of every shingle, by which a text whose counts are all 1 is signed
anyway: those registers agree with the plain Jaccard, and a pair at 0.8 is missed with a probability of 7e-5 whatever
its counts are.

Texts that share a band are candidates.  Texts with equal words are one node.  A candidate pair is linked when the
Jaccard of their shingle sets, worked out from the texts, is 0.8 or more; classes are the connected components.

No pair of a large bucket is emitted: first each text is compared with one pivot per bucket; buckets that still hold
several classes are then compared completely, in blocks of texts, and a block returns a forest of links.

Texts without words are classes of their own.  Rows that repeat a doc_id are told apart by their text.  A class is
named by its smallest doc_id (null ids are larger than all).  Extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unirec.functions.shared import stored
from unirec.llm.bytewords import CONTENT, mixed, sequence_digests, shingles, word_hashes, word_spans
from unirec.llm.slices import by_bytes
from unirec.llm.worker_memory import claim

WORDS = 5
BANDS = 24
BAND_ROWS = 5
REGISTERS = BANDS * BAND_ROWS
SHINGLE_BITS = 46
ROWS = 2000  # texts of a batch that are worked on at a time; at most 2 ** (64 - SHINGLE_BITS)
SLICE_BYTES = 1 << 20  # of texts that are worked on at a time
BLOCK = 192  # texts on each side of a block of comparisons


def text_shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their counts: shingle, owner, count; word counts and digests of the texts."""
    data, begin, end, counts = word_spans(texts, CONTENT)
    hashes = word_hashes(data, begin, end)
    found, owner = shingles(hashes, counts, WORDS)
    key = owner.astype(np.uint64) << np.uint64(SHINGLE_BITS) | found >> np.uint64(64 - SHINGLE_BITS)
    key.sort()
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    times = np.diff(np.append(heads, len(key)))
    key = key[heads]
    return key & np.uint64((1 << SHINGLE_BITS) - 1), (key >> np.uint64(SHINGLE_BITS)).astype(np.int64), times, counts, sequence_digests(hashes, counts)


def sliced_shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and owners of many texts, worked out slice by slice."""
    found, first = [], 0
    for part in by_bytes(pa.RecordBatch.from_arrays([texts], names=["text"]), 0, SLICE_BYTES, ROWS):
        shingle, owner = text_shingles(part.column(0))[:2]
        found.append((shingle, owner + first))
        first += part.num_rows
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def registers(shingle: np.ndarray, owner: np.ndarray, weight: np.ndarray, texts: int, m: int = REGISTERS) -> np.ndarray:
    """texts x m: the shingle that arrives first at each register (0 for texts without shingles)."""
    best = np.full(texts * m, np.inf)
    kept = np.zeros(texts * m, np.uint64)
    time, serial = np.zeros(len(shingle)), 0
    width = 1
    with np.errstate(over="ignore"):
        while len(shingle):
            number = np.arange(serial, serial + width, dtype=np.uint64)[None, :] * np.uint64(0xD1342543DE82EF95)
            bits = mixed(shingle[:, None] + mixed(number + np.uint64(1)))
            step = -np.log(((bits >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)) / weight[:, None]
            at = time[:, None] + np.cumsum(step, 1)
            place = owner[:, None] * m + ((mixed(bits) >> np.uint64(40)) * np.uint64(m) >> np.uint64(24)).astype(np.int64)
            time = at[:, -1]
            at, place = at.reshape(-1), place.reshape(-1)
            near = np.flatnonzero(at < best[place])
            at, place = at[near], place[near]
            np.minimum.at(best, place, at)
            first = at == best[place]
            kept[place[first]] = shingle[near[first] // width]
            latest = best.reshape(texts, m).max(1)
            going = np.flatnonzero(time < latest[owner])
            shingle, owner, weight, time = shingle[going], owner[going], weight[going], time[going]
            serial += width
            width = min(32, max(1, (1 << 21) // max(1, len(shingle))), width * 2)
    return kept.reshape(texts, m)


def banded(kept: np.ndarray) -> np.ndarray:
    """texts x BANDS: one number for the registers of each band."""
    kept = kept.reshape(-1, BANDS, BAND_ROWS)
    with np.errstate(over="ignore"):
        band = np.broadcast_to(mixed(np.arange(1, BANDS + 1, dtype=np.uint64)), kept.shape[:2])
        for k in range(BAND_ROWS):
            band = mixed(band * np.uint64(0x9E3779B97F4A7C15) + kept[:, :, k])
    return band


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, node (digest of the words; null without words) and bands."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("near")
        for whole in batches:
            for batch in by_bytes(whole, 2, SLICE_BYTES, ROWS):
                shingle, owner, times, counts, digests = text_shingles(batch.column(2))
                blank = counts == 0
                weighted = banded(registers(shingle, owner, 1 + np.log(times), len(counts)))
                # Repeated shingles: the texts are numbered anew for the second signing.
                again = np.zeros(len(counts), bool)
                again[owner[times > 1]] = True
                number, of = np.cumsum(again) - 1, again[owner]
                plain = weighted.copy()
                plain[again] = banded(registers(shingle[of], number[owner[of]], np.ones(int(of.sum())), int(again.sum())))
                # A band stands once in a text.
                wanted = np.stack([np.broadcast_to(~blank[:, None], weighted.shape), plain != weighted], 1)
                node = pa.array([d.tobytes() for d in digests], pa.binary(), mask=blank)
                offsets = np.append(0, np.cumsum(wanted.sum((1, 2)))).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.stack([weighted, plain], 1)[wanted].view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), node, bands], names=["doc_id", "text_key", "node", "bands"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    schema = rows.drop("text").schema.add("node", "binary").add("bands", T.ArrayType(T.LongType()))
    return rows.mapInArrow(sign, schema)


def linked_pairs(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts have a Jaccard of 0.8 or more."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes(whole, [2, 3], SLICE_BYTES, ROWS):
                n = batch.num_rows
                a, b = (text_shingles(batch.column(c))[:2] for c in (2, 3))
                key = np.sort(np.concatenate([o.astype(np.uint64) << np.uint64(SHINGLE_BITS) | s for s, o in (a, b)]))
                common = np.bincount((key[1:][key[1:] == key[:-1]] >> np.uint64(SHINGLE_BITS)).astype(np.int64), minlength=n)
                union = np.bincount(a[1], minlength=n) + np.bincount(b[1], minlength=n) - common
                yield batch.select(["a", "b"]).filter(pa.array(5 * common >= 4 * union))

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(verify, "a binary, b binary")


def block_links(rows: pd.DataFrame) -> pd.DataFrame:
    """A forest of links between the labelled classes of a block; all pairs of texts are compared."""
    rows = rows.drop_duplicates("node")
    shingle, owner = sliced_shingles(pa.array(rows["text"], pa.large_string()))
    size = np.bincount(owner, minlength=len(rows))
    values, column = np.unique(shingle, return_inverse=True)
    shared = np.bincount(column) > 1
    rank = np.cumsum(shared) - 1
    inside = shared[column]
    column, owner = rank[column[inside]], owner[inside]
    common = np.zeros((len(rows), len(rows)), np.float32)
    for start in range(0, int(shared.sum()), 4096):
        part = (column >= start) & (column < start + 4096)
        matrix = np.zeros((len(rows), 4096), np.float32)
        matrix[owner[part], column[part] - start] = 1
        common += matrix @ matrix.T
    common = np.rint(common).astype(np.int64)
    label = pd.factorize(rows["label"])[0]
    close = 5 * common >= 4 * (size[:, None] + size[None, :] - common)
    close &= label[:, None] < label[None, :]
    top = list(range(len(rows)))

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    out, node = [], rows["node"].to_numpy()
    for i, j in np.argwhere(close):
        a, b = find(label[i]), find(label[j])
        if a != b:
            top[a] = b
            out.append((node[i], node[j]))
    return pd.DataFrame(out, columns=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node of each connected component; only nodes that have a link."""
    both = stored(links.union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low"))
        step = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "low").alias("label"))
        step = stored(step, "labels")
        up = step.select(F.col("node").alias("label"), F.col("label").alias("top"))
        new = stored(step.join(up, "label", "left").select("node", F.coalesce("top", "label").alias("label"), "was"), "labels")
        if new.filter(F.col("label") != F.col("was")).isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, class_id, class_size, kept (one row of a class), text_key."""
    signed = stored(signatures(docs), "signatures")
    source = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")).alias("source")
    nodes = signed.filter("node IS NOT NULL").groupBy("node").agg(F.first("bands").alias("bands"), source)
    nodes = stored(nodes, "near-nodes")
    band_rows = nodes.select("node", F.explode("bands").alias("band"))
    mark = F.xxhash64("node")
    buckets = band_rows.groupBy("band").agg(
        F.min("node").alias("pivot"), F.count("*").alias("n"), F.bit_xor(mark).alias("marks"), F.bit_xor(F.xxhash64(mark)).alias("marks2"))
    # Buckets with the same texts count once.
    buckets = buckets.filter("n > 1").groupBy("n", "pivot", "marks", "marks2").agg(F.min("band").alias("band")).drop("marks", "marks2")
    buckets = stored(buckets, "buckets")
    members = stored(band_rows.join(buckets, "band"), "bucket-members")
    wanted = members.select("node").distinct().join(nodes.select("node", "source.doc_id", "source.text_key"), "node")
    own = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).alias("d")
    wanted = stored(wanted, "near-wanted").alias("w").hint("merge")  # the same way at every size
    texts = own.join(wanted, F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.text_key") == F.col("w.text_key")))
    texts = stored(texts.select("w.node", "d.text").dropDuplicates(["node"]), "near-texts")

    to_pivot = members.filter(F.col("node") != F.col("pivot")).select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    links = stored(linked_pairs(to_pivot, texts), "pivot-links")
    labels = components(links)

    labelled = members.filter("n > 2").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = stored(labelled.select("band", "n", "node", "label"), "bucket-labels")
    mixed_ = labelled.groupBy("band").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l != h").select("band")
    chunks = F.ceil(F.col("n") / BLOCK).cast("int")
    open_ = labelled.join(mixed_, "band").withColumn("c", F.pmod(F.xxhash64("node", F.lit(1)), chunks).cast("int"))
    against = F.sequence(F.lit(0), chunks - 1)
    blocks = open_.select("band", "node", "label", "c", F.explode(against).alias("o"))
    blocks = blocks.select("band", "node", "label", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j")).join(texts, "node")
    more = blocks.groupBy("band", "i", "j").applyInPandas(block_links, "a binary, b binary")
    more = stored(more.distinct(), "block-links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    # A text without words has a label of its own.
    placed = signed.select("doc_id", "text_key", "node").join(labels, "node", "left")
    alone = F.concat(F.lit("-").cast("binary"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"), F.lit("-").cast("binary"), F.col("text_key").cast("string").cast("binary"))
    placed = placed.withColumn("label", F.coalesce("label", "node", alone))
    rows = stored(placed.groupBy("label", "doc_id", "text_key").agg(F.count("*").alias("copies")), "near-rows")
    source = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")).alias("s")
    classes = stored(rows.groupBy("label").agg(source, F.sum("copies").alias("class_size")), "classes")
    out = rows.join(classes, "label").select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    kept = F.col("doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("text_key") == F.col("s.text_key")) & (F.col("copy") == 1)
    return out.select("doc_id", F.col("s.doc_id").alias("class_id"), "class_size", kept.alias("kept"), "text_key")
