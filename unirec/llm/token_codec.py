"""Token-ID output: canonical length-limited Huffman coding with global counts.

Texts are tokenised, an end id is appended to each, and the documents are dealt by ranges of doc_id.  The counts of
all ids give one canonical code of at most ``MAX_BITS`` bits.  Documents are packed into blocks of at least
``BLOCK_TOKENS`` ids (a document is never cut).  A block is decoded on its own: its header has the documents' ids and
lengths and a bit offset for every ``CHECKPOINT`` ids, so that all those runs are decoded side by side by table.

A block is one binary value; blocks are rows of a Parquet table, which Spark commits as a whole:
``HUF1``, documents u32, ids u64, checkpoints u32, payload bytes u64; then per document id i64, null flag u8, ids u32;
then the checkpoints u64 and the payload.  The code book is a table token, bits beside it.

Null text counts as empty; a null doc_id comes first; rows that repeat a doc_id are documents of their own, in order
of their texts; extra columns are ignored; an empty table gives no blocks.
"""

from __future__ import annotations

import os
import string
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from unirec.functions.shared import stored
from unirec.llm.slices import by_bytes
from unirec.llm.worker_memory import claim, remember

MAX_BITS = 20
BLOCK_TOKENS = 1 << 20
CHECKPOINT = 256
HEADER = struct.Struct("<4sIQIQ")

# --- tokenising -------------------------------------------------------------------------------------------------

# A space beside another space or control character or at an end of the text, or white space beyond ASCII.
UNEVEN = r"[\x00-\x20] | [\x00-\x20]|\A | \z|[\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
CACHE_PIECES = 700_000
LONGEST_KEPT = 100  # bytes of a piece that is remembered
ROW_BYTES = 1 << 15  # of pieces that are encoded in a row, and the last one
ID = np.dtype("<u4")
MARKS = 16  # at the end of a piece that is cut before them
BLANK, LINE = 32, 10
WORD = np.array([chr(b).isascii() and chr(b).isalnum() for b in range(256)])


class Pieces:
    """Pieces and their ids (little-endian u32), in two Arrow arrays: no object for each piece."""

    def __init__(self):
        self.texts = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_binary())

    def __len__(self) -> int:
        return len(self.texts)

    def values(self) -> list[bytes]:
        return self.ids.to_pylist()


class ByteBpe:
    """Ids of whole texts by the tokenizers library, each distinct piece of a batch encoded once.

    Texts are cut before single spaces between two other characters, before single line feeds after a character and
    before another or the end, and between an ASCII letter or digit and the punctuation marks that end a piece.  No match
    of the byte-level pattern crosses these places and none looks beyond them, so the ids of the pieces in a row are the
    ids of the text.  Texts with any other space are encoded whole.
    """

    def __init__(self, path: str, cache: int = CACHE_PIECES):
        self.cache = cache
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # By whether the piece begins with its space or line feed.
        self.known = {True: Pieces(), False: Pieces()}
        # In the byte-level alphabet a token has one character for each byte.
        names = self.tokenizer.get_vocab()
        self.width = np.zeros(max(names.values()) + 1, np.int64)
        self.width[list(names.values())] = list(map(len, names))
        # Added tokens are found before any pattern: their marks end no piece.
        added = "".join(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.tail = np.isin(np.arange(256), [ord(c) for c in string.punctuation if c not in added])

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, ID)

    def row_ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that begin with one space or line feed and have other characters at both ends of the rest, and where
        those of each end: a row of them is encoded at once and cut at the pieces' bytes."""
        offsets, data = _bytes(pieces)
        bounds = [*offsets[np.unique(offsets[:-1] // ROW_BYTES, return_index=True)[1]], offsets[-1]]
        ids = np.concatenate([np.zeros(0, ID), *(self.whole(data[a:b].tobytes().decode()) for a, b in zip(bounds, bounds[1:]))])
        return ids, np.searchsorted(np.cumsum(self.width[ids]), offsets[1:]) + 1

    def new_ids(self, pieces: pa.Array, led: bool) -> pa.Array:
        """Ids of each piece."""
        offsets, data = _bytes(pieces)
        odd = (data[offsets[1:] - 1] <= BLANK) | (data[np.minimum(offsets[:-1] + led, offsets[1:] - 1)] <= BLANK)
        even = pieces.filter(pa.array(~odd))
        ids, ends = self.row_ids(even if led else pc.binary_replace_slice(even, 0, 0, "\n"))
        if not led:  # the line feed is one id
            begin = np.append(0, ends)[:-1]
            ids, ends = np.delete(ids, begin), ends - np.arange(1, len(ends) + 1)
        if not odd.any():
            return _binary(ids, ends)
        alone = [self.whole(p) for p in pieces.filter(pa.array(odd)).to_pylist()]
        both = pa.concat_arrays([_binary(ids, ends), _binary(np.concatenate(alone), np.cumsum(list(map(len, alone))))])
        place = np.empty(len(pieces), np.int64)
        place[np.append(np.flatnonzero(~odd), np.flatnonzero(odd))] = np.arange(len(pieces))
        return both.take(pa.array(place))

    def piece_ids(self, pieces: pa.Array, led: bool) -> pa.Array:
        """Ids of distinct pieces.  Short ones that came first are remembered; others, and those beyond the cache's size, for one
        batch."""
        known = self.known[led]
        found = pc.index_in(pieces, value_set=known.texts)
        missing = pieces.filter(pc.is_null(found))
        if not len(missing):
            return known.ids.take(found)
        new = self.new_ids(missing, led)
        ids = pa.concat_arrays([known.ids, new])
        place = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        place[place < 0] = np.arange(len(known), len(ids))
        if len(known) < self.cache:
            short = pc.less_equal(pc.binary_length(missing), LONGEST_KEPT)
            known.texts, known.ids = (pa.concat_arrays([kept, more.filter(short)]) for kept, more in ((known.texts, missing), (known.ids, new)))
        return ids.take(pa.array(place))

    def cuts(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Where the pieces of the texts begin, and the end of the last one."""
        edge = np.append(data, np.uint8(0))  # no text goes on there
        ends, last = offsets[1:], len(data)
        lines = np.flatnonzero(data == LINE)
        text = np.searchsorted(offsets, lines, "right")
        closes = ends[text - 1] == lines + 1
        lines = lines[(lines > offsets[text - 1]) & (edge[lines - 1] > BLANK) & (closes | (edge[lines + 1] > BLANK))]
        firsts = offsets[:-1][offsets[:-1] < ends]
        begin = np.concatenate([firsts, np.flatnonzero(data == BLANK), lines])
        begin.sort(kind="stable")
        # Marks at the end of a piece, back to a letter or digit; after more marks nothing is cut.
        at = np.append(begin[1:], last)[:len(begin)] - 1
        some = np.flatnonzero(self.tail[data[at]])
        at, floor, tails = at[some], begin[some], []
        for _ in range(MARKS):
            before = data[at - 1]
            inside = at > floor
            tails.append(at[inside & WORD[before]])
            on = inside & self.tail[before]
            at, floor = at[on] - 1, floor[on]
        cuts = np.concatenate([begin, *tails, [last]])
        cuts.sort(kind="stable")
        return cuts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Returns the ids of all texts in a row and the number of ids of each text."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        whole = pc.match_substring_regex(texts, UNEVEN).to_numpy(zero_copy_only=False)
        offsets, data = _bytes(texts if not whole.any() else pc.if_else(pa.array(whole), "", texts))
        cuts = self.cuts(offsets, data)
        coded = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data)).dictionary_encode()
        pieces = coded.dictionary
        begin, letters = _bytes(pieces)
        led = np.isin(letters[begin[:-1]], [BLANK, LINE])
        ids = pa.concat_arrays([self.piece_ids(pieces.filter(pa.array(led == kind)), kind) for kind in (True, False)])
        place = np.empty(len(pieces), np.int64)
        place[np.append(np.flatnonzero(led), np.flatnonzero(~led))] = np.arange(len(pieces))
        ends, out = _bytes(ids.take(pa.array(place)).take(coded.indices))
        out = out.view(ID)
        ends = ends[np.searchsorted(cuts, offsets)] // ID.itemsize
        counts = np.diff(ends)
        if whole.any():
            parts = [out[a:b] for a, b in zip(ends[:-1], ends[1:])]
            for i in np.flatnonzero(whole):
                parts[i] = self.whole(texts[i].as_py())
                counts[i] = len(parts[i])
            out = np.concatenate(parts)
        return out, counts


def _bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and bytes of a large binary or string array."""
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64)[values.offset:values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)
    return offsets - offsets[0], np.frombuffer(data or b"", np.uint8)[offsets[0]:offsets[-1]]


def _binary(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.append(0, ends) * ID.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids.astype(ID))])


@lru_cache(maxsize=2)
def _tokenizer(path: str, cache: int) -> ByteBpe:
    """One per Python worker, with its cache, for all tasks that the worker runs."""
    remember("tokens", _tokenizer.cache_clear)
    return ByteBpe(path, cache)


# --- codes ------------------------------------------------------------------------------------------------------

def code_lengths(counts: dict[int, int], limit: int = MAX_BITS) -> dict[int, int]:
    """Lengths of an optimal prefix code with no length over ``limit`` (package-merge)."""
    leaves = sorted((n, t) for t, n in counts.items())
    if len(leaves) == 1:
        return {leaves[0][1]: 1}
    if len(leaves) > 1 << limit:
        raise ValueError("more symbols than codes of this length")
    weight = np.array([n for n, _ in leaves], dtype=np.float64)
    order_levels = []
    packages = np.zeros(0)
    for _ in range(limit):
        merged = np.concatenate([weight, packages])
        order = np.argsort(merged, kind="stable")
        order_levels.append(order)
        merged = merged[order]
        pairs = len(merged) // 2
        packages = merged[0:2 * pairs:2] + merged[1:2 * pairs:2]
    length = np.zeros(len(leaves), np.int64)
    take = 2 * (len(leaves) - 1)
    for order in reversed(order_levels):
        chosen = order[:take]
        own = chosen[chosen < len(leaves)]
        length[own] += 1
        take = 2 * (take - len(own))
    return {t: int(n) for (_, t), n in zip(leaves, length)}


class Codebook:
    """Canonical codes: ordered by (length, token), consecutive within a length."""

    def __init__(self, lengths: dict[int, int]):
        top = max(lengths, default=0) + 1
        self.length = np.zeros(top, np.int64)
        self.code = np.zeros(top, np.uint64)
        self.bits = max(lengths.values(), default=1)
        self.symbol = np.zeros(1 << self.bits, np.uint32)
        self.width = np.ones(1 << self.bits, np.uint8)
        code, before = 0, 0
        for n, t in sorted((n, t) for t, n in lengths.items()):
            code <<= n - before
            before = n
            self.length[t], self.code[t] = n, code
            at = code << (self.bits - n)
            self.symbol[at:at + (1 << (self.bits - n))] = t
            self.width[at:at + (1 << (self.bits - n))] = n
            code += 1

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of the ids, and the bit offset of every ``CHECKPOINT``-th of them."""
        size = self.length[ids]
        ends = np.cumsum(size)
        begin = ends - size
        total = int(ends[-1]) if len(ids) else 0
        words = np.zeros(total // 64 + 3, np.uint64)
        code, word, inside = self.code[ids], begin >> 6, begin & 63
        room = 64 - inside - size
        high = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
        if len(ids):
            heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            words[word[heads]] = np.bitwise_or.reduceat(high, heads)
            over = room < 0
            words[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
        return words.byteswap().tobytes()[: (total + 7) // 8], begin[::CHECKPOINT].astype(np.uint64)

    def unpack(self, payload: np.ndarray, marks: np.ndarray, n: int) -> np.ndarray:
        """All runs between checkpoints are read in step."""
        padded = np.append(payload, np.zeros(8, np.uint8)).astype(np.uint32)
        windows = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]  # 32 bits from each byte on
        at = marks.astype(np.int64)
        out = np.zeros((CHECKPOINT, len(at)), np.uint32)
        last = n - (len(at) - 1) * CHECKPOINT
        for k in range(min(CHECKPOINT, n)):
            a = at[:len(at) - (k >= last)]
            window = (windows[a >> 3] << (a & 7).astype(np.uint32)) >> np.uint32(32 - self.bits)
            out[k, :len(a)] = self.symbol[window]
            a += self.width[window]
        return out.T.reshape(-1)[:n]


def pack_block(book: Codebook, doc_ids: np.ndarray, nulls: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    payload, marks = book.pack(ids)
    head = HEADER.pack(b"HUF1", len(sizes), len(ids), len(marks), len(payload))
    return b"".join([head, doc_ids.astype("<i8").tobytes(), nulls.astype(np.uint8).tobytes(), sizes.astype("<u4").tobytes(),
                     marks.astype("<u8").tobytes(), payload])


def unpack_block(book: Codebook, block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, null flags, sizes and ids of a block."""
    magic, docs, n, marks, size = HEADER.unpack_from(block)
    if magic != b"HUF1":
        raise ValueError("not a block of token ids")
    at = HEADER.size
    parts = []
    for kind, count in (("<i8", docs), ("u1", docs), ("<u4", docs), ("<u8", marks), ("u1", size)):
        parts.append(np.frombuffer(block, kind, count, at))
        at += parts[-1].nbytes
    return *parts[:3], book.unpack(parts[4], parts[3], n)


# --- Spark ------------------------------------------------------------------------------------------------------

SLICE = 512  # rows of a batch that are worked on at a time
ENCODED_BYTES = 8 << 20  # of texts that are tokenised at a time: a word is met more often in a larger batch


def tokenise(docs: DataFrame, tokenizer_path: str, end_id: int, cache: int = CACHE_PIECES) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian u16 where every id fits, else u32), dealt and sorted by doc_id, with the
    part of the order a row is in and the number of ids before it in that part."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("tokens")
        bpe = _tokenizer(tokenizer_path, cache)
        kind = np.uint16 if bpe.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        before = 0
        for whole in batches:
            for batch in by_bytes(whole, 1, ENCODED_BYTES):
                ids, counts = bpe.encode(batch.column(1))
                n = len(counts)
                ends = np.cumsum(counts + 1)
                out = np.insert(ids.astype(kind), np.cumsum(counts), end_id)
                offsets = np.append(0, ends) * out.itemsize
                data = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)])
                starts = before + ends - counts - 1
                before += int(ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts + 1), data.cast(pa.binary()), batch.column(2), pa.array(starts)],
                    names=["doc_id", "n_tokens", "ids", "part", "before"])

    # Dealt before they are tokenised: to find the ranges, Spark reads its input once more.
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id")
    dealt = dealt.sortWithinPartitions("doc_id", "text").withColumn("part", F.spark_partition_id())
    return stored(dealt.mapInArrow(encode, "doc_id long, n_tokens long, ids binary, part int, before long"), "token-ids")


def token_counts(ids: DataFrame, wide: bool) -> DataFrame:
    """token, n over the whole table."""
    kind = np.uint32 if wide else np.uint16

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            column = batch.column(0)
            for at in range(0, len(column), SLICE):
                flat = np.frombuffer(b"".join(column.slice(at, SLICE).to_pylist()), kind)
                n = np.bincount(flat, minlength=len(total))
                n[:len(total)] += total
                total = n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["token", "n"])

    return ids.select("ids").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def write_ids(docs: DataFrame, tokenizer_path: str, end_id: int, path: str, cache: int = CACHE_PIECES) -> None:
    """Writes ``path/blocks`` and ``path/codes``.  A worker remembers the ids of up to ``cache`` pieces of either kind: fewer
    take less memory and more time."""
    import tokenizers

    spark = docs.sparkSession
    vocabulary = tokenizers.Tokenizer.from_file(tokenizer_path).get_vocab_size()
    wide = vocabulary > 1 << 16
    kind = np.uint32 if wide else np.uint16
    ids = tokenise(docs, tokenizer_path, end_id, cache)
    counts = {r.token: r.n for r in token_counts(ids, wide).collect()}  # at most one row per id of the vocabulary
    lengths = code_lengths(counts) if counts else {}
    spark.createDataFrame(sorted(lengths.items()), "token long, bits int").write.parquet(f"{path}/codes")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ids.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(lengths)
        held: list = []
        n_held, next_start = 0, None

        def close():
            start = held[0][0]
            sizes = np.array([h[3] for h in held])
            flat = np.frombuffer(b"".join(h[4] for h in held), kind)
            block = pack_block(book, np.array([h[1] for h in held]), np.array([h[2] for h in held]), sizes, flat)
            return pa.RecordBatch.from_arrays([pa.array([start]), pa.array([len(flat)]), pa.array([block])], names=["start", "n_tokens", "block"])

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                for doc, n, data, start in zip(*(c.to_pylist() for c in batch.slice(at, SLICE).columns)):
                    if held and (n_held >= BLOCK_TOKENS or start != next_start):
                        yield close()
                        held, n_held = [], 0
                    held.append((start, doc or 0, doc is None, n, data))
                    n_held += n
                    next_start = start + n
        if held:
            yield close()

    # One row per shuffle partition, never more: that is the bound of what is broadcast.
    placed = ids.join(F.broadcast(parts), "part").select("doc_id", "n_tokens", "ids", (F.col("before") + F.col("offset")).alias("start"))
    placed.mapInArrow(blocks, "start long, n_tokens long, block binary").write.parquet(f"{path}/blocks")


def read_ids(spark, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    lengths = {r.token: r.bits for r in spark.read.parquet(f"{path}/codes").collect()}  # the vocabulary at most

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(lengths)
        for batch in batches:
            for first, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                docs, nulls, sizes, ids = unpack_block(book, block.as_py())
                ends = np.cumsum(sizes.astype(np.int64))
                flat = ids.astype("<u4")
                crc = [zlib.crc32(flat[e - n:e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, mask=nulls.astype(bool)), pa.array(first + ends - sizes), pa.array(sizes.astype(np.int64)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    blocks = spark.read.schema("start long, n_tokens long, block binary").parquet(f"{path}/blocks").select("start", "block")
    return blocks.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")
