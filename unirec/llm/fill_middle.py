"""Fill-in-the-middle transformation of documents, as a pyarrow.compute pipeline.

A text of n code points is cut at two places that its doc_id decides: prefix, middle, suffix.  ``psm`` writes prefix,
suffix, middle with a mark before each, ``spm`` suffix, prefix, middle, ``plain`` the text as it is.  Texts that
are empty, hold a mark or are not chosen by the rate stay plain, so every output can be read back without doubt.

In a batch the texts become list arrays of units (one code point each).  The units are flattened with the index of
their parent, numbered inside it, given the role that the number decides, filtered by role, made lists again and joined;
``binary_join_element_wise`` puts the pieces and marks together.  A batch is cut into slices of ``SLICE_BYTES``; a longer
text is worked on in segments of that size, so memory does not follow its length.

Null texts count as empty and a null doc_id as no digits.  Rows that repeat are transformed each (equal doc_ids draw
equal numbers).  Extra columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unirec.llm.slices import by_bytes

SLICE_BYTES = 2 << 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


@dataclass(frozen=True)
class Rates:
    """Percentages: documents that are transformed, and those of them written suffix first; the salt of the draws."""

    transformed: int = 90
    suffix_first: int = 20
    salt: int = 1


def draw(salt: int, number: int) -> Column:
    """The ``number``-th group of eight hexadecimal digits of the document's hash."""
    key = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(key, 256), 8 * number - 7, 8), 16, 10).cast("long")


def with_cuts(docs: DataFrame, rates: Rates) -> DataFrame:
    """doc_id, n, form, first and second cut, text."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("n", F.char_length("text").cast("long"))
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    plain = (F.col("n") == 0) | marked | (draw(rates.salt, 3) % 100 >= rates.transformed)
    form = F.when(plain, "plain").when(draw(rates.salt, 4) % 100 < rates.suffix_first, "spm").otherwise("psm")
    a, b = (draw(rates.salt, k) % (F.col("n") + 1) for k in (1, 2))
    return rows.select("doc_id", "n", form.alias("form"), F.least(a, b).alias("first"), F.greatest(a, b).alias("second"), "text")


def unit_lists(texts: pa.Array) -> pa.ListArray:
    """The code points of each text; the units share the bytes of the texts."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    begin = np.flatnonzero((data[offsets[0]:offsets[-1]] & 0xC0) != 0x80) + offsets[0]
    bounds = np.append(begin, offsets[-1]).astype(np.int32)
    units = pa.Array.from_buffers(pa.string(), len(begin), [None, pa.py_buffer(bounds), texts.buffers()[2]])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(begin, offsets), pa.int32()), units)


def pieces(texts: pa.Array, first: pa.Array, second: pa.Array) -> list[pa.Array]:
    """Prefix, middle and suffix of each text."""
    lists = unit_lists(texts)
    units, parent = lists.flatten(), pc.list_parent_indices(lists)
    ordinal = pc.subtract(pa.array(np.arange(len(units))), lists.offsets.take(parent))
    after = [pc.greater_equal(ordinal, cut.take(parent)) for cut in (first, second)]
    roles = [pc.invert(after[0]), pc.and_not(after[0], after[1]), after[1]]
    out = []
    for role in roles:
        counts = np.bincount(parent.filter(role).to_numpy(), minlength=len(lists))
        rebuilt = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), units.filter(role))
        out.append(pc.binary_join(rebuilt, ""))
    return out


def long_pieces(text: pa.Array, first: int, second: int) -> list[pa.Array]:
    """``pieces`` of one long text, segment by segment (segments end where a code point ends)."""
    offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + 2]
    data = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0]:offsets[1]]
    found, at, units = [], 0, 0
    while at < len(data):
        end = min(at + SLICE_BYTES, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        part = pa.array([data[at:end].tobytes()], pa.binary()).cast(pa.string())
        found.append(pieces(part, pa.array([first - units]), pa.array([second - units])))
        units += int(np.count_nonzero((data[at:end] & 0xC0) != 0x80))
        at = end
    return [pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), pa.concat_arrays(role)), "") for role in zip(*found)]


def assembled(texts: pa.Array, form: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
    """The outputs of the texts."""
    if len(texts) == 1 and texts.nbytes > SLICE_BYTES and form[0].as_py() != "plain":
        prefix, middle, suffix = long_pieces(texts, first[0].as_py(), second[0].as_py())
    else:
        prefix, middle, suffix = pieces(texts, first, second)
    psm = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
    spm = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
    marked = pc.if_else(pc.equal(form, "spm"), spm, psm)
    return pc.if_else(pc.equal(form, "plain"), texts, marked)


def fill_in_middle(docs: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars (null where plain) and output, a row for each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes(whole, 5, SLICE_BYTES):
                form, first, second, text = (batch.column(k) for k in range(2, 6))
                plain = pc.equal(form, "plain")
                chars = [pc.if_else(plain, pa.scalar(None, pa.int64()), c) for c in (first, pc.subtract(second, first))]
                columns = [batch.column(0), batch.column(1), form, *chars, assembled(text, form, first, second)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = with_cuts(docs, rates)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    cut = F.split(output, "<[PSM]>")
    psm = F.concat(cut[1], cut[3], cut[2])
    spm = F.concat(cut[2], cut[3], cut[1])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
