"""Vector code compression: product codes whose codebooks come from active-entry Lloyd rounds in exact integers.

A component x becomes floor(scale * x); a vector is cut into equal parts, each with a codebook of its own.  The codebooks
start as the parts of the vectors with the smallest vec_ids.  A round gives every part the nearest entry (squared
Euclidean distance, the lower index of equal ones) and replaces each entry by the componentwise floor of the mean of its
parts; entries without parts stay.

Every row keeps, part by part, its entry and the exact distance to it.  An entry that did not move in the last update is
as far as it was: then only the entries that moved are compared with the stored distance.  Parts whose entry moved
compare all.  Both give the lexicographically smallest (distance, index).

A round is one pass: its task writes the rows with their new entries and, for each entry, the sums and counts of the
task's parts; the driver gets one sum per entry and component.  The table of the round before is then removed.  Numbers
whose squares do not fit a double exactly are worked out in Python's integers, and such parts keep no distance.

Rows without a usable vector are dropped: null, empty, with a null or non-finite component (a double beyond the range of
32-bit floats is one), of a length that the parts do not divide, or of another length than most (of equally frequent
lengths the shorter counts).  Rows that repeat count each; among equal vec_ids the vector decides, null vec_ids come
last.  With fewer vectors than entries there are fewer entries.  Equal labels, null among them, share ``label_error``; sums beyond 64 bits are null.  Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unirec.functions.shared import new_folder, remove, stored

SLICE_NUMBERS = 1 << 19  # components that are worked on at a time
LIMB = 10 ** 27  # sums travel as high * LIMB + low
UNKNOWN = -1
LONG_MAX = (1 << 63) - 1
HOT_SHARE = 1000
LARGEST = float(np.finfo(np.float32).max)  # a larger double counts as infinite
STATE = "codes binary, near binary, entry int, parts bigint, place int, high decimal(38,0), low decimal(38,0)"


@dataclass(frozen=True)
class Coding:
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


def exact_bound(width: int) -> int:
    """Numbers up to this have squared distances over ``width`` components that a double holds exactly."""
    return math.isqrt((1 << 53) // width) // 2


def whole_numbers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), still as doubles: the product with a power of two is exact, and so is its floor."""
    return np.floor(vectors * float(scale))


def as_integers(numbers: np.ndarray) -> np.ndarray:
    return np.array([int(x) for x in numbers.reshape(-1)], object).reshape(numbers.shape)


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """points x entries: squared distances, in the numbers' own kind."""
    apart = points[:, None, :] - entries[None, :, :]
    return (apart * apart).sum(2)


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distance = squared(points, entries)
    best = distance.argmin(1) if len(points) else np.zeros(0, np.int64)
    return best, distance[np.arange(len(points)), best]


class Codebooks:
    """parts x entries x width Python integers, and which entries moved when they were last updated."""

    def __init__(self, entries: list[list[list[int]]], moved: list[list[bool]] | None = None):
        self.entries = entries
        self.moved = np.ones((len(entries), len(entries[0])), bool) if moved is None else np.array(moved)

    def updated(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Codebooks:
        """The codebooks after the sums and counts of a round."""
        new = [[[s // sums[p, k][0] for s in sums[p, k][1]] if (p, k) in sums else entry for k, entry in enumerate(book)]
               for p, book in enumerate(self.entries)]
        return Codebooks(new, [[a != b for a, b in zip(old, now)] for old, now in zip(self.entries, new)])

    def sha256(self) -> str:
        flat = (str(c) for book in self.entries for entry in book for c in entry)
        return hashlib.sha256(",".join(flat).encode()).hexdigest()

    def assign(self, numbers: np.ndarray, codes: np.ndarray | None, near: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, list]:
        """rows x parts: entries, stored distances (UNKNOWN where a row is not exact in doubles), and the exact
        distances of those rows as (row, part, distance)."""
        rows, width = len(numbers), len(self.entries[0][0])
        new_codes, new_near = np.zeros((rows, len(self.entries)), np.uint8), np.full((rows, len(self.entries)), UNKNOWN, np.int64)
        wide_found = []
        for p, book in enumerate(self.entries):
            points, bound = numbers[:, p * width:(p + 1) * width], exact_bound(width)
            narrow = np.abs(points).max(1) <= bound
            if max(abs(c) for entry in book for c in entry) > bound:
                narrow[:] = False
            wide = np.flatnonzero(~narrow)
            if len(wide):
                best, distance = nearest(as_integers(points[wide]), np.array(book, object))
                new_codes[wide, p] = best
                wide_found.extend((int(r), p, int(d)) for r, d in zip(wide, distance))
            entries = np.array(book, np.float64) if narrow.any() else None
            fixed = np.zeros(rows, bool)
            if codes is not None:
                fixed = narrow & (near[:, p] != UNKNOWN) & ~self.moved[p][codes[:, p]]
            scan = np.flatnonzero(narrow & ~fixed)
            if len(scan):
                best, distance = nearest(points[scan], entries)
                new_codes[scan, p], new_near[scan, p] = best, distance.astype(np.int64)
            keep = np.flatnonzero(fixed)
            if len(keep):
                new_codes[keep, p], new_near[keep, p] = codes[keep, p], near[keep, p]
                active = np.flatnonzero(self.moved[p])
                if len(active):
                    best, distance = nearest(points[keep], entries[active])
                    best, distance = active[best], distance.astype(np.int64)
                    old, held = codes[keep, p], near[keep, p]
                    won = (distance < held) | ((distance == held) & (best < old))
                    new_codes[keep[won], p], new_near[keep[won], p] = best[won], distance[won]
        return new_codes, new_near, wide_found


def part_sums(numbers: np.ndarray, codes: np.ndarray, entries: int, sums: dict[tuple[int, int], list]) -> None:
    """Adds the parts of the rows to ``sums``: (part, entry) -> [count, integer sums]."""
    width = numbers.shape[1] // codes.shape[1]
    for p in range(codes.shape[1]):
        points = numbers[:, p * width:(p + 1) * width]
        exact = np.abs(points).max(initial=0) * max(len(points), 1) < 1 << 53
        for k in np.unique(codes[:, p]).tolist():
            mine = points[codes[:, p] == k]
            total = mine.sum(0) if exact else as_integers(mine).sum(0)
            held = sums.setdefault((p, k), [0, [0] * width])
            held[0] += len(mine)
            held[1] = [a + int(b) for a, b in zip(held[1], total)]


def usable(vectors: DataFrame, coding: Coding) -> DataFrame:
    """vec_id, label, vector: the rows that can be coded."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LARGEST))
    kind = vectors.schema["embedding"].dataType.simpleString()
    vector = F.col("embedding") if kind == "array<float>" else F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", "label", vector.alias("vector")).filter(F.col("vector").isNotNull())
    rows = rows.filter((F.size("vector") > 0) & (F.size("vector") % coding.parts == 0)).filter(finite)
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.filter(F.size("vector") == (sizes["size"] if sizes else 0))


def vector_slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the rows with their vectors as a matrix of doubles."""
    column = batch.column(2)
    width = len(column[0]) if len(column) else 1
    step = max(1, SLICE_NUMBERS // width)
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        yield part, part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(part.num_rows, width)


def matrix(column: pa.Array, kind: type, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), parts)


def binaries(values: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in values], pa.binary())


def one_round(rows: DataFrame, books: Codebooks, coding: Coding, first: bool) -> DataFrame:
    """The rows with their entries, and rows of sums (those have an entry number)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, names, kinds = {}, None, None
        for whole in batches:
            names, kinds = [*whole.schema.names[:3], "codes", "near", "entry", "parts", "place", "high", "low"], whole.schema.types[:3]
            for batch, vectors in vector_slices(whole):
                numbers = whole_numbers(vectors, coding.scale)
                old = (None, None) if first else (matrix(batch.column(3), np.uint8, coding.parts), matrix(batch.column(4), np.int64, coding.parts))
                codes, near, _ = books.assign(numbers, *old)
                part_sums(numbers, codes, coding.entries, sums)
                n = batch.num_rows
                none = [pa.nulls(n, t) for t in (pa.int32(), pa.int64(), pa.int32(), pa.decimal128(38), pa.decimal128(38))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], binaries(codes), binaries(near), *none], names=names)
        if sums:
            flat = [(p * coding.entries + k, n, i, Decimal(s // LIMB), Decimal(s % LIMB)) for (p, k), (n, values) in sorted(sums.items()) for i, s in enumerate(values)]
            columns = [pa.array(c, t) for c, t in zip(zip(*flat), (pa.int32(), pa.int64(), pa.int32(), pa.decimal128(38), pa.decimal128(38)))]
            none = [pa.nulls(len(flat), t) for t in (*kinds, pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, *columns], names=names)

    given = rows.select("vec_id", "label", "vector") if first else rows.select("vec_id", "label", "vector", "codes", "near")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields[:3])
    return given.mapInArrow(run, f"{schema}, {STATE}")


def gathered(written: DataFrame, coding: Coding) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """The sums and counts of all tasks: at most parts x entries x width rows."""
    totals = written.filter("entry IS NOT NULL").groupBy("entry", "place").agg(F.sum("parts").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))
    out: dict = {}
    for r in totals.orderBy("entry", "place").collect():
        out.setdefault(divmod(r.entry, coding.entries), (r.n, []))[1].append(int(r.high) * LIMB + int(r.low))
    return out


def first_books(rows: DataFrame, coding: Coding) -> Codebooks | None:
    """The parts of the vectors with the smallest vec_ids."""
    chosen = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(coding.entries).collect()
    if not chosen:
        return None
    numbers = [[int(x) for x in whole_numbers(np.array(r.vector, np.float64), coding.scale)] for r in chosen]
    width = len(numbers[0]) // coding.parts
    return Codebooks([[v[p * width:(p + 1) * width] for v in numbers] for p in range(coding.parts)])


def trained(vectors: DataFrame, coding: Coding = Coding()) -> tuple[DataFrame, Codebooks | None]:
    """The usable rows with the entries of the last round, and the final codebooks."""
    spark = vectors.sparkSession
    rows = usable(vectors, coding)
    books, before = first_books(rows, coding), None
    if books is None:
        return rows, None
    for number in range(coding.rounds):
        path = new_folder(spark, "lloyd")
        made = one_round(rows, books, coding, first=number == 0)
        made.write.parquet(path)
        written = spark.read.schema(made.schema).parquet(path)
        books = books.updated(gathered(written, coding))
        rows = written.filter("entry IS NULL")
        if before:
            remove(spark, before)
        before = path
    return rows, books


def coded(rows: DataFrame, books: Codebooks, coding: Coding) -> DataFrame:
    """vec_id, label, code, error: the last assignment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, vectors in vector_slices(whole):
                old = (None, None) if batch.num_columns == 3 else (matrix(batch.column(3), np.uint8, coding.parts), matrix(batch.column(4), np.int64, coding.parts))
                codes, near, wide = books.assign(whole_numbers(vectors, coding.scale), *old)
                error = [int(e) for e in np.where(near == UNKNOWN, 0, near).sum(1)]
                for row, _, distance in wide:
                    error[row] += distance
                text = pa.array([row.tobytes().hex() for row in codes], pa.string())
                errors = pa.array([e if e <= LONG_MAX else None for e in error], pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], text, errors], names=["vec_id", "label", "code", "error"])

    columns = [c for c in ("vec_id", "label", "vector", "codes", "near") if c in rows.columns]
    given = rows.select(*columns)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields[:2])
    return given.mapInArrow(run, f"{schema}, code string, error bigint")


def with_label_error(codes: DataFrame) -> DataFrame:
    """Adds ``label_error``.  Labels with more than a ``HOT_SHARE``-th of all rows, fewer than ``HOT_SHARE`` of them, are
    broadcast; the others are joined by merge."""
    whole = F.sum(F.col("error").cast("decimal(38,0)"))
    fits = F.when((F.count("error") == F.count("*")) & (whole <= LONG_MAX), whole.cast("long"))
    totals = stored(codes.groupBy("label").agg(fits.alias("label_error"), F.count("*").alias("_n")), "labels")
    # A null label is a value of its own.
    key = [F.coalesce(F.col("label").cast("string"), F.lit("")).alias("_label"), F.col("label").isNull().alias("_none")]
    totals = totals.select(*key, "label_error", "_n")
    all_rows = totals.agg(F.sum("_n")).first()[0] or 0
    hot = F.col("_n") * HOT_SHARE > all_rows
    rows = codes.select("*", *key)
    known = F.broadcast(totals.filter(hot).drop("_n"))
    on_hot = rows.join(known, ["_label", "_none"])
    others = rows.join(known.drop("label_error"), ["_label", "_none"], "left_anti")
    on_rest = others.join(totals.filter(~hot).drop("_n").hint("merge"), ["_label", "_none"])
    return on_hot.unionByName(on_rest).drop("_label", "_none")


def compress(vectors: DataFrame, coding: Coding = Coding()) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256."""
    rows, books = trained(vectors, coding)
    if books is None:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256")).filter(F.lit(False))
    codes = stored(coded(rows, books, coding), "codes")
    return with_label_error(codes).withColumn("codebooks_sha256", F.lit(books.sha256()))


def approximated(code: str, books: Codebooks, coding: Coding = Coding()) -> list[float]:
    """The vector that a code stands for."""
    entries = bytes.fromhex(code)
    return [c / coding.scale for p, k in enumerate(entries) for c in books.entries[p][k]]
