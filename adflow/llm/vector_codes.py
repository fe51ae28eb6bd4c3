"""Vectors as short codes: one codebook per part of the vector, entries found by Orchard's walk.

Components become integers, so codebooks, codes and errors are exact and do not depend on
the order of rows or the number of tasks. A pass over the rows assigns every part to an entry
and folds sums and counts per entry within the task; the driver sees ``parts`` x ``size`` sums,
whatever the number of rows. The entries travel with the task: 16 x 64 of them.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.llm.orchard import Orchard
from adflow.llm.stage import staged

PARTS = 16
SIZE = 64
ROUNDS = 2
SCALE = 256
ROWS_AT_ONCE = 2048
LABEL_SALTS = 32
# Integer components beyond this would leave 64 bits when squared and summed.
MOST = 1 << 26


def usable(vector: Column) -> Column:
    """Not null, without null, NaN, infinite or (see ``MOST``) out-of-range components."""
    return F.coalesce(vector.isNotNull() & F.forall(
        vector, lambda x: F.coalesce(F.abs(x) < MOST / SCALE, F.lit(False))), F.lit(False))


def _integers(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * SCALE).astype(np.int64).reshape(len(column), width)


@dataclass
class Codebooks:
    """``entries``: parts x size x width integers; size may be 0."""

    entries: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(
            ",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _first(rows: DataFrame, parts: int, size: int) -> Codebooks:
    """The parts of the vectors with the smallest ids; an id that repeats gives its smallest."""
    ids = rows.where(F.col("id").isNotNull()).select("id").distinct().orderBy("id").limit(size)
    lowest = rows.join(F.broadcast(ids), "id").groupBy("id").agg(F.min("v").alias("v")).orderBy(
        "id").collect()
    vectors = [np.floor(np.asarray(r["v"], np.float64) * SCALE).astype(np.int64) for r in lowest]
    width = len(vectors[0]) if vectors else 0
    if width % parts:
        raise ValueError(f"vectors of {width} components do not make {parts} equal parts")
    vectors = [v for v in vectors if len(v) == width]
    table = np.array(vectors, np.int64).reshape(len(vectors), parts, width // parts)
    return Codebooks(table.transpose(1, 0, 2).copy())


def _chunks(batch: pa.RecordBatch, books: Codebooks):
    parts, _, width = books.entries.shape
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        own = batch.slice(at, ROWS_AT_ONCE)
        yield own, _integers(own.column("v"), parts * width).reshape(-1, parts, width)


def _moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry replaced by the floor of its parts' mean; unused ones stay."""
    parts, size, width = books.entries.shape

    def run(batches):
        search = Orchard(books.entries)
        count = np.zeros(parts * size, np.int64)
        total = np.zeros((parts * size, width), np.int64)
        for batch in batches:
            for _, vectors in _chunks(batch, books):
                slot = (search.nearest(vectors)[0] + np.arange(parts) * size).ravel()
                count += np.bincount(slot, minlength=len(count))
                flat = vectors.reshape(-1, width)
                for k in range(width):
                    np.add.at(total[:, k], slot, flat[:, k])
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(count[used]), pa.array(total[used].tolist(), pa.list_(pa.int64()))],
            names=["slot", "n", "total"])

    # Components are bounded by MOST, so a sum leaves 64 bits after 2^36 rows; decimals do not.
    sums = [F.sum(F.col("total")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(width)]
    found = rows.mapInArrow(run, "slot bigint, n bigint, total array<bigint>").groupBy("slot").agg(
        F.sum("n").alias("n"), *sums).collect()
    entries = books.entries.copy().reshape(parts * size, width)
    for r in found:
        entries[r["slot"]] = [int(r[f"s{k}"]) // r["n"] for k in range(width)]
    return Codebooks(entries.reshape(parts, size, width))


def _same_length(rows: DataFrame, width: int) -> DataFrame:
    return rows.where(F.size("v") == width)


def fit(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS,
        size: int = SIZE, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks after ``rounds`` of assigning all rows and moving the entries."""
    rows = vectors.where(usable(F.col(vector))).select(
        F.col(key).alias("id"), F.col(vector).alias("v"))
    books = _first(rows, parts, size)
    if books.entries.shape[1] and books.entries.shape[2]:
        for _ in range(rounds):
            books = _moved(_same_length(rows, parts * books.entries.shape[2]), books)
    return books


def encode(vectors: DataFrame, books: Codebooks, key: str = "vec_id", vector: str = "embedding",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, ``keep``, ``code`` (entry indexes as bytes) and ``error`` (squared distances)."""
    parts, size, width = books.entries.shape
    rows = _same_length(vectors.where(usable(F.col(vector))).select(
        F.col(key).alias("id"), *[F.col(c).alias(f"k_{c}") for c in keep], F.col(vector).alias("v")),
        parts * width)
    if not size:
        rows = rows.where("false")
    names = ["id", *[f"k_{c}" for c in keep]]

    def run(batches):
        search = Orchard(books.entries)
        for batch in batches:
            for own, integers in _chunks(batch, books):
                best, far = search.nearest(integers)
                yield pa.RecordBatch.from_arrays(
                    [own.column(n) for n in names] + [
                        pa.array([r.tobytes() for r in best.astype(np.uint8)], pa.binary()),
                        pa.array(far.sum(axis=1))], names=[*names, "code", "error"])

    types = dict(rows.dtypes)
    schema = ", ".join(f"`{n}` {types[n]}" for n in names) + ", code binary, error bigint"
    return rows.mapInArrow(run, schema).select(
        F.col("id").alias(key), *[F.col(f"k_{c}").alias(c) for c in keep], "code", "error")


def decode(coded: DataFrame, books: Codebooks, code: str = "code") -> DataFrame:
    """``coded`` with ``vector``: the floats that the code stands for."""
    parts, _, width = books.entries.shape
    cells = [[F.lit(float(x) / SCALE) for x in book.ravel()] for book in books.entries]
    own = [F.slice(F.array(*cell), F.conv(F.hex(F.substring(code, p + 1, 1)), 16, 10).cast("int")
                   * width + 1, width) for p, cell in enumerate(cells)]
    return coded.withColumn("vector", F.flatten(F.array(*own)))


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
             label: str = "label", parts: int = PARTS, size: int = SIZE,
             rounds: int = ROUNDS) -> DataFrame:
    """Per vector: key, label, ``code``, ``error``, ``label_error``, ``codebooks_sha256``.

    Rows without a vector, or with a null, NaN, infinite or larger than 2^18 component, are
    dropped, and so are vectors whose length is not that of the smallest key's vector; that
    length has to be a multiple of ``parts``. Fewer than ``size`` keys make smaller codebooks.
    A null key starts no entry, but its row is used and coded. Rows that repeat a key all
    count and are all coded; the smallest of their vectors starts the entry. Equal distances
    go to the lower index. Null labels are one label. An empty table gives no rows. Other
    columns may have any name.
    """
    books = fit(vectors, key, vector, parts, size, rounds)
    own = vectors.select(F.col(key).alias("id"), F.col(vector).alias("v"), F.col(label).alias("l"))
    coded = staged(encode(own, books, "id", "v", ("l",)), "codes")
    # A label may hold most rows: sums fold in the tasks, and go back to salted rows.
    sums = coded.groupBy("l").agg(F.sum("error").alias("label_error")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))))
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("id", "code"), F.lit(LABEL_SALTS)).cast("int"))
    joined = salted.join(sums, salted["l"].eqNullSafe(sums["l"]) & (salted["salt"] == sums["salt"]))
    return joined.select(
        F.col("id").alias(key), salted["l"].alias(label), "code", "error", "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"))
