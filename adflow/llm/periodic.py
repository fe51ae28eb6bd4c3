"""Runs of words that repeat with a period, found in Re-Pair grammars of the texts.

A row stays a row: there is no shuffle, and a task holds about ``SLICE_BYTES`` of texts (or
the longest single text) with their grammars.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adflow.llm.grammar import runs
from adflow.llm.text import BLANK, Texts, slices

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _numbered(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Word numbers that differ between texts."""
    word = np.unique(hashes, return_inverse=True)[1].astype(np.int64)
    return np.unique(rows * np.int64(len(hashes) + 1) + word, return_inverse=True)[1]


def _found(batch: pa.RecordBatch) -> pa.RecordBatch:
    words = Texts.of(batch.column("t")).words(BLANK)
    rows, first = words.rows(), words.first
    if not len(rows):
        start = length = period = rows
    else:
        start, length, period = runs(_numbered(words.hashes(), rows), first)
    row = rows[start]
    # A word goes if any run has it after its first period.
    change = np.zeros(len(rows) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    data = words.texts.data.tobytes()
    a, b = words.start.tolist(), words.end.tolist()
    collapsed = []
    for r in range(batch.num_rows):
        own = np.flatnonzero(kept[first[r]:first[r + 1]]) + first[r]
        collapsed.append(b" ".join([data[a[k]:b[k]] for k in own.tolist()]))
    start = start - first[row]
    cut = np.searchsorted(row, np.arange(batch.num_rows + 1))
    listed = pa.ListArray.from_arrays(
        pa.array(cut, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(x) for x in (start, length, period)], fields=list(_RUN)))
    return pa.RecordBatch.from_arrays(
        [batch.column("row"), pa.array(words.counts.astype(np.int64)), listed,
         pa.array(collapsed, pa.binary()).cast(pa.string())],
        names=["row", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, ``n_words``, ``runs`` (array of start, length, period by start, then
    period; word numbers from 0) and ``collapsed``, the words that no run has after its first
    period, joined by one space.

    A run is a stretch of words with smallest period q, of at least 12 and at least 2 q words,
    that cannot be extended. Null and empty texts have no words and no runs and collapse to
    the empty string. Texts are read whole, whatever their length. Null and repeated keys are
    rows like others. Ties do not arise: a stretch has one smallest period. An empty table
    gives no rows. Other columns may have any name.
    """
    rows = docs.select(F.struct(F.col(key).alias("k")).alias("row"), F.col(text).alias("t"))
    kind = dict(rows.dtypes)["row"]

    def run(batches):
        for batch in slices(batches, "t"):
            yield _found(batch)

    found = rows.mapInArrow(
        run, f"row {kind}, n_words bigint, "
        "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return found.select(F.col("row.k").alias(key), "n_words", "runs", "collapsed")
