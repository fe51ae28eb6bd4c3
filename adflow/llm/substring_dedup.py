"""Passages that an earlier document has too, found with a compressed FM-index per shard.

1. ``_gather`` reads the texts once, into blocks of about ``BLOCK_BYTES``. A window of 13
   words has an anchor: the least hash among its four-word grams. Windows next to each other
   mostly share it, so a text falls into pieces of at most 22 words, one per anchor, and equal
   windows are in pieces of equal anchors whatever is around them. A block lists its anchors
   once each.
2. An anchor that only one text has cannot be in a shared window. The others are counted over
   all blocks; a common one is one row per block that has it, however often it occurs there.
3. Blocks send the pieces of shared anchors to the anchor's shard: each distinct piece of a
   block once, with the smallest key that has it. So copies and common passages fold before
   the shuffle, and rows grow with the text, not with blocks times shards. The edges of a
   common passage differ from text to text and do not fold; an anchor that more than ``HOT``
   texts have is therefore dealt window by window, by the hash of the whole window.
4. A shard indexes its distinct pieces (``RunIndex``: runs of the Burrows-Wheeler transform
   in a wavelet matrix) and streams them through the index: backward search gives the
   matching statistics against pieces of smaller keys, and the stretches of 13 words or more.
5. Every block gets back, per piece, the smallest key that has it and the words of that
   key's text that a still smaller key covers. Texts of larger keys have the whole piece earlier.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adflow.llm.run_index import RunIndex
from adflow.llm.stage import staged
from adflow.llm.text import BLANK, Texts, Words, mix, release, slices, windows

LEAST = 13
GRAM = 4
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 8 << 20
HOT = 4096
STREAMED = 1 << 16


class _Pieces:
    """The words of a block's texts, cut at anchors. Piece p has ``count`` words from ``word``
    on in text ``row``."""

    def __init__(self, words: Words, able: np.ndarray, least: int):
        self.least, self.hashes, rows = least, words.hashes(), words.rows()
        none = np.zeros(0, np.int64)
        self.row = self.word = self.count = none
        self.anchor = none.astype(np.uint64)
        at, grams = windows(self.hashes, rows, GRAM)
        if not len(at):
            return
        gram = np.full(len(rows), np.uint64(0xFFFFFFFFFFFFFFFF))
        gram[at] = grams
        # Windows of whole texts that may take part.
        begin = rows[:max(len(rows) - least + 1, 0)]
        start = np.flatnonzero(able[begin] & (begin == rows[least - 1:]))
        if not len(start):
            return
        low, place = gram[start], np.zeros(len(start), np.int64)
        for k in range(1, least - GRAM + 1):
            own = gram[start + k]
            less = own < low
            low = np.where(less, own, low)
            place = np.where(less, k, place)
        place += start
        new = np.ones(len(start), bool)
        new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1) | (
            rows[start[1:]] != rows[start[:-1]])
        lead = np.flatnonzero(new)
        self.word = start[lead]
        self.count = np.diff(np.append(lead, len(start))) + least - 1
        self.row, self.anchor = rows[self.word], mix(low[lead])

    def narrow(self, known: np.ndarray, hot: np.ndarray) -> None:
        """Keep the pieces of the anchors ``known``, and cut those of ``hot`` into their
        windows, each its own anchor."""
        keep = np.isin(self.anchor, known)
        self.word, self.row, self.count, self.anchor = (
            x[keep] for x in (self.word, self.row, self.count, self.anchor))
        cut = np.isin(self.anchor, hot)
        if not cut.any():
            return
        n = self.count[cut] - self.least + 1
        word = np.repeat(self.word[cut], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        row = np.repeat(self.row[cut], n)
        count = np.full(len(word), self.least)
        self.word, self.row, self.count, self.anchor = (
            np.concatenate([old[~cut], new]) for old, new in (
                (self.word, word), (self.row, row), (self.count, count),
                (self.anchor, self._named(word, count))))

    def _named(self, word: np.ndarray, count: np.ndarray) -> np.ndarray:
        name = np.zeros(len(word), np.uint64)
        for k in range(int(count.max(initial=0))):
            own = k < count
            name[own] = mix(name[own] * np.uint64(31) + self.hashes[word[own] + k])
        return name

    def names(self) -> np.ndarray:
        """A number per piece, the same for pieces of the same words."""
        return np.unique(self._named(self.word, self.count), return_inverse=True)[1]


def _rank(keys: pa.Array) -> np.ndarray:
    """Places of the keys in their order; equal keys share one. Null keys come last."""
    return pc.rank(keys, sort_keys="ascending", null_placement="at_end",
                   tiebreaker="min").to_numpy().astype(np.int64)


def _closed(keys: list, texts: list, kind: pa.DataType) -> bytes:
    batch = pa.RecordBatch.from_arrays(
        [pa.chunked_array(keys, kind).combine_chunks(), pa.chunked_array(texts).combine_chunks()],
        names=["k", "t"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(
            compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _opened(payload: bytes) -> tuple[pa.RecordBatch, Words, np.ndarray]:
    with pa.ipc.open_stream(payload) as own:
        batch = own.read_next_batch()
    able = batch.column("k").is_valid().to_numpy(zero_copy_only=False)
    return batch, Texts.of(batch.column("t")).words(BLANK), able


def _gather(least: int, most: int):
    """Rows (block, payload, bytes, anchors, texts): the distinct anchors, and how many texts of
    the block have each."""

    def closed(number, keys, texts, size, kind):
        payload = _closed(keys, texts, kind)
        _, words, able = _opened(payload)
        pieces = _Pieces(words, able, least)
        order = np.lexsort((pieces.row, pieces.anchor))
        anchor, row = pieces.anchor[order], pieces.row[order]
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        anchors, count = np.unique(anchor[new], return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([payload], pa.binary()),
             pa.array([size], pa.int64()),
             pa.array([anchors.view(np.int64)], pa.list_(pa.int64())),
             pa.array([count.astype(np.int32)], pa.list_(pa.int32()))],
            names=["block", "payload", "bytes", "anchors", "texts"])

    def run(batches):
        from pyspark import TaskContext

        number, keys, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in slices(batches, "t", most):
            keys.append(batch.column("k"))
            texts.append(batch.column("t"))
            size += batch.column("t").nbytes
            if size >= most:
                yield closed(number, keys, texts, size, keys[0].type)
                number, keys, texts, size = number + 1, [], [], 0
        if keys:
            yield closed(number, keys, texts, size, keys[0].type)
        release()

    return run


def _joined(words: Words, pieces: _Pieces, lead: np.ndarray) -> pa.Array:
    """The words of some pieces, each joined by one space."""
    text = words.strings()
    return pa.array([b" ".join(text[w:w + n]) for w, n in zip(
        pieces.word[lead].tolist(), pieces.count[lead].tolist())], pa.binary())


def _numbers(lists: pa.Array) -> np.ndarray:
    """What one row's list of anchors has; a null list is empty."""
    return np.unique(lists.flatten().to_numpy().view(np.uint64))


def _send(least: int, shards: int):
    """Rows (shard, block, piece, k, words) of a block's distinct pieces with shared anchors."""

    def run(batches):
        for rows in batches:
            for at in range(rows.num_rows):
                own = rows.slice(at, 1)
                known, hot = _numbers(own.column("shared")), _numbers(own.column("hot"))
                if not len(known):
                    continue
                batch, words, able = _opened(own.column("payload")[0].as_py())
                pieces = _Pieces(words, able, least)
                pieces.narrow(known, hot)
                keys = batch.column("k")
                # The first of each name in the order of keys.
                order = np.argsort(_rank(keys)[pieces.row], kind="stable")
                name, lead = np.unique(pieces.names()[order], return_index=True)
                lead = order[lead]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((pieces.anchor[lead] % np.uint64(shards)).astype(np.int64)),
                     pa.array(np.full(len(lead), own.column("block")[0].as_py(), np.int64)),
                     pa.array(name.astype(np.int32)), keys.take(pa.array(pieces.row[lead])),
                     _joined(words, pieces, lead)],
                    names=["shard", "block", "piece", "k", "words"])
        release()

    return run


def _answer(least: int):
    """A shard's rows (block, piece, k, covered): the smallest key that has the piece, and a
    bit for every word of it that a still smaller key's text covers."""

    def run(group: pa.Table) -> pa.Table:
        keys = group.column("k").combine_chunks()
        rank = _rank(keys)
        coded = group.column("words").combine_chunks().dictionary_encode()
        which = coded.indices.to_numpy().astype(np.int64)
        words = Texts.of(coded.dictionary.cast(pa.large_string())).words(BLANK)
        symbols = np.unique(words.hashes(), return_inverse=True)[1] + 1
        owner = np.full(len(words.first) - 1, np.iinfo(np.int32).max, np.int64)
        np.minimum.at(owner, which, rank)
        holder = np.zeros(len(owner), np.int64)
        own = np.flatnonzero(rank == owner[which])
        holder[which[own]] = own
        index = RunIndex(symbols, words.first, owner)
        covered = np.zeros(len(owner), np.int64)
        for at in range(0, len(owner), STREAMED):
            end = min(at + STREAMED, len(owner))
            cut = words.first[at:end + 1]
            piece, a, b = index.matches(
                symbols[cut[0]:cut[-1]], cut - cut[0], owner[at:end], least)
            np.bitwise_or.at(covered, piece + at, (np.int64(1) << b) - (np.int64(1) << a))
        release()
        return pa.table({
            "block": group.column("block"), "piece": group.column("piece"),
            "k": keys.take(pa.array(holder[which])), "covered": pa.array(covered[which])})

    return run


def _apply(least: int):
    """A block's rows (k, n_words, removed spans, kept text)."""
    span = pa.struct([("start", pa.int64()), ("words", pa.int64())])

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        batch, words, able = _opened(blocks.column("payload")[0].as_py())
        keys, rows = batch.column("k"), words.rows()
        change = np.zeros(len(rows) + 1, np.int64)
        if answers.num_rows:
            pieces = _Pieces(words, able, least)
            known, hot = (_numbers(blocks.column(c).combine_chunks()) for c in ("shared", "hot"))
            pieces.narrow(known, hot)
            name = answers.column("piece").to_numpy()
            place = np.zeros(len(name), np.int64)
            place[name] = np.arange(len(name))
            answer = place[pieces.names()]
            covered = answers.column("covered").to_numpy()[answer]
            firsts = answers.column("k").combine_chunks()
            ranks = _rank(pa.chunked_array([keys, firsts.cast(keys.type)]).combine_chunks())
            later = ranks[:len(keys)][pieces.row] > ranks[len(keys):][answer]
            word, count = pieces.word, pieces.count
            np.add.at(change, word[later], 1)
            np.add.at(change, word[later] + count[later], -1)
            own = np.flatnonzero(~later & (covered > 0))
            for k in range(int(count[own].max(initial=0))):
                hit = word[own][(covered[own] >> k) & 1 == 1] + k
                np.add.at(change, hit, 1)
                np.add.at(change, hit + 1, -1)
        gone = np.cumsum(change[:-1]) > 0
        text, first = words.strings(), words.first
        edge = gone.copy()
        edge[1:] &= ~(gone[:-1] & (rows[1:] == rows[:-1]))
        tail = gone.copy()
        tail[:-1] &= ~(gone[1:] & (rows[1:] == rows[:-1]))
        a, b = np.flatnonzero(edge), np.flatnonzero(tail) + 1
        kept = []
        for r in range(batch.num_rows):
            own = text[first[r]:first[r + 1]]
            if gone[first[r]:first[r + 1]].any():
                own = [w for w, g in zip(own, gone[first[r]:first[r + 1]].tolist()) if not g]
            kept.append(b" ".join(own))
        spans = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(rows[a], np.arange(batch.num_rows + 1)), pa.int32()),
            pa.StructArray.from_arrays([pa.array(a - first[rows[a]]), pa.array(b - a)],
                                       fields=list(span)))
        release()
        return pa.table({"k": keys, "n_words": pa.array(words.counts.astype(np.int64)),
                         "removed": spans, "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    return run


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text",
                      least: int = LEAST, block_bytes: int = BLOCK_BYTES,
                      shard_bytes: int = SHARD_BYTES, hot: int = HOT) -> DataFrame:
    """Per row: the key, ``n_words``, ``removed`` (merged word spans: start, words) and
    ``kept``, the other words joined by one space.

    A word is removed if it is in a window of ``least`` words that also starts in a text with
    a smaller key; ``least`` is 5 to 33. Windows are judged on the input. Null and empty
    texts have no words. Rows with a null key keep all words and are no source for others.
    Rows that repeat a key are one document here: they take nothing from each other. Texts
    of fewer words have no window. Texts are read whole, whatever their length. An empty
    table gives no rows. Keys may be of any ordered type; other columns may have any name.
    """
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = dict(rows.dtypes)["k"]
    blocks = staged(rows.mapInArrow(
        _gather(least, block_bytes),
        "block bigint, payload binary, bytes bigint, anchors array<bigint>, texts array<int>"), "blocks")
    shards = max(4, -(-(blocks.agg(F.sum("bytes")).first()[0] or 0) // shard_bytes))
    listed = blocks.select("block", F.explode(F.arrays_zip("anchors", "texts")).alias("a")).select(
        "block", F.col("a.anchors").alias("anchor"), F.col("a.texts").alias("n"))
    # At most a row per block and anchor: the groups of this window are no larger than that.
    total = F.sum("n").over(Window.partitionBy("anchor"))
    shared = staged(listed.withColumn("total", total).where("total > 1").groupBy("block").agg(
        F.collect_list("anchor").alias("shared"),
        F.collect_list(F.when(F.col("total") > hot, F.col("anchor"))).alias("hot")), "anchors")
    whole = blocks.select("block", "payload").join(shared, "block", "left")
    sent = whole.mapInArrow(
        _send(least, shards), f"shard bigint, block bigint, piece int, k {kind}, words binary")
    answers = sent.groupBy("shard").applyInArrow(
        _answer(least), f"block bigint, piece int, k {kind}, covered bigint")
    return whole.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _apply(least), f"k {kind}, n_words bigint, removed array<struct<start:bigint,words:bigint>>, "
        "kept string").withColumnRenamed("k", key)
