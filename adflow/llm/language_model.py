"""Text scores of an interpolated bigram model kept in sharded Elias-Fano n-gram tries.

1. Tasks read the texts once and gather blocks of them. A block sends its distinct words
   and word pairs, with their counts in training texts, to shards by hash; the block's
   token numbers travel with it as its directory.
2. A shard adds up the counts of all blocks, builds the trie of its word pairs in
   memory-mapped levels and answers every block: exact counts of words, quantised counts
   of pairs. Pairs are dealt by the hash of both words, so the followers of a common word are
   spread over all shards; a block sends a pair once however often it has it.
3. A block turns the answers into sums per text: the exact base score, and how many tokens
   fall into each (context class, quantised probability ratio) cell.
4. Each class of contexts, by frequency, mixes pair and word probability by a weight
   fitted to leave-one-out counts of all training tokens (a table of fixed size). The weights
   then turn the cells into scores.

P(w) = (c(w) + 1) / (N + V + 1); P(w | h) = (1 - b) P(w) + b c(h w) / c(h), with b the
weight of h's class and the text's start as the context of its first token.
"""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adflow.llm.ngram_trie import WORD_BITS, Trie, restored
from adflow.llm.stage import staged
from adflow.llm.text import BLANK, Texts, mix, release, slices

SHARD_CHARS = 8 << 20
BLOCK_TOKENS = 1 << 20
_FP = np.uint64((1 << 40) - 1)
_LOW = np.uint64((1 << WORD_BITS) - 1)
# Hashes of the end token and of the start of a text.
END, START = (np.uint64(h) for h in mix(np.array([1, 2], np.uint64)))
CELLS = 256  # quantised log10 ratios per class of contexts; 0 is "not seen"
STEP = 1 / 16
LOWEST = -15.0
CLASSES = 33


def _planes(values: np.ndarray) -> bytes:
    """Bytes of numbers, all first bytes first, deflated."""
    raw = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return zlib.compress(raw, 1)


def _numbers(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return raw.reshape(size, -1).T.copy().view(kind).ravel()


def _pack(**columns: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_pydict(columns)
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as stream:
        return stream.read_next_batch()


class Block:
    """Token numbers of some texts; number k is word ``vocabulary[k]``, frequent words first.

    What a block asks follows from its tokens alone, so task and answer agree on the order.
    """

    def __init__(self, vocabulary: np.ndarray, tokens: np.ndarray, sizes: np.ndarray,
                 learned: np.ndarray):
        self.vocabulary, self.tokens, self.sizes, self.learned = vocabulary, tokens, sizes, learned
        n = len(vocabulary)
        self.of_learned = np.repeat(learned, sizes)
        ends = np.cumsum(sizes)
        self.previous = np.empty_like(tokens)
        self.previous[1:] = tokens[:-1]
        self.previous[ends - sizes] = n  # the start of the text
        code = self.previous * (n + 1) + tokens
        pairs, self.pair = np.unique(code, return_inverse=True)
        self.heads, self.words = pairs // (n + 1), pairs % (n + 1)

    @classmethod
    def of(cls, hashes: np.ndarray, sizes: np.ndarray, learned: np.ndarray) -> Block:
        vocabulary, tokens, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        return cls(vocabulary[order], place[tokens], sizes, learned)

    def word_order(self, shards: int) -> tuple[np.ndarray, np.ndarray]:
        shard = (self.vocabulary >> np.uint64(40)) % np.uint64(shards)
        return shard, np.lexsort((self.vocabulary & _FP, shard))

    def pair_order(self, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes = np.append(self.vocabulary, START)
        head, word = hashes[self.heads], hashes[self.words]
        shard = mix(head * np.uint64(0x9E3779B97F4A7C15) + word) % np.uint64(shards)
        key = ((head & _LOW) << np.uint64(WORD_BITS)) | (word & _LOW)
        return shard, key, np.lexsort((key, shard))

    def questions(self, shards: int) -> Iterator[tuple[int, bytes]]:
        counts = np.bincount(self.tokens[self.of_learned], minlength=len(self.vocabulary))
        pair_counts = np.bincount(self.pair[self.of_learned], minlength=len(self.heads))
        shard, order = self.word_order(shards)
        pair_shard, key, pair_order = self.pair_order(shards)
        every = np.arange(shards + 1, dtype=np.uint64)
        cut = np.searchsorted(shard[order], every)
        pair_cut = np.searchsorted(pair_shard[pair_order], every)
        for s in range(shards):
            own, pairs = order[cut[s]:cut[s + 1]], pair_order[pair_cut[s]:pair_cut[s + 1]]
            if len(own) or len(pairs):
                steps = [np.diff(v, prepend=np.uint64(0)).astype("<u8") for v in (
                    self.vocabulary[own] & _FP, key[pairs])]
                yield s, _pack(
                    words=pa.array([_planes(steps[0])]), pairs=pa.array([_planes(steps[1])]),
                    counts=pa.array([_planes(counts[own].astype("<u4"))]),
                    pair_counts=pa.array([_planes(pair_counts[pairs].astype("<u4"))]))


def _send(shards: int, parts: int, rest: int, most: int):
    def run(batches):
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 32, []

        def block():
            nonlocal number, held
            hashes, sizes = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            keys = pa.concat_arrays([h[2] for h in held])
            apart = np.array([k is not None and zlib.crc32(str(k).encode()) % parts == rest
                              for k in keys.to_pylist()], bool)
            own = Block.of(hashes, sizes, ~apart)
            directory = _pack(
                keys=pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                sizes=pa.array([sizes.tolist()], pa.list_(pa.int64())),
                apart=pa.array([apart.tolist()], pa.list_(pa.bool_())),
                vocabulary=pa.array([own.vocabulary.astype("<u8").tobytes()], pa.binary()),
                tokens=pa.array([_planes(own.tokens.astype("<u4"))], pa.binary()))
            rows = [(number % shards, number, True, directory)] + [
                (s, number, False, q) for s, q in own.questions(shards)]
            number, held = number + 1, []
            return _rows(rows)

        for batch in slices(batches, "t"):
            words = Texts.of(batch.column("t"), lower=True).words(BLANK)
            held.append((np.insert(words.hashes(), words.first[1:], END), words.counts + 1,
                         batch.column("k")))
            if sum(len(h[0]) for h in held) >= most:
                yield block()
        if held:
            yield block()

    return run


def _rows(rows: list[tuple[int, int, bool, bytes]]) -> pa.RecordBatch:
    shard, block, directory, payload = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(shard, pa.int64()), pa.array(block, pa.int64()), pa.array(directory, pa.bool_()),
         pa.array(payload, pa.binary())], names=["shard", "block", "directory", "payload"])


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]):
    """Distinct keys with their total, and the place of every key among them."""
    own, place = np.unique(np.concatenate(keys), return_inverse=True)
    return own, np.bincount(place, weights=np.concatenate(counts)).astype(np.int64), place


def _answer(group: pa.Table) -> pa.Table:
    """A shard: counts of all blocks, and the trie's answers to each of them."""
    directory = group.column("directory").to_numpy()
    out = [group.filter(pa.array(directory))]
    asked = group.filter(pa.array(~directory))
    if asked.num_rows:
        parts = [_unpack(p) for p in asked.column("payload").to_pylist()]
        read = {c: [_numbers(p.column(c)[0].as_py(), kind) for p in parts] for c, kind in (
            ("words", "<u8"), ("pairs", "<u8"), ("counts", "<u4"), ("pair_counts", "<u4"))}
        words = [np.cumsum(w, dtype=np.uint64) for w in read["words"]]
        pairs = [np.cumsum(w, dtype=np.uint64) for w in read["pairs"]]
        _, totals, place = _summed(words, read["counts"])
        keys, pair_totals, _ = _summed(pairs, read["pair_counts"])
        seen = pair_totals > 0
        with tempfile.TemporaryDirectory() as folder:
            trie = Trie(keys[seen] >> np.uint64(WORD_BITS), keys[seen] & _LOW, pair_totals[seen],
                        folder)
            payload, at = [], 0
            for own, pair in zip(words, pairs):
                payload.append(_pack(
                    counts=pa.array([_planes(totals[place[at:at + len(own)]].astype("<u8"))]),
                    codes=pa.array([_planes(trie.lookup(pair >> np.uint64(WORD_BITS),
                                                        pair & _LOW))])))
                at += len(own)
            del trie
        out.append(asked.set_column(
            asked.column_names.index("payload"), "payload", pa.array(payload, pa.binary())))
        # The shard's own vocabulary and tokens go on as a block of their own.
        size = _pack(known=pa.array([int((totals > 0).sum())]), total=pa.array([int(totals.sum())]))
        shard = asked.column("shard")[0].as_py()
        out.append(pa.Table.from_batches([_rows([(shard, -1 - shard, True, size)])]).cast(
            group.schema))
    release()
    return pa.concat_tables(out).select(["shard", "block", "directory", "payload"])


def _class(count: np.ndarray) -> np.ndarray:
    return np.where(count > 0, np.log2(np.maximum(count, 1)).astype(np.int64) + 1, 0)


def _cell(count: np.ndarray, head: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Class of the context and quantised log10 of c(h w) / (c(h) (c(w) + 1))."""
    ratio = np.log10(np.maximum(count, 1)) - np.log10(np.maximum(head, 1)) - np.log10(word + 1)
    level = np.clip(np.round((ratio - LOWEST) / STEP), 1, CELLS - 1).astype(np.int64)
    return _class(head) * CELLS + np.where((count > 0) & (head > 0), level, 0)


_RESULT = ("n_tokens bigint, n_known bigint, sum_log double, cells array<int>, counts array<int>, "
           "known bigint, total bigint, kind int")


def _collect(key_type: pa.DataType, shards: int):
    names = ["k", "apart", "n_tokens", "n_known", "sum_log", "cells", "counts", "known", "total",
             "kind"]
    types = [key_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int32()),
             pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.int32()]
    schema = pa.schema(list(zip(names, types)))

    def table(**columns) -> pa.Table:
        n = len(next(iter(columns.values())))
        return pa.table({f.name: pa.array(columns[f.name], f.type) if f.name in columns
                         else pa.nulls(n, f.type) for f in schema}, schema)

    def run(group: pa.Table) -> pa.Table:
        directory = group.column("directory").to_numpy()
        own = _unpack(group.filter(pa.array(directory)).column("payload")[0].as_py())
        if group.column("block")[0].as_py() < 0:
            return table(known=own.column("known"), total=own.column("total"), kind=[2])
        keys = own.column("keys").values
        sizes = own.column("sizes").values.to_numpy()
        apart = own.column("apart").values.to_numpy(zero_copy_only=False)
        block = Block(np.frombuffer(own.column("vocabulary")[0].as_py(), "<u8"),
                      _numbers(own.column("tokens")[0].as_py(), "<u4").astype(np.int64),
                      sizes, ~apart)
        answers = group.filter(pa.array(~directory))
        got = {s: _unpack(p) for s, p in zip(answers.column("shard").to_pylist(),
                                             answers.column("payload").to_pylist())}
        parts = [got[s] for s in sorted(got)]
        counts = np.empty(len(block.vocabulary), np.int64)
        counts[block.word_order(shards)[1]] = np.concatenate(
            [_numbers(p.column("counts")[0].as_py(), "<u8") for p in parts])
        codes = np.empty(len(block.heads), np.uint8)
        codes[block.pair_order(shards)[2]] = np.concatenate(
            [_numbers(p.column("codes")[0].as_py(), "u1") for p in parts])

        # The start is a context as often as there is an end.
        ends = counts[block.vocabulary == END]
        heads = np.append(counts, ends[0] if len(ends) else 0)[block.heads]
        words = counts[block.words]
        pair = restored(codes)
        cells = _cell(pair, heads, words)
        text = np.repeat(np.arange(len(sizes)), sizes)
        per_text = np.unique(text * (CLASSES * CELLS) + cells[block.pair], return_counts=True)
        cut = np.searchsorted(per_text[0] // (CLASSES * CELLS), np.arange(len(sizes) + 1))
        cell = pa.array((per_text[0] % (CLASSES * CELLS)).astype(np.int32))
        number = pa.array(per_text[1].astype(np.int32))
        offsets = pa.array(cut.astype(np.int32))
        token = counts[block.tokens]
        texts = pa.table({
            "k": keys, "apart": pa.array(apart), "n_tokens": pa.array(sizes),
            "n_known": pa.array(np.bincount(text, weights=token > 0,
                                            minlength=len(sizes)).astype(np.int64)),
            "sum_log": pa.array(np.bincount(text, weights=np.log10(token + 1.0),
                                            minlength=len(sizes))),
            "cells": pa.ListArray.from_arrays(offsets, cell),
            "counts": pa.ListArray.from_arrays(offsets, number),
            "known": pa.nulls(len(sizes), pa.int64()), "total": pa.nulls(len(sizes), pa.int64()),
            "kind": pa.array(np.zeros(len(sizes), np.int32))}, schema)
        # Training tokens as they look without themselves.
        learned = block.pair[block.of_learned]
        left = _cell(np.maximum(pair - 1, 0), heads - 1, np.maximum(words - 1, 0))
        left = left % CELLS + _class(heads) * CELLS
        cell, number = np.unique(left[learned][heads[learned] > 1], return_counts=True)
        return pa.concat_tables([texts, table(
            cells=[cell.tolist()], counts=[number.tolist()], kind=[1])])

    return run


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text", parts: int = 7,
               rest: int = 2) -> DataFrame:
    """Staged sums: kind 0 a row per text, kind 1 leave-one-out cells per block, kind 2
    vocabulary and token counts per shard."""
    picked = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    chars = picked.agg(F.sum(F.length("t"))).first()[0] or 0
    shards = max(4, -(-chars // SHARD_CHARS))
    schema = "shard bigint, block bigint, directory boolean, payload binary"
    kind = dict(picked.dtypes)["k"]
    arrow = picked.select("k").limit(0).toArrow().schema.field("k").type
    return staged(picked.mapInArrow(_send(shards, parts, rest, BLOCK_TOKENS), schema).groupBy(
        "shard").applyInArrow(_answer, schema).groupBy("block").applyInArrow(
        _collect(arrow, shards), f"k {kind}, apart boolean, {_RESULT}"), "language-model")


def mixture(cells: np.ndarray, counts: np.ndarray, scale: float, rounds: int = 100) -> np.ndarray:
    """Weight of the pair probability per class of contexts, by expectation maximisation.

    A class without evidence takes the weight of the next more frequent one that has some;
    contexts that were never seen have none.
    """
    ratio = np.where(cells % CELLS > 0, 10 ** (LOWEST + STEP * (cells % CELLS)) * scale, 0.0)
    weights = np.full(CLASSES, np.nan)
    for c in range(1, CLASSES):
        own = cells // CELLS == c
        if own.any():
            r, n, b = ratio[own], counts[own].astype(np.float64), 0.5
            for _ in range(rounds):
                b = float((n * b * r / (1 - b + b * r)).sum() / n.sum())
            weights[c] = min(max(b, 1e-6), 0.999)
    for c in range(CLASSES - 2, 0, -1):
        if np.isnan(weights[c]):
            weights[c] = weights[c + 1]
    weights[0] = 0.0
    return np.nan_to_num(weights, nan=0.0)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", parts: int = 7,
          rest: int = 2) -> DataFrame:
    """Per text: key, held_out, n_tokens, n_known, train_tokens, base_score and score.

    A null or empty text is its end token. Repeated rows count, and are scored, each. A null
    key is never held out. Without training texts every word is unknown: N and V are 0. Texts
    are read whole, however long. Keys may have any type; other columns are not read, whatever
    they are called. An empty table gives no row.
    """
    sums = statistics(docs, key, text, parts, rest)
    size = sums.where("kind = 2").agg(F.sum("known"), F.sum("total")).first()
    known, total = size[0] or 0, size[1] or 0
    left = sums.where("kind = 1").select(F.explode(F.arrays_zip("cells", "counts")).alias("c")).groupBy(
        "c.cells").agg(F.sum("c.counts").alias("n")).toPandas()
    scale = float(total + known + 1)
    weights = mixture(left["cells"].to_numpy(np.int64), left["n"].to_numpy(np.float64), scale)
    cell = np.arange(CLASSES * CELLS)
    ratio = np.where(cell % CELLS > 0, 10 ** (LOWEST + STEP * (cell % CELLS)) * scale, 0.0)
    b = weights[cell // CELLS]
    gain = np.log10(1 - b + b * ratio)

    def run(batches):
        for batch in batches:
            cells, counts = batch.column("cells"), batch.column("counts")
            row = np.repeat(np.arange(batch.num_rows), np.diff(cells.offsets.to_numpy()))
            more = np.bincount(row, weights=gain[cells.flatten().to_numpy()]
                               * counts.flatten().to_numpy(), minlength=batch.num_rows)
            base = batch.column("sum_log").to_numpy() - (
                batch.column("n_tokens").to_numpy() * np.log10(scale))
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), batch.column("apart"), batch.column("n_tokens"),
                 batch.column("n_known"), pa.array(base), pa.array(base + more)],
                names=["k", "apart", "n_tokens", "n_known", "base_score", "score"])

    kind = dict(sums.dtypes)["k"]
    return sums.where("kind = 0").select(
        "k", "apart", "n_tokens", "n_known", "sum_log", "cells", "counts").mapInArrow(
        run, f"k {kind}, apart boolean, n_tokens bigint, n_known bigint, base_score double, "
        "score double").select(
        F.col("k").alias(key), F.col("apart").alias("held_out"), "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
