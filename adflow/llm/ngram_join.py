"""Jaccard join on word n-grams: rare-first prefixes, filters, one check per pair.

A text's set holds the hashes of its distinct n-word shingles. Two sets of sizes a and b
with ``100 * shared >= 75 * union`` share at least 3/7 (a + b) shingles.

1. ``shared_keys`` reads the texts once. Tasks gather blocks of texts and send their
   shingles, sorted and packed, to shards by hash. A shard counts in how many texts each
   occurs and answers every block: only shingles of two or more texts come back, as only
   those can be shared. A shingle that many texts of a block have is sent once with its
   count, so a common passage does not pile up in a shard. Copies within a block are
   set aside before. The block then orders each text's shared shingles rarest first. At
   least ceil(0.75 n) of n must be shared with a partner, so a prefix of
   ``m - ceil(0.75 n) + 1`` of m shared ones meets every partner; a text with fewer shared
   ones has none and is done.
2. ``links``: texts meet on prefix shingles. Each meets the most common-worded one (the
   leader) and the first one of its bucket, passes the length, positional and suffix filters, and
   is checked once per pair. Texts of a component found so far need no more checks among
   each other; all pairs of different components that meet in a bucket are filtered in
   blocks and checked. So the components are exact, while a bucket of like texts
   costs its size and not its square.

A shingle's key is its shard and 40 bits of its hash. Within two texts of n and m shingles
two different ones meet with a chance of about n m / (shards 2^40).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.llm.components import components
from adflow.llm.stage import staged
from adflow.llm.text import BLANK, Texts, joined, mix, release, slices, windows

WORDS = 5
SHARD_CHARS = 8 << 20
BLOCK_SHINGLES = 1 << 20
BLOCK_TEXTS = 50_000
REPEATED = 4  # texts of a block that make a shingle go once for all of them
CELLS = 64
CHUNK = 1024
PAIRS_AT_ONCE = 1 << 18
_FP = np.uint64((1 << 40) - 1)
_ALL = 0xFFFF


def _planes(values: np.ndarray) -> bytes:
    """Bytes of numbers, all first bytes first: the high ones are zeros that compress away."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _unplanes(data: memoryview, n: int, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8, n * size).reshape(size, n).T.copy().view(kind).ravel()


def pack(fp: np.ndarray, text: np.ndarray, count: np.ndarray) -> bytes:
    """Sorted fingerprints with a text (or ``_ALL``) and a count each, deflated."""
    steps = np.diff(fp, prepend=np.uint64(0)).astype("<u8")
    return len(fp).to_bytes(8, "little") + zlib.compress(
        _planes(steps) + _planes(text.astype("<u2"))
        + _planes(np.minimum(count, 0xFFFFFFFF).astype("<u4")), 1)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, view = int.from_bytes(data[:8], "little"), memoryview(zlib.decompress(data[8:]))
    return (np.cumsum(_unplanes(view, n, "<u8"), dtype=np.uint64),
            _unplanes(view[8 * n:], n, "<u2"), _unplanes(view[10 * n:], n, "<u4"))


def shingle_sets(column: pa.Array, size: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per text; fewer words than ``size`` are one shingle."""
    words = Texts.of(column, lower=True).words(BLANK)
    hashes = words.hashes()
    at, keys = windows(hashes, words.rows(), size)
    cut = np.searchsorted(at, words.first)
    out = []
    for r in range(len(column)):
        own = keys[cut[r]:cut[r + 1]]
        if not len(own) and words.first[r + 1] > words.first[r]:
            own = np.array([joined(hashes[words.first[r]:words.first[r + 1]])], np.uint64)
        out.append(np.unique(own))
    return out


class _Block:
    """Texts gathered in a task until they are sent."""

    def __init__(self, kind: pa.DataType):
        self.kind = kind
        self.keys, self.sizes, self.sets, self.first = [], [], [], []
        self.seen: dict[bytes, int] = {}
        self.total = 0

    def add(self, key, own: np.ndarray) -> None:
        name = np.array([len(own), own.sum(dtype=np.uint64),
                         np.bitwise_xor.reduce(mix(own)) if len(own) else 0], np.uint64).tobytes()
        k = len(self.keys)
        # A row without a key links with nothing: it has its size, and stands for no copies.
        able = key is not None and len(own) > 0
        first = self.seen.setdefault(name, k) if able else k
        self.keys.append(key)
        self.sizes.append(len(own))
        self.first.append(first)
        if first == k and able:
            self.sets.append((k, own))
            self.total += len(own)

    def full(self, most: int) -> bool:
        return self.total >= most or len(self.keys) >= BLOCK_TEXTS

    def _directory(self, many: np.ndarray, texts: np.ndarray) -> bytes:
        """Per text its key, size and first copy; and the texts of repeated shingles."""
        columns = {
            "keys": pa.array([self.keys], pa.list_(self.kind)),
            "sizes": pa.array([self.sizes], pa.list_(pa.int64())),
            "first": pa.array([self.first], pa.list_(pa.int32())),
            "many": pa.array([many.tobytes()], pa.binary()),
            "texts": pa.array([texts.astype("<u2").tobytes()], pa.binary()),
        }
        sink = pa.BufferOutputStream()
        batch = pa.RecordBatch.from_pydict(columns)
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()

    def rows(self, block: int, shards: int) -> Iterator[tuple[int, int, bool, bytes]]:
        """(shard, block, is directory, payload); the directory stays with the block."""
        keys = np.concatenate([s for _, s in self.sets] or [np.zeros(0, np.uint64)])
        text = np.repeat(np.array([k for k, _ in self.sets], np.int64),
                         [len(s) for _, s in self.sets])
        shard = (keys >> np.uint64(40)) % np.uint64(shards)
        keys = (shard << np.uint64(40)) | (keys & _FP)
        order = np.argsort(keys, kind="stable")
        keys, text = keys[order], text[order]
        start = np.flatnonzero(np.diff(keys, prepend=np.uint64(0xFFFFFFFFFFFFFFFF)))
        count = np.diff(np.append(start, len(keys)))
        many = count >= REPEATED
        listed = np.repeat(many, count)
        yield block % shards, block, True, self._directory(keys[listed], text[listed])
        single = ~listed
        keys = np.concatenate([keys[single], keys[start[many]]])
        text = np.concatenate([text[single], np.full(int(many.sum()), _ALL)])
        count = np.concatenate([np.ones(int(single.sum()), np.int64), count[many]])
        order = np.argsort(keys, kind="stable")
        keys, text, count = keys[order], text[order], count[order]
        cut = np.searchsorted(keys >> np.uint64(40), np.arange(shards + 1, dtype=np.uint64))
        for s, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
            if b > a:
                yield s, block, False, pack(keys[a:b] & _FP, text[a:b], count[a:b])


def _send(shards: int, size: int, most: int):
    """Blocks of texts as packed rows; block numbers follow from task and order."""

    def run(batches):
        from pyspark import TaskContext

        number, block = TaskContext.get().partitionId() << 32, None
        for batch in slices(batches, "t"):
            block = block or _Block(batch.column("k").type)
            for key, own in zip(batch.column("k").to_pylist(),
                                shingle_sets(batch.column("t"), size)):
                block.add(key, own)
                if block.full(most):
                    yield _packed(block.rows(number, shards))
                    number, block = number + 1, _Block(batch.column("k").type)
        if block is not None and block.keys:
            yield _packed(block.rows(number, shards))

    return run


def _packed(rows) -> pa.RecordBatch:
    shard, block, directory, payload = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(shard, pa.int64()), pa.array(block, pa.int64()), pa.array(directory, pa.bool_()),
         pa.array(payload, pa.binary())], names=["shard", "block", "directory", "payload"])


def _answer(group: pa.Table) -> pa.Table:
    """A shard: tells every block which of its shingles two or more texts have, and how many."""
    directory = group.column("directory").to_numpy()
    out = [group.filter(pa.array(directory))]
    asked = group.filter(pa.array(~directory))
    if asked.num_rows:
        parts = [unpack(p) for p in asked.column("payload").to_pylist()]
        fp = np.concatenate([p[0] for p in parts])
        count = np.concatenate([p[2] for p in parts]).astype(np.int64)
        order = np.argsort(fp, kind="stable")
        start = np.flatnonzero(np.diff(fp[order], prepend=_FP + np.uint64(1)))
        total = np.add.reduceat(count[order], start)
        of = np.empty(len(fp), np.int64)
        of[order] = np.repeat(total, np.diff(np.append(start, len(fp))))
        cut = np.cumsum([0] + [len(p[0]) for p in parts])
        payload = []
        for (own, text, _), a, b in zip(parts, cut, cut[1:]):
            shared = of[a:b] > 1
            payload.append(pack(own[shared], text[shared], of[a:b][shared]))
        out.append(asked.set_column(
            asked.column_names.index("payload"), "payload", pa.array(payload, pa.binary())))
    release()
    return pa.concat_tables(out).select(["shard", "block", "directory", "payload"])


def _collect(group: pa.Table) -> pa.Table:
    """A block: every text with its shared shingles, the prefix rarest first."""
    directory = group.column("directory").to_numpy()
    with pa.ipc.open_stream(group.filter(pa.array(directory)).column("payload")[0].as_py()) as s:
        own = s.read_next_batch()
    keys, sizes = own.column("keys").values, own.column("sizes").values.to_numpy()
    first = own.column("first").values
    many = np.frombuffer(own.column("many")[0].as_py(), np.uint64)
    texts = np.frombuffer(own.column("texts")[0].as_py(), "<u2")
    found = []
    answers = group.filter(pa.array(~directory))
    for shard, payload in zip(answers.column("shard").to_pylist(),
                              answers.column("payload").to_pylist()):
        fp, text, count = unpack(payload)
        found.append((fp | np.uint64(shard << 40), text, count))
    key, text, count = (np.concatenate([f[k] for f in found] or [np.zeros(0, d)])
                        for k, d in enumerate((np.uint64, np.uint16, np.uint32)))
    # A shingle sent once for several texts goes back to each of them.
    group_of = text == _ALL
    lo = np.searchsorted(many, key[group_of])
    n = np.searchsorted(many, key[group_of], "right") - lo
    spread = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
    key = np.concatenate([key[~group_of], np.repeat(key[group_of], n)])
    count = np.concatenate([count[~group_of], np.repeat(count[group_of], n)]).astype(np.int64)
    text = np.concatenate([text[~group_of], texts[spread]]).astype(np.int64)

    order = np.lexsort((key, count, text))
    key, count, text = key[order], count[order], text[order]
    shared = np.bincount(text, minlength=len(sizes))
    cut = np.concatenate([[0], np.cumsum(shared)])
    need = shared - (3 * sizes + 3) // 4 + 1
    prefix, everything, cells, common = ([None] * len(sizes) for _ in range(4))
    for k in np.flatnonzero((need > 0) & (shared > 0)):
        mine = key[cut[k]:cut[k + 1]]
        prefix[k] = mine[:need[k]].view(np.int64)
        everything[k] = mine.view(np.int64)
        cells[k] = np.bincount((mix(mine) % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
        common[k] = float(np.log(count[cut[k]:cut[k + 1]]).sum() / sizes[k])
    return pa.table({
        "k": keys, "n": pa.array(sizes), "first": keys.take(first),
        "m": pa.array(shared.astype(np.int64)), "common": pa.array(common, pa.float64()),
        "prefix": pa.array(prefix, pa.list_(pa.int64())),
        "shared": pa.array(everything, pa.list_(pa.int64())),
        "cells": pa.array(cells, pa.list_(pa.int32()))})


def shared_keys(docs: DataFrame, key: str = "doc_id", text: str = "text",
                size: int = WORDS) -> DataFrame:
    """A row per text: ``k``, ``n`` (set size), ``first`` (key of an equal set in its block),
    ``m`` (shared shingles) and, where a partner is possible, ``common`` (how common its
    shingles are), ``prefix``, all ``shared`` keys, and their counts in ``cells``."""
    picked = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    chars = picked.agg(F.sum(F.length("t"))).first()[0] or 0
    shards = max(4, -(-chars // SHARD_CHARS))
    kind = dict(picked.dtypes)["k"]
    schema = "shard bigint, block bigint, directory boolean, payload binary"
    return picked.mapInArrow(_send(shards, size, BLOCK_SHINGLES), schema).groupBy("shard").applyInArrow(
        _answer, schema).groupBy("block").applyInArrow(
        _collect, f"k {kind}, n bigint, first {kind}, m bigint, common double, "
        "prefix array<bigint>, shared array<bigint>, cells array<int>")


def _lengths_fit(a: Column, b: Column) -> Column:
    return 4 * F.least(a, b) >= 3 * F.greatest(a, b)


def _positions_fit(other: str) -> Column:
    """At most the shingles before and after this one can be shared besides it."""
    rest = F.least(F.col("m") - F.col("pos"), F.col(f"{other}.m") - F.col(f"{other}.pos"))
    before = F.least(F.col("pos"), F.col(f"{other}.pos"))
    return 7 * (before + rest) >= 3 * (F.col("n") + F.col(f"{other}.n"))


def check(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """The pairs (x, y) whose sets link. The cell filter on the suffixes comes first: two sets
    share at most the smaller count of each cell. Row by row in the JVM, so that memory
    follows the longest pair and not a batch of them."""
    lists = units.where(F.col("prefix").isNotNull()).select("k", "n", "shared", "cells")
    own = pairs.join(lists.toDF("x", "xn", "xs", "xc"), "x").join(
        lists.toDF("y", "yn", "ys", "yc"), "y")
    most = F.aggregate(F.zip_with("xc", "yc", lambda a, b: F.least(a, b).cast("long")),
                       F.lit(0).cast("long"), lambda total, c: total + c)
    size, same = F.col("xn") + F.col("yn"), F.size(F.array_intersect("xs", "ys"))
    return own.where((7 * most >= 3 * size) & (100 * same >= 75 * (size - same))).select("x", "y")


def _across(batches) -> Iterator[pa.RecordBatch]:
    """Pairs of different components among rows sorted by bucket part, after the filters."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None and held.num_rows:
            table = pa.concat_tables([held, table])
        part = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")])
        new = np.flatnonzero((part[:, 1:] != part[:, :-1]).any(axis=0)) + 1
        if not len(new):
            held = table
            continue
        held = table.slice(new[-1])
        yield from _pairs(table.slice(0, new[-1]))
    if held is not None and held.num_rows:
        yield from _pairs(held)


def _pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
    key, i, j, chunk, n, m, pos = (table.column(c).to_numpy().astype(np.int64) for c in (
        "key", "i", "j", "chunk", "n", "m", "pos"))
    component = np.unique(table.column("component").to_numpy(), return_inverse=True)[1]
    cells = table.column("cells").combine_chunks().flatten().to_numpy().reshape(-1, CELLS)
    size = len(key)
    new = np.ones(size + 1, bool)
    new[1:size] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    edge = np.flatnonzero(new)
    stop = np.repeat(edge[1:], np.diff(edge))
    width = stop - np.arange(size) - 1
    total = np.cumsum(width)
    lo, k = 0, table.column("k").combine_chunks()
    found = []
    while lo < size:
        hi = max(int(np.searchsorted(total, (total[lo - 1] if lo else 0) + PAIRS_AT_ONCE)), lo + 1)
        w = width[lo:hi]
        a = np.repeat(np.arange(lo, hi), w)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(w) - w, w)
        fit = component[a] != component[b]
        fit &= (i[a] == j[a]) | (chunk[a] != chunk[b])
        a, b = a[fit], b[fit]
        both = 3 * (n[a] + n[b])
        fit = 4 * np.minimum(n[a], n[b]) >= 3 * np.maximum(n[a], n[b])
        fit &= 7 * (np.minimum(pos[a], pos[b]) + np.minimum(m[a] - pos[a], m[b] - pos[b])) >= both
        a, b, both = a[fit], b[fit], both[fit]
        for at in range(0, len(a), 1 << 15):
            p, q = a[at:at + (1 << 15)], b[at:at + (1 << 15)]
            most = np.minimum(cells[p], cells[q])
            keep = 7 * most.sum(axis=1, dtype=np.int64) >= both[at:at + (1 << 15)]
            found.append((p[keep], q[keep]))
        lo = hi
    a, b = (np.concatenate([f[s] for f in found] or [np.zeros(0, np.int64)]) for s in (0, 1))
    x, y = k.take(pa.array(a)), k.take(pa.array(b))
    pairs = pa.table({"x": x, "y": y}).group_by(["x", "y"]).aggregate([])
    yield from pairs.combine_chunks().to_batches()


def links(units: DataFrame) -> DataFrame:
    """Linked pairs (x, y) that connect every component, from staged ``shared_keys``."""
    able = units.where(F.col("prefix").isNotNull() & F.col("k").isNotNull())
    copies = units.where(F.col("k") != F.col("first")).select(
        F.col("k").alias("x"), F.col("first").alias("y"))
    own = F.struct("k", "n", "m", "pos")
    postings = able.select("k", "n", "m", "common", F.posexplode("prefix").alias("pos", "key"))
    leaders = postings.groupBy("key").agg(
        F.min_by(own, F.struct(-F.col("common"), "k")).alias("best"),
        F.min_by(own, "k").alias("least"), F.count(F.lit(1)).alias("size")).where("size > 1")
    met = staged(postings.join(leaders, "key").select(
        "key", "k", "n", "m", "pos", "best", "least", "size"), "met")
    stars = None
    for leader in ("best", "least"):
        star = met.where((F.col("k") != F.col(f"{leader}.k"))
                         & _lengths_fit(F.col("n"), F.col(f"{leader}.n"))
                         & _positions_fit(leader)).select(
            F.least("k", f"{leader}.k").alias("x"), F.greatest("k", f"{leader}.k").alias("y"))
        stars = star if stars is None else stars.union(star)
    tried = staged(stars.distinct(), "tried")
    first = staged(check(tried, units).union(copies), "links")

    labels = components(first)
    placed = met.select("key", "k", "n", "m", "pos", "size").join(
        labels, met["k"] == labels["vertex"], "left").select(
        "key", "k", "n", "m", "pos", "size",
        F.coalesce("component", "k").alias("component"))
    placed = staged(placed, "placed")
    open_keys = placed.groupBy("key").agg(
        F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("key")
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    chunk = F.pmod(F.xxhash64("k"), F.col("chunks")).cast("int")
    parts = placed.join(open_keys, "key").withColumn("chunks", chunks).withColumn(
        "chunk", chunk).join(able.select("k", "cells"), "k").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
        "chunk", "k", "n", "m", "pos", "component", "cells")
    kind = dict(units.dtypes)["k"]
    across = parts.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(
        _across, f"x {kind}, y {kind}").select(
        F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct().join(
        tried, ["x", "y"], "left_anti")
    return first.union(check(across, units))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, ``n_shingles`` and ``component_id``, the smallest key
    that links reach.

    A null or empty text, or one without words, has 0 shingles and links with nothing, nor
    do two such texts. A row with a null key has its size and a null component. Rows that
    repeat a key are one document: it links where any of them does. Ties do not matter: the
    link condition is exact and inclusive.
    """
    units = staged(shared_keys(docs, key, text), "shingles")
    labels = components(links(units))
    return units.join(labels, units["k"] == labels["vertex"], "left").select(
        F.col("k").alias(key), F.col("n").alias("n_shingles"),
        F.coalesce("component", "k").alias("component_id"))
