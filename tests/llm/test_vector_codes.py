import hashlib
import math

import numpy as np
import pytest

from adflow.llm import vector_codes as vc
from adflow.llm.orchard import Orchard

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, parts=16, size=64, rounds=2):
    """(id, code, error, label error, digest) per kept row, in plain Python integers."""
    kept = [(k, [math.floor(256 * x) for x in v], label) for k, v, label in rows if good(v)]
    if not kept:
        return []
    first = {}
    for k, v, _ in kept:
        if k is not None:
            first[k] = min(first.get(k, v), v)
    width = len(next(iter(first.values()))) // parts
    cut = lambda v: [v[p * width:(p + 1) * width] for p in range(parts)]
    books = [[cut(first[k])[p] for k in sorted(first)[:size]] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            own = [(nearest(p, cut(v)[p])[1], cut(v)[p]) for _, v, _ in kept]
            book = []
            for k, e in enumerate(books[p]):
                mine = [x for at, x in own if at == k]
                book.append([sum(c) // len(mine) for c in zip(*mine)] if mine else e)
            new.append(book)
        books = new
    text = ",".join(str(x) for book in books for e in book for x in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    coded = []
    for k, v, label in kept:
        found = [nearest(p, x) for p, x in enumerate(cut(v))]
        coded.append((k, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found), label))
    total = {}
    for _, _, e, label in coded:
        total[label] = total.get(label, 0) + e
    return [(k, c, e, total[label], digest) for k, c, e, label in coded]


def collected(df):
    return sorted(((r["vec_id"], r["code"].hex(), r["error"], r["label_error"], r["codebooks_sha256"])
                   for r in df.collect()), key=str)


def vectors(rng, n, width=32):
    return [[rng.gauss(0, 0.2) for _ in range(width)] for _ in range(n)]


def as_float(rows):
    """The rows as 32-bit floats hold them."""
    return [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label)
            for k, v, label in rows]


def test_against_brute_force(spark, rng):
    rows = [(k * 3, v, rng.choice([None, 1, 2])) for k, v in enumerate(vectors(rng, 150))]
    rows += [(1000 + k, rows[k][1], 1) for k in range(10)]
    rows = as_float(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert collected(vc.compress(df)) == sorted(brute(rows), key=str)


def test_odd_rows(spark, rng):
    a, b, c = vectors(rng, 3, 16)
    rows = as_float([
        (5, a, None), (1, None, 1), (2, [None] * 16, 1), (3, [float("nan")] + a[1:], 1),
        (4, [float("inf")] + a[1:], 1), (None, b, None), (7, c, 2), (7, b, 2), (7, c, 2), (8, [0.0] * 16, 2)])
    df = spark.createDataFrame(rows, SCHEMA)
    got = collected(vc.compress(df))
    assert got == sorted(brute(rows), key=str) and len(got) == 6


def test_lengths_range_and_empty(spark, rng):
    a, b = vectors(rng, 2, 16)
    rows = [(1, a, 1), (2, b, 1), (3, a + b, 1), (4, [], 1), (5, [1e30] + a[1:], 1)]
    got = vc.compress(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r["vec_id"] for r in got) == [1, 2]
    assert vc.compress(spark.createDataFrame([], SCHEMA)).collect() == []
    assert vc.compress(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []
    with pytest.raises(ValueError, match="equal parts"):
        vc.compress(spark.createDataFrame([(1, a[:15], 1)], SCHEMA))


def test_clashing_names_and_other_sizes(spark, rng):
    rows = as_float([(k, v, k % 2) for k, v in enumerate(vectors(rng, 40, 8))])
    df = spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows],
                               "l bigint, v array<float>, id int, code string, error int, salt double")
    got = vc.compress(df, "l", "v", "id", parts=4, size=7, rounds=3)
    want = {r[0]: r[1:] for r in brute(rows, 4, 7, 3)}
    assert {r["l"]: (r["code"].hex(), r["error"], r["label_error"], r["codebooks_sha256"])
            for r in got.collect()} == want


def test_decoded_vectors_have_the_stated_error(spark, rng):
    rows = as_float([(k, v, 0) for k, v in enumerate(vectors(rng, 90))])
    df = spark.createDataFrame(rows, SCHEMA)
    books = vc.fit(df)
    own = {r[0]: r[1] for r in rows}
    for r in vc.decode(vc.encode(df, books), books).collect():
        error = sum((math.floor(256 * x) - round(256 * y)) ** 2 for x, y in zip(own[r["vec_id"]], r["vector"]))
        assert error == r["error"] and len(r["vector"]) == 32


def test_orchard_finds_the_nearest(rng):
    """Ties and equal entries too: coordinates of a few values only."""
    for size in (1, 2, 64):
        entries = np.array([[[rng.randrange(4) for _ in range(3)] for _ in range(size)] for _ in range(2)])
        queries = np.array([[[rng.randrange(-2, 7) for _ in range(3)] for _ in range(2)] for _ in range(300)])
        best, far = Orchard(entries).nearest(queries)
        apart = ((queries[:, :, None, :] - entries[None]) ** 2).sum(axis=3)
        assert (best == apart.argmin(axis=2)).all() and (far == apart.min(axis=2)).all()
