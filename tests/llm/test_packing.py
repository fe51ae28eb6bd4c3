import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from adflow.llm import packing as pk

from .conftest import words

ODD = [
    "", None, "Ünïcode ΣΑΣ don't x<|endoftext|>y 'S", "é ́a \x1cfoo\x0bbar 日本語 12345 a​b", " \n\t ",
    "'ve 't\n\n\t'll", "　　", "İstanbul ǅ ﬁ #tag <|startoftext|>",
]


@pytest.fixture(scope="module")
def reference():
    own = Tokenizer.from_file(public_tokenizers.path(pk.VOCABULARY))
    return lambda text: own.encode(text or "", add_special_tokens=False).ids + [pk.END]


def test_ids_are_those_of_the_whole_text(reference):
    rng = random.Random(1)
    texts = ODD + [" ".join(words(rng, 60)).title() + rng.choice(ODD[2:]) for _ in range(30)]
    tokens = pk.WordTokens(pk.VOCABULARY)
    for _ in range(2):  # the second time out of the cache
        ids, at = tokens.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [reference(t) for t in texts]
    ids, at = tokens.encode(pa.array([None, ""]))
    assert ids.tolist() == [0, 0] and at.tolist() == [0, 1, 2]


def test_pieces_and_sequences(spark, make_docs, reference, monkeypatch):
    monkeypatch.setattr(pk, "SALT_ROWS", 20)
    rng = random.Random(2)
    rows = [(k, t) for k, t in enumerate(ODD)] + [
        (100 + k, " ".join(words(rng, rng.randrange(0, 300)))) for k in range(150)] + [(None, "no key"), (100, "again")]
    size = 256
    packed = pk.pack(make_docs(rows, 5), size=size, with_ids=True).cache()
    got = packed.collect()
    want = Counter()
    for key, text in rows:
        ids = reference(text)
        for p in range(0, len(ids), size):
            piece = np.array(ids[p:p + size], "<u4")
            want[(key, p // size, p, len(piece), zlib.crc32(piece.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= size
    total = sum(r["length"] for r in got)
    assert len(places) <= 1.03 * total / size + 1
    whole = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in pk.sequences(packed).collect()}
    for r in got:
        piece = whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]]
        assert zlib.crc32(piece.tobytes()) == r["ids_crc32"]


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_and_few_sequences(seed):
    rng = random.Random(seed)
    kinds = [lambda: rng.randrange(1, 2049), lambda: min(2048, int(rng.expovariate(1 / 600)) + 1), lambda: rng.choice([700, 1400, 2048, 3])]
    lengths = Counter(kinds[seed % 3]() for _ in range(rng.choice([1, 50, 3000])))
    planned = pk.plan(dict(lengths))
    used = Counter()
    for content, n in planned:
        assert n > 0 and sum(content) <= 2048
        for length in content:
            used[length] += n
    assert used == lengths
    best = sum(n for _, n in pk._best_fit([], dict(lengths), 2048))
    assert sum(n for _, n in planned) <= best


def test_repair_keeps_full_sequences():
    """Full sequences stay; what the loose ones hold fits into fewer."""
    planned = [((2048,), 5), ((1024, 1024), 2), ((1500,), 3), ((548,), 3)]
    got = pk._repaired(planned, 2048)
    assert sum(n for _, n in got) == 10
    assert Counter(dict(planned))[(1024, 1024)] == sum(n for c, n in got if c == (1024, 1024))
    assert sum(n for c, n in got if sorted(c) == [548, 1500]) == 3


def test_clashing_names(make_docs):
    rows = [(1, "one text"), (2, None), (1, "one text")]
    docs = make_docs(rows).selectExpr("*", "1 AS k", "2 AS t", "3 AS piece", "4 AS length", "5 AS salt", "6 AS ids")
    plain = pk.pack(make_docs(rows)).drop("sequence_id", "offset").collect()
    assert Counter(pk.pack(docs).drop("sequence_id", "offset").collect()) == Counter(plain)


def test_plan_size_does_not_follow_the_data():
    lengths = {k: 3 for k in range(1, 2049, 3)}
    small, large = pk.plan(lengths), pk.plan({k: n * 10**9 for k, n in lengths.items()})
    assert len(large) < 4 * len(small) + 4000


def test_least_squares_against_its_conditions():
    rng = np.random.default_rng(3)
    columns = pk.patterns(12) - 1
    columns[columns < -1] = -1
    target, weight = rng.integers(0, 50, 12).astype(float), np.ones(12)
    x = pk.nnls(columns, target, weight, rounds=500, at_once=1)
    matrix = np.zeros((12, len(columns)))
    for k, c in enumerate(columns):
        for row in c[c >= 0]:
            matrix[row, k] += 1
    slope = matrix.T @ (target - matrix @ x)
    assert (x >= 0).all() and (slope <= 1e-3 * target.max()).all() and (np.abs(slope[x > 0]) < 1e-3).all()


def test_empty_table(make_docs):
    assert pk.pack(make_docs([])).count() == 0
    assert pk.plan({}) == []
