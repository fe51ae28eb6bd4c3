import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from adflow.llm import text as tx

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = st.lists(st.one_of(st.none(), st.text(
    alphabet=st.sampled_from(list("aAbZ 09\n\t\x0b\x1c.-é日")), max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    column = pa.array(texts, pa.string())
    for ends, pattern, lower in (
        (tx.BLANK, r"[^\x20\x09-\x0D]+", False), (tx.NOT_ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True),
        (tx.NEWLINE, r"[^\n]+", False),
    ):
        words = tx.Texts.of(column, lower).words(ends)
        got = [w.decode() for w in words.strings()]
        want = [re.findall(pattern, (t or "").translate(LOWER) if lower else t or "") for t in texts]
        assert got == [w for row in want for w in row]
        assert words.counts.tolist() == [len(w) for w in want]


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_hashes_are_equal_for_equal_words_only(texts):
    words = tx.Texts.of(pa.array(texts, pa.string())).words()
    names, hashes = words.strings(), words.hashes(most=7)
    assert len(set(zip(names, hashes.tolist()))) == len(set(names)) == len(set(hashes.tolist()))
    assert (hashes == words.hashes()).all()


def test_windows_stay_within_a_text():
    words = tx.Texts.of(pa.array(["a b c d", "a b c", "b c d", "x"])).words()
    at, keys = tx.windows(words.hashes(), words.rows(), 3)
    assert at.tolist() == [0, 1, 4, 7]
    assert keys[0] == keys[2] and keys[1] == keys[3] and keys[0] != keys[1]
    assert tx.joined(words.hashes()[:3]) == int(keys[0])


def test_slices_keep_rows_whole_and_in_order():
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["a" * 10, None, "", "b" * 50, "c", "d"])], names=["k", "text"])
    parts = list(tx.slices([batch], most=12))
    assert [p.num_rows for p in parts] == [3, 1, 2]
    assert np.concatenate([p.column("k").to_numpy() for p in parts]).tolist() == list(range(6))
    # A slice in the middle of a batch has its own bytes.
    assert tx.Texts.of(parts[2].column("text")).words().strings() == [b"c", b"d"]
