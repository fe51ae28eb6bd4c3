import random
import re

from adflow.llm import host_rules as hr

from .conftest import words


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(lines), len(hit))


def test_measures_equal_brute_force(make_docs, odd_rows):
    rng = random.Random(2)
    rows = [r for r in odd_rows if r[0] not in (5, 6, 8)] + [
        (k, rng.choice([" ", "\n"]).join(words(rng, rng.randrange(0, 60), 8)) + "#é<日|" * (k % 3)) for k in range(100, 160)]
    got = {r["doc_id"]: tuple(r[m] for m in hr.MEASURES) for r in hr.measures(make_docs(rows), ["doc_id"]).collect()}
    assert got == {k: brute(t) for k, t in rows}


def hosts(rng):
    good = lambda: " ".join(words(rng, 80))
    rows = [(k, good() if k % 10 else "bad", "en", "clean") for k in range(60)]
    rows += [(100 + k, "bad" if k % 10 else good(), "en", "spam") for k in range(60)]
    rows += [(200, "bad", "en", "tiny"), (201, good(), "en", None), (202, "bad", "en", None)]
    return rows


def test_hosts_with_many_failures_are_rejected(make_docs):
    rows = hosts(random.Random(3))
    got = {r["doc_id"]: r for r in hr.judge(make_docs(rows)).collect()}
    assert len(got) == len(rows)
    for k, text, _, host in rows:
        base = len(text.split()) < 50
        assert got[k]["base_failed"] == base
        assert got[k]["kept"] == (not base and host != "spam")
    assert 0 < got[0]["host_rate"] < 0.3 < got[100]["host_rate"] < 1
    # One failing document does not say much about its host.
    assert got[200]["host_rate"] < 0.95


def test_kept_rows_are_those_of_judge(make_docs):
    df = make_docs(hosts(random.Random(3))).selectExpr("*", "1 AS h", "2 AS t", "3 AS row", "4 AS kept")
    kept = hr.kept(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {
        r["doc_id"] for r in hr.judge(df).where("kept").collect()}


def test_empty_and_single_host(make_docs, odd_rows):
    assert hr.judge(make_docs([])).count() == 0 and hr.kept(make_docs([])).count() == 0
    assert hr.judge(make_docs(odd_rows)).count() == len(odd_rows)
