"""Periodic runs against a comparison of all periods."""

import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.llm.queries import QUERIES
from riskflow.llm.word_runs import WORD, RunRule, collapse, minimizers, periodic_runs, runs_of, strongest, with_planted
from zlib import crc32


def truth(words, least=24, times=3):
    n, found = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q):
                part = words[i:i + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    h, n = crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def row_truth(doc_id, text, change=planted):
    words = change(doc_id, WORD.findall(text or ""))
    runs = truth(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def nested(rng, n, letters):
    """Words with periods inside periods, single changed words and runs that end at the text's edges."""
    words = []
    while len(words) < n:
        unit = [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 9, 14, 15, 16, 17, 23, 24, 25, 26, 36, 37, 60]))]
        if rng.random() < 0.5:
            unit = unit * rng.randint(2, 5) + [rng.choice(letters) for _ in range(rng.randint(0, 6))]
        words += (unit * rng.randint(1, 6))[:rng.randint(1, 5 * len(unit))]
        if words and rng.random() < 0.3:
            words[rng.randrange(len(words))] = "z"
    return words[:n]


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefghijklm", [str(i) for i in range(400)]], ids=["one", "two", "some", "many"])
def test_runs_equal_all_periods(letters):
    rng = random.Random(7)
    texts = [nested(rng, rng.choice([0, 1, 23, 24, 25, 80, 300, 700]), letters) for _ in range(60)]
    for words, runs in zip(texts, runs_of(texts), strict=True):
        assert [tuple(r) for r in runs.tolist()] == truth(words)


def test_every_long_period_is_met():
    rng = random.Random(8)
    for q in [*range(14, 60), 97, 143, 144, 145, 331]:
        unit = [str(rng.randrange(10**6)) for _ in range(q)]
        words = ["x", *(unit * 3), "y"] + [str(i) for i in range(50)]
        assert [tuple(r) for r in runs_of([words, ["b"] * 30])[0].tolist()] == [(1, 3 * q, q)]


def test_a_binary_overlap_free_word_has_no_run():
    words = [bin(i).count("1") % 2 for i in range(1 << 13)]           # running hashes over powers of two meet on such words
    assert len(runs_of([[str(w) for w in words]])[0]) == 0


def test_minimizers_are_the_leftmost_least_of_each_window():
    rng = np.random.default_rng(3)
    for w in (1, 2, 5, 8, 9):
        h = rng.integers(0, 9, 200).astype(np.uint64) << np.uint64(50)
        assert minimizers(h, w).tolist() == sorted({i + int(np.argmin(h[i:i + w])) for i in range(200 - w + 1)})


def test_collapse_and_the_strongest():
    words = ["s", *(["a", "b"] * 15), "t"]
    (runs,) = runs_of([words])
    assert collapse(words, runs) == ["s", "a", "b", "t"] and strongest(runs) == (1, 30, 2, 15000)
    assert strongest(runs[:0]) == (None,) * 4


def test_odd_rows(spark, docs, texts, no_docs):
    got = sorted(map(str, (tuple(r) for r in periodic_runs(docs, planted=True).collect())))
    want = sorted(str((i, *row_truth(i, t, planted if i is not None else lambda _, w: w))) for i, t in texts if len(t or "") < 20_000)
    assert set(want) <= set(got) and len(got) == len(texts)
    assert periodic_runs(no_docs).count() == 0
    one = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    assert periodic_runs(one).first().n_runs == 1 and periodic_runs(one, RunRule(least=41)).first().n_runs == 0


def test_planted_tails_follow_the_rule():
    for i in range(200):
        words = [str(w) for w in range(i % 37)]
        assert with_planted(i, words) == planted(i, words)


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_periodic_runs"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where(F.length("text") < 15_000).collect()
    assert len(docs) > 150 and len(got) >= len(docs)
    assert {r.doc_id: got[r.doc_id] for r in docs} == {r.doc_id: row_truth(r.doc_id, r.text) for r in docs}
