"""Min-max near duplicates against all pairs."""

import random

import numpy as np
import pytest

from riskflow.llm.minmax_dups import MinMax, band_buckets, min_max, near_duplicates, shingle_sets, similarity
from riskflow.llm.queries import QUERIES
from riskflow.llm.shares import join_groups
from riskflow.llm.tables import store
from riskflow.llm.word_runs import WORD

from .conftest import passage

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOW))
    return frozenset(tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()


def truth(rows):
    """Rows as documents of their own; those without an id link with nothing."""
    sets = [shingles(t) for _, t in rows]
    of = {}
    for i, s in enumerate(sets):
        for x in s:
            of.setdefault(x, []).append(i)
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        if rows[i][0] is None:
            continue
        for j in {j for x in s for j in of[x] if j < i and rows[j][0] is not None}:
            both = len(s & sets[j])
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted(map(str, ((d, len(sets[i]), least.get(top(i)), d is None or least[top(i)] == d) for i, (d, _) in enumerate(rows))))


def family(rng, words, n):
    """Texts that drift apart by single words, so that links form chains."""
    out = [[f"w{rng.randrange(10**6)}" for _ in range(words)]]
    for _ in range(n - 1):
        new = list(rng.choice(out))
        for _ in range(rng.randint(0, max(1, words // 25))):
            new[rng.randrange(words)] = f"w{rng.randrange(10**6)}"
        out.append(new)
    return [" ".join(w) for w in out]


@pytest.mark.parametrize("block", [400, 7])
def test_equal_to_all_pairs(spark, texts, block):
    rng = random.Random(5)
    rows = list(texts)
    for words, n in ((5, 20), (8, 20), (40, 40), (120, 60), (400, 30)):
        rows += [(rng.randrange(100, 5000), t) for t in family(rng, words, n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = near_duplicates(docs, MinMax(block=block))
    assert sorted(str(tuple(r)) for r in got.collect()) == truth(rows)


def test_odd_rows(docs, texts, no_docs):
    assert sorted(str(tuple(r)) for r in near_duplicates(docs).collect()) == truth(texts)
    assert near_duplicates(no_docs).count() == 0


def test_only_plain_letters_are_folded():
    a, b, c = shingle_sets(["ONE Two three FOUR", "one two three four", "one two three fourÉ"], 4)
    d, = shingle_sets(["one two three fouré"], 4)
    assert (a == b).all() and not (c == d).any()


def test_half_the_evaluations_estimate_as_well():
    """With n permutations the two values vary less than n * 2 minima, and meet the similarity on average."""
    rng = np.random.default_rng(4)
    n, errors, minima = 32, [], []
    for _ in range(150):
        ids = rng.integers(0, 1 << 63, 60, np.uint64)
        a, b = np.sort(ids[:50]), np.sort(ids[10:])
        values = min_max([a, b], 2 * n)
        errors.append(similarity(values[0, :n], values[1, :n]) - 40 / 60)
        minima.append((values[0, :, 0] == values[1, :, 0]).mean() - 40 / 60)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 1.1 * np.std(minima)


def test_pairs_at_the_threshold_meet_in_a_bucket():
    rng, rule = np.random.default_rng(6), MinMax()
    for size in (5, 50):
        sets = []
        for _ in range(300):
            ids = rng.integers(0, 1 << 63, size, np.uint64)
            sets += [np.sort(ids), np.sort(ids[:size * 4 // 5])]
        buckets = band_buckets(min_max(sets, rule.bands * rule.rows), rule.bands)
        assert (buckets[::2] == buckets[1::2]).any(axis=1).all()


def test_join_groups_slices_what_is_hot(spark):
    rows = spark.createDataFrame([("hot", i) for i in range(900)] + [("cold", 1), (None, 2)], "k string, v long")
    groups = store(rows.where("k is not null").groupBy("k").count(), "groups")
    got = join_groups(rows, groups, "k", "count", "v", "left", shares=10)
    assert got.count() == 902 and got.where("k = 'hot' and `count` = 900").count() == 900 and got.where("`count` is null").count() == 1


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(str(tuple(r)) for r in QUERIES["op11_minmax_near_dups"](spark, sf).collect()) == truth([tuple(r) for r in docs])
