"""Exact, line and near-duplicate removal against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.llm import exact_dedup, line_dedup, near_dups
from riskflow.llm.components import connected_components

from .conftest import passage


def fold(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def exact_truth(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[fold(t)].append(i)
    out = {}
    for t, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = min(named) if named else None
        for i in set(ids):
            out[i, hashlib.sha256(t.encode()).hexdigest()] = (keep, len(ids), i == keep)
    return out


@pytest.mark.parametrize("digest", [exact_dedup.chunk_digest, lambda c: F.unhex(F.substring(F.md5(c), 1, 2))], ids=["md5", "clashing"])
def test_exact(docs, texts, digest):
    got = {(r.doc_id, r.text_sha256): (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs, digest).collect()}
    assert got == exact_truth(texts)


def test_exact_without_rows(no_docs):
    assert exact_dedup.exact_groups(no_docs).count() == 0
    assert exact_dedup.drop_copies(no_docs).count() == 0


def test_chunks_rebuild_the_text(spark):
    text = passage(5, 4000) + "日" * 9000
    row = spark.createDataFrame([(text,)], "text string").select(exact_dedup.chunks_of(F.col("text")).alias("c")).first()
    assert "".join(row.c) == text and max(map(len, row.c)) <= 4096


def test_drop_copies_keeps_one_row_and_all_columns(docs, texts):
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    want = {(i, h) for (i, h), (_, _, stays) in exact_truth(texts).items() if stays}
    got = [(r.doc_id, hashlib.sha256(fold(r.text).encode()).hexdigest()) for r in kept.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def sentence_places(text):
    """(start, end, keys) of the sentences, per line."""
    out, at = [], 0
    for line in (text or "").split("\n"):
        parts = [p for p in re.split(r"(?<=[.!?])(?=[\x20\x09-\x0D])|(?<=[\u3002\uff01\uff1f])", line) if p]
        merged = []
        for p in parts:                                   # white space belongs to the sentence before it
            head = re.match(r"[\x20\x09-\x0D]*", p).group()
            if merged and head:
                merged[-1] += head
                p = p[len(head):]
            if p:
                merged.append(p)
        words = [re.findall(r"[^\x20\x09-\x0D]+", p.lower()) for p in merged]
        row = []
        for i, p in enumerate(merged):
            if len(words[i]) >= 12 or any(len(w) >= 40 for w in words[i]):
                keys = [tuple(words[i])]
            else:
                keys = [(k, *words[a], None, *words[a + 1]) for k, a in (("<", i - 1), (">", i)) if words[i] and a >= 0 and a + 1 < len(merged)
                        and len(words[a]) + len(words[a + 1]) >= 12]
            row.append((at, at + len(p), keys))
            at += len(p)
        out.append(row)
        at += 1
    return out


def line_truth(rows):
    first = {}
    for i, t in sorted((r for r in set(rows) if r[0] is not None), key=lambda r: r[0]):
        for _, _, keys in (s for line in sentence_places(t) for s in line):
            for k in keys:
                first.setdefault(k, i)
    out = {}
    for i, t in set(rows):
        kept, spans, seen = [], [], set()
        for line in sentence_places(t):
            stays = []
            for a, b, keys in line:
                if any(k in seen or first.get(k, i) != i for k in keys):
                    spans.append((a, b))
                else:
                    stays.append(t[a:b])
                seen.update(keys)
            if stays or not line:
                kept.append("".join(stays))
        out[i, t] = ("\n".join(kept), spans)
    return out


def test_lines(docs, texts):
    got = {(r.row.doc_id, r.row.text): (r.text, [tuple(s) for s in r.removed]) for r in line_dedup.drop_repeats(docs).collect()}
    want = line_truth(texts)
    assert got == want
    assert any(s for _, s in want.values())
    for (_, text), (_, spans) in got.items():
        assert all("\n" not in text[a:b] for a, b in spans)


def test_passages_inside_longer_lines(spark):
    shared = " ".join(f"{passage(60 + i, n).capitalize()}." for i, n in enumerate((14, 5, 20, 3, 16, 30)))
    cjk, link = "\u65e5\u672c" * 25 + "\u3002", "https://example.org/" + "a" * 60
    rows = [(i, f"{passage(70 + i, 20)}. {shared} {passage(80 + i, 9)}.\n{passage(90 + i, 6)} {link}! end\n{cjk}{i}{cjk}") for i in range(4)]
    rows += [(9, "Short one. " * 3), (10, "Short one. Other."), (11, None), (12, "\n\n")]
    got = {(r.row.doc_id, r.row.text): (r.text, [tuple(s) for s in r.removed]) for r in line_dedup.drop_repeats(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == line_truth(rows)
    for i in (1, 2, 3):
        left = got[rows[i]][0]
        assert passage(70 + i, 20) in left and passage(80 + i, 9) in left and left.split("\n")[-1].startswith(str(i))
        assert not any(passage(60 + k, n).capitalize() in left for k, n in enumerate((14, 5, 20, 3, 16, 30)))


def test_lines_without_rows(no_docs):
    assert line_dedup.drop_repeats(no_docs).count() == 0


def shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def near_truth(rows):
    named = [(i, shingles(t)) for i, t in rows if i is not None]
    root, links = {i: i for i, _ in named}, [0] * len(named)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, (i, a) in enumerate(named):
        for y, (j, b) in enumerate(named[:x]):
            if a and b and len(a & b) >= 0.8 * len(a | b):
                links[x] += 1
                links[y] += 1
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return Counter((i, find(i), links[x]) for x, (i, _) in enumerate(named))


@pytest.mark.parametrize("block", [400, 2])
def test_near(docs, texts, block):
    got = [tuple(r) for r in near_dups.near_duplicates(docs, near_dups.Join(block=block)).collect()]
    assert Counter(g for g in got if g[0] is not None) == near_truth(texts)
    assert [g for g in got if g[0] is None] == [(None, None, 0)] * 3


def test_near_groups_of_copies_over_blocks(spark):
    base = passage(20, 100).split()
    rows = []
    for i in range(60):
        words = list(base)
        words[3 + i % 50] = f"w{i}"
        rows.append((1000 + i, " ".join(words)))
    rows += [(2000 + i, passage(100 + i, 60)) for i in range(30)] + [(3000, rows[0][1]), (3001, rows[0][1])]
    found = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), near_dups.Join(block=7))
    assert Counter(tuple(r) for r in found.collect()) == near_truth(rows)


def test_near_id_with_two_texts(spark):
    a, b = passage(50, 90), passage(51, 90)
    rows = [(1, a), (2, a + " more"), (3, b), (3, a + " tail"), (4, b + " end"), (5, passage(52, 90))]
    got = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.class_id) for r in got} == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 5)}


def test_near_stage(docs, no_docs):
    kept = near_dups.one_of_each_group(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert not {2, 3, 13} & set(ids) and {1, 4, 5, 6, 7, 12} <= set(ids) and ids.count(None) == 3
    assert near_dups.one_of_each_group(no_docs).count() == 0


def test_pruning_keeps_every_linked_pair():
    rng = np.random.default_rng(3)
    join, base = near_dups.Join(), rng.integers(0, 1 << 62, 200).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(200) > 0.08], rng.integers(0, 1 << 62, rng.integers(0, 30)).astype(np.uint64)])) for _ in range(60)]
    values = near_dups.min_hashes(sets, join.values)
    a, b = near_dups.surviving_pairs(values, values, True, join)
    shared = near_dups.shared_counts(sets, a, b)
    exact = {(i, j): len(np.intersect1d(sets[i], sets[j])) for i in range(60) for j in range(i + 1, 60)}
    assert dict(zip(zip(a.tolist(), b.tolist(), strict=True), shared.tolist(), strict=True)).items() <= exact.items()
    assert {p for p, n in exact.items() if n >= 0.8 * (len(sets[p[0]]) + len(sets[p[1]]) - n)} <= set(zip(a.tolist(), b.tolist(), strict=True))


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (102, 101), (200, 200), (103, 102), (100, 101)] + [(500 + i, 600) for i in range(20)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 104), 100), **dict.fromkeys([*range(500, 520), 600], 500)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
