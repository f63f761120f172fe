"""Encoding, decoding, packing and archives: exact against the public library, round trips and brute force."""

import base64
import gc
import hashlib
import itertools
import math
import random
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskflow.llm import bpe, packing, warc
from riskflow.llm.codes import code_points, runs

from .conftest import passage

VOCAB = public_tokenizers.path("byte_bpe_50k.json")
SIGNS = st.lists(st.sampled_from(list("ab'stremvdl  \n\t1²½é中ñ!?<|>·\xa0\x1c\x85​　😀́Ⅷ") + ["<|endoftext|>", "'ll", " 's"]), max_size=40).map("".join)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCAB)


@given(st.lists(SIGNS, max_size=6))
@settings(max_examples=150, deadline=None)
def test_encoding_equals_the_library(texts):
    ids, bounds = bpe.Encoder(bpe.vocabulary(VOCAB), None).encode(texts)
    want = [x.ids for x in Tokenizer.from_file(VOCAB).encode_batch(texts, add_special_tokens=False)] if texts else []
    assert [ids[a:b].tolist() for a, b in itertools.pairwise(bounds)] == want


def test_documents_equal_the_library(docs, texts, library, no_docs):
    done = bpe.decode(bpe.encode(docs, VOCAB, bpe.build_lexicon(docs, VOCAB, 200)), VOCAB)
    want = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids) for i, t in texts)
    got = [(str(r.doc_id), list(r.ids), r.text) for r in done.collect()]
    assert sorted(g[:2] for g in got) == want
    assert all(library.decode(ids, skip_special_tokens=False) == text for _, ids, text in got)
    assert bpe.decode(bpe.encode(no_docs, VOCAB, bpe.build_lexicon(no_docs, VOCAB)), VOCAB).count() == 0


def test_round_trip_is_one_step_and_equals_encode_and_decode(docs):
    """Each Python step of a stage has workers of its own, with a vocabulary in each."""
    lexicon = bpe.build_lexicon(docs, VOCAB, 200)
    done = bpe.round_trip(docs, VOCAB, lexicon)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    both = bpe.decode(bpe.encode(docs, VOCAB, lexicon), VOCAB)
    assert sorted(map(tuple, done.collect()), key=str) == sorted(map(tuple, both.collect()), key=str)


def test_workers_keep_one_table(monkeypatch):
    """A worker lives longer than a query; the pieces of an earlier lexicon must not stay in it."""
    monkeypatch.setattr(bpe.SparkFiles, "get", lambda name: name)
    monkeypatch.setattr(bpe.Automaton, "mapped", lambda path: None)
    first = weakref.ref(bpe.worker_encoder(VOCAB, "a"))
    bpe.worker_encoder(VOCAB, "b")
    gc.collect()
    assert first() is None
    bpe.worker_encoder.cache_clear()


def test_bytes_that_are_no_text(spark, library):
    ids = [[447], [447, 247], [256, 50256, 5], []]
    frame = spark.createDataFrame([(n, x) for n, x in enumerate(ids)], "doc_id long, ids array<int>")
    assert [r.text for r in bpe.decode(frame, VOCAB).orderBy("doc_id").collect()] == [library.decode(x, skip_special_tokens=False) for x in ids]


def test_automaton(tmp_path):
    rng = random.Random(5)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(0, 7))) + rng.choice(["", "ing", "tion"]) for _ in range(800)}
    table = {w.encode(): [rng.randrange(1000) for _ in range(rng.randint(0, 3))] for w in words}
    made = bpe.Automaton.compile(table)
    (tmp_path / "a.bin").write_bytes(made.to_bytes())
    mapped = bpe.Automaton.mapped(str(tmp_path / "a.bin"))
    for n in range(1, 5):
        for w in map(bytes, itertools.product(b"abcin", repeat=n)):
            assert (mapped.ids(w) is None) == (w not in table)
    assert all(mapped.ids(w) == ids for w, ids in table.items())
    rights = {}                                              # minimal: as many states as different sets of endings
    for w in table:
        for i in range(len(w) + 1):
            rights.setdefault(w[:i], set()).add(w[i:])
    assert len(made.parts["final"]) == len({frozenset(r) for r in rights.values()})
    assert bpe.Automaton.compile({}).ids(b"a") is None


def test_worker_table_is_bounded(monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    encoder = bpe.Encoder(bpe.vocabulary(VOCAB), None)
    for seed in range(10):
        text = passage(seed, 90)
        assert encoder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(encoder) <= 50 + 91


def test_runs_cover_all():
    assert list(runs([3, 3, 9, 1, 1], 6)) == [(0, 2), (2, 3), (3, 5)] and list(runs([], 3)) == [] and list(runs([0, 0], 3)) == [(0, 2)]
    assert code_points([])[1].tolist() == [0]


def test_best_fit_and_search():
    rng = np.random.default_rng(1)
    for n, low, high in ((0, 1, 2), (1, 50, 51), (300, 1, 101), (300, 30, 38), (200, 40, 100), (400, 1, 20)):
        sizes = rng.integers(low, high, n)
        first, found = packing.best_fit(sizes, 100), packing.pack(sizes, 100)
        assert sorted(i for b in found for i in b) == list(range(n))
        assert all(sizes[b].sum() <= 100 for b in found)
        assert math.ceil(sizes.sum() / 100) <= len(found) <= len(first)


def test_exchanges_raise_the_squared_fill():
    rng = np.random.default_rng(2)
    sizes = rng.integers(20, 60, 120)
    search = packing.Search(sizes, packing.best_fit(sizes, 100)[::-1], 100)
    shift, values = search.shift, [int((search.fill ** 2).sum())]

    def watched(*args):
        shift(*args)
        values.append(int((search.fill ** 2).sum()))

    search.shift = watched
    search.run()
    assert len(values) > 1 and all(a < b for a, b in itertools.pairwise(values))


def test_search_empties_bins_that_best_fit_leaves():
    sizes = np.random.default_rng(1).integers(29, 37, 300)
    assert len(packing.pack(sizes, 100)) < len(packing.best_fit(sizes, 100))


def fewest_bins(sizes, capacity):
    """By trying all ways: per subset the fewest bins and the least fill of the last one."""
    best = {0: (1, 0)}
    for have in range(1, 1 << len(sizes)):
        options = []
        for i, size in enumerate(sizes):
            if have >> i & 1:
                bins, fill = best[have ^ 1 << i]
                options.append((bins, fill + size) if fill + size <= capacity else (bins + 1, size))
        best[have] = min(options)
    return best[(1 << len(sizes)) - 1][0]


def test_small_inputs_take_as_few_sequences_as_all_ways():
    rng = np.random.default_rng(12)
    more = 0
    for _ in range(80):
        sizes = rng.integers(1, 100, rng.integers(1, 10))
        extra = len(packing.pack(sizes, 100)) - fewest_bins(sizes.tolist(), 100)
        assert extra in (0, 1)
        more += extra
    assert more <= 4


def test_packing_documents(docs, texts, library, no_docs):
    got = packing.pack_documents(docs, VOCAB, capacity=256, group=12).toPandas()
    want = []
    for i, t in texts:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        head = len(ids) % 256 or 256
        cuts = [0, *range(head, len(ids) + 1, 256)]
        want += [(str(i), n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for n, (a, b) in enumerate(itertools.pairwise(cuts))]
    rows = [(str(None if math.isnan(r.doc_id) else int(r.doc_id)), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples()]
    assert sorted(rows) == sorted(want)
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.length.sum() <= 256 and (own.offset == own.length.cumsum() - own.length).all()
    assert packing.pack_documents(no_docs, VOCAB).count() == 0


def page_rows():
    big = passage(1, 4000) + "é"
    return [(1, "http://a", big), (2, None, None), (3, "http://c\r\nx", big), (4, "", ""), (4, "", ""), (5, "http://d", "WARC/1.1\r\n\r\nbody\r\n\r\n"),
            (None, "http://n", big), (None, "http://n", "alone"), (0, "http://z", "short"), (6, "http://e", "short")]


def test_archives(spark):
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, key string, bundle int")
    index = warc.write_bundles(pages, frame_bytes=3000, bundle_bytes=30_000)
    got = sorted(map(str, map(tuple, warc.read_bundles(index).collect())))
    first = {}
    for i, _, h in rows:
        h = h or ""
        first[h] = min((x for x in (first.get(h), i) if x is not None), default=None)
    want = []
    for i, _, h in rows:
        h = h or ""
        revisit = first[h] is not None and i != first[h]
        digest = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        want.append(str((i, len(h.encode()), digest, "revisit" if revisit else "response", first[h] if revisit else None)))
    assert got == sorted(want)
    placed = index.collect()
    assert len({r.record_id for r in placed}) == len(rows)                 # also where rows repeat an id or have none
    for r in placed[:40]:
        with open(r.bundle.removeprefix("file://"), "rb") as file:
            file.seek(r.frame_start)
            data = zstandard.ZstdDecompressor().decompress(file.read(r.frame_size), max_output_size=1 << 24)
        fields, _, _ = warc.parse_record(data[r.offset:r.offset + r.size])
        assert fields["WARC-Record-ID"] == r.record_id and fields["WARC-Page-ID"] == ("" if r.page_id is None else str(r.page_id))
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_bundles_are_plain_zstandard(tmp_path):
    records = [warc.make_record(f"<urn:{i}>", i, f"http://{i}", passage(i, 50 * i).encode(), "D", 1, None) for i in range(12)]
    writer = warc.BundleWriter(f"file://{tmp_path}/x.warc.zst", 2000)
    for i, r in enumerate(records):
        writer.add(i, r)
    index = writer.close()
    with open(tmp_path / "x.warc.zst", "rb") as file:
        whole = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
    assert whole == b"".join(records)                          # readers that know no seek table skip it
    assert len({r[3] for r in index}) > 1
    fields, _, payload = warc.parse_record(records[3])
    assert payload == passage(3, 150).encode() and fields["WARC-Type"] == "response"
    with pytest.raises(ValueError):
        warc.parse_record(b"x")
