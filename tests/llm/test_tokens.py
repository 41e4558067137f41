"""Encoding, packing and id matrices against the tokenizers library and exact round trips."""

import functools
import hashlib
import itertools
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from isallobar.llm import bpe, packing, token_output
from isallobar.llm.queries import vocabulary_path
from tests.llm.fixtures import TEXTS, documents, empty, prose


@functools.cache
def shared_library():
    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def library():
    return shared_library()


@pytest.fixture(scope="module")
def table():
    return bpe.MergeTable.load(vocabulary_path())


def test_texts_encode_as_the_library_does(library, table):
    texts = ["" if t is None else t for t in TEXTS] + ["Ა new letters Ᲊ x", "a b　c", "''s 'S", " 's", "\n's"]
    for text, ids in zip(texts, table.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert table.decode(ids).decode("utf-8", "replace") == library.decode(ids.tolist(), skip_special_tokens=False) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aàs'tvremld  \n\t12.!_é日😀 ½<|endoftext>"), max_size=40), max_size=6))
def test_random_texts_encode_as_the_library_does(texts):
    for text, ids in zip(texts, bpe.MergeTable.load(vocabulary_path()).encode(texts), strict=True):
        assert ids.tolist() == shared_library().encode(text, add_special_tokens=False).ids


def test_words_that_share_a_hash_are_told_apart(monkeypatch, table):
    monkeypatch.setattr(np.random, "default_rng", lambda seed: type("R", (), {"integers": lambda self, a, b, n, dtype: np.zeros(n, dtype)})())
    data = np.frombuffer(b"abcdab", np.uint8)
    group, leader = bpe.fold_words(data, np.array([0, 2, 4]), np.array([2, 2, 2]))
    assert group.tolist() == [0, 1, 0] and leader.tolist() == [0, 1]


def test_word_store_starts_afresh(monkeypatch, library):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 3)
    table = bpe.MergeTable(vocabulary_path())
    for k in range(4):
        text = prose(k, 300)
        assert table.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_encoding_query(spark, library):
    docs = documents(spark)
    rows = bpe.encoding_digests(docs, vocabulary_path()).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    whole = bpe.encode_documents(docs, vocabulary_path())
    assert {r.doc_id: r.decoded for r in whole.collect()} == texts
    assert bpe.encoding_digests(empty(spark), vocabulary_path()).count() == 0
    named = spark.createDataFrame([("a-1", "some text"), (None, None)], "doc_id string, text string")
    assert {r.doc_id: r.n_tokens > 0 for r in bpe.encoding_digests(named, vocabulary_path()).collect()} == {"a-1": True, None: False}


@settings(max_examples=150, deadline=None)
@given(st.integers(5, 60), st.lists(st.integers(1, 60), max_size=70))
def test_plans_hold_every_piece_once_and_beat_best_fit(capacity, lengths):
    counts = Counter(min(x, capacity) for x in lengths)
    plan = packing.plan_packing(dict(counts), capacity)
    held = Counter()
    for f in plan:
        assert sum(f.lengths) <= capacity
        for x in f.lengths:
            held[x] += f.times
    assert +held == +counts
    assert sum(f.times for f in plan) <= sum(f.times for f in packing.best_fit_decreasing(dict(counts), capacity))
    places = packing.place_table(plan)
    used = defaultdict(list)
    for length, rank, times, base, offset in places.tolist():
        for k in range(times):
            used[base + k].append((offset, length))
    for parts in used.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length


def least_bins(lengths, capacity):
    best = len(lengths)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + lengths[k] <= capacity and bins.index(bins[j]) == j:
                go(k + 1, [*bins[:j], bins[j] + lengths[k], *bins[j + 1 :]])
        go(k + 1, [*bins, lengths[k]])

    go(0, [])
    return best


def test_small_packings_are_optimal():
    for seed in range(60):
        rnd = random.Random(seed)
        capacity = rnd.choice([10, 17, 50])
        lengths = sorted((rnd.randint(1, capacity) for _ in range(rnd.randint(0, 9))), reverse=True)
        plan = packing.plan_packing(dict(Counter(lengths)), capacity)
        assert sum(f.times for f in plan) == least_bins(lengths, capacity)


def test_search_beats_best_fit_and_holds_out_on_long_runs():
    saved = 0
    for seed in range(8):
        rnd = random.Random(seed)
        lengths = []
        for _ in range(40):  # forty sequences that three pieces fill without waste
            a = rnd.randint(260, 760)
            b = rnd.randint(260, 1000 - a - 200) if 1000 - a - 200 > 260 else 220
            lengths += [a, b, 1000 - a - b]
        counts = dict(Counter(lengths))
        first, found = (sum(f.times for f in p) for p in (packing.best_fit_decreasing(counts, 1000), packing.plan_packing(counts, 1000)))
        assert 40 <= packing.least_sequences(counts, 1000) <= found <= first
        saved += first - found
    assert saved >= 2
    # Runs of tiny pieces are as long as a sequence; the histogram stays small.
    plan = packing.plan_packing({2047: 5000, 2: 5000})
    assert sum(f.times for f in plan) == packing.least_sequences({2047: 5000, 2: 5000}, 2048) == 5005
    plan = packing.plan_packing({1: 10**7, 1025: 3 * 10**6, 700: 5, 2048: 7})
    assert sum(f.times for f in plan) == 3_000_007


def test_search_of_many_lengths_takes_little_memory():
    rnd = random.Random(1)
    counts = {x: rnd.randint(1, 9) for x in rnd.sample(range(300, 2000), 700)}
    assert sum(f.times for f in packing.best_fit_decreasing(counts, 2048)) > packing.least_sequences(counts, 2048)
    tracemalloc.start()
    plan = packing.plan_packing(dict(counts), nodes=0)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    placed = Counter()
    for f in plan:
        assert sum(f.lengths) <= 2048
        placed.update({x: n * f.times for x, n in Counter(f.lengths).items()})
    assert placed == counts and most < 4_000_000


def test_fillings_are_those_of_brute_force():
    rnd = random.Random(2)
    for _ in range(40):
        counts = {rnd.randint(1, 20): rnd.randint(1, 2) for _ in range(5)}
        lengths, room = sorted(counts), rnd.randint(1, 40)
        every = [c for c in itertools.product(*(range(counts[x] + 1) for x in lengths)) if sum(x * n for x, n in zip(lengths, c, strict=True)) <= room]
        wanted = set()
        for c in every:
            waste = room - sum(x * n for x, n in zip(lengths, c, strict=True))
            spare = [x for x, n in zip(lengths, c, strict=True) if n < counts[x]]
            if not any(y <= waste or any(n and x < y <= x + waste for x, n in zip(lengths, c, strict=True)) for y in spare):
                wanted.add((waste, tuple((x, n) for x, n in zip(lengths[::-1], c[::-1], strict=True) if n)))
        got = packing.fillings(room, counts, lengths, limit=10**6)
        assert set(got) == wanted and [f[0] for f in got] == sorted(f[0] for f in got)


def test_pieces_and_places(spark, library):
    docs = documents(spark)
    rows = packing.pack_documents(docs, vocabulary_path(), capacity=64).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    copies = Counter(r.doc_id for r in docs.collect())
    ids = {k: np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4") for k, t in texts.items()}
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    assert set(by_doc) == set(ids)
    for k, own in by_doc.items():
        assert sum(r.length for r in own) == copies[k] * len(ids[k])
        assert all(r.length == 64 or r.piece == 0 for r in own)
    taken = defaultdict(list)
    for r in rows:
        taken[r.sequence_id].append((r.offset, r.length))
    for parts in taken.values():
        assert [o for o, _ in sorted(parts)] == [0, *itertools.accumulate(n for _, n in sorted(parts))][:-1]
        assert sum(n for _, n in parts) <= 64
    total = sum(r.length for r in rows)
    assert len(taken) <= -(-total // 64) + 2
    assert packing.pack_documents(empty(spark), vocabulary_path()).count() == 0


def test_segment_tree_is_best_fit():
    rnd = random.Random(4)
    lengths = np.array([rnd.randint(1, 50) for _ in range(300)])
    sequence, offset = token_output.best_fit(lengths, 50)
    rooms: list[int] = []
    for k in np.argsort(-lengths, kind="stable"):
        fit = [r for r in rooms if r >= lengths[k]]
        room = min(fit) if fit else 50
        assert 50 - offset[k] == room
        if fit:
            rooms.remove(room)
        rooms.append(room - int(lengths[k]))


def test_matrices_give_documents_back(spark, library):
    docs = documents(spark)
    rows = token_output.packed_matrices(docs, vocabulary_path(), capacity=128, window=3000).collect()
    back = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == 128 and (ids[r.n_tokens :] == 0).all() and r.cu_seqlens[-1] == r.n_tokens
        assert r.position_resets == r.cu_seqlens[:-1]
        for k, (a, b) in enumerate(itertools.pairwise(r.cu_seqlens)):
            back[r.doc_ids[k], r.pieces[k]].append((r.starts[k], ids[a:b].tolist()))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for key, text in texts.items():
        whole = [x for p in sorted(p for d, p in back if d == key) for x in back[key, p][0][1]]
        assert whole == [*library.encode(text, add_special_tokens=False).ids, 0]
    assert len(back[5, 0]) == 2 and len({r.sequence_id for r in rows}) == len(rows)
    assert token_output.packed_matrices(empty(spark), vocabulary_path()).count() == 0
