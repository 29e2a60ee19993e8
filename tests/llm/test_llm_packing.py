import collections
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import TEXTS, empty, odd
from tokenizers import Tokenizer

from milepost.llm import matrices, packing
from milepost.llm.encode import WordEncoder, default_tokenizer


def whole_ids(text):
    if not hasattr(whole_ids, "t"):
        whole_ids.t = Tokenizer.from_file(default_tokenizer())
    return whole_ids.t.encode(text or "", add_special_tokens=False).ids + [1]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aAbZ9é́ñßΣςσ  \n\t\x1c\x85\xa0\u2003.,!'s-_<|endoftext|>İK中文\u200b", max_size=60))
def test_word_memory_gives_the_ids_of_the_whole_text(text):
    if not hasattr(whole_ids, "e"):
        whole_ids.e = WordEncoder(default_tokenizer(), words=50)
    assert np.frombuffer(whole_ids.e(text), "<u4").tolist() == whole_ids(text)[:-1]


def test_long_words_and_full_memory():
    e = WordEncoder(default_tokenizer(), words=3)
    for text in ("a" * 5000 + " b", "one two three four five six one", "one"):
        assert np.frombuffer(e(text), "<u4").tolist() == whole_ids(text)[:-1]


def by_single_documents(lengths, capacity):
    """Best-fit decreasing, one document at a time."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 60).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=120))))
def test_plan_over_counts_is_best_fit_decreasing(case):
    capacity, lengths = case
    held = collections.defaultdict(list)
    ranks = collections.defaultdict(list)
    for r in packing.plan_runs(collections.Counter(lengths), capacity):
        ranks[r.length] += range(r.first_rank, r.first_rank + r.documents)
        for i in range(r.documents):
            held[r.first_sequence + i // r.per_sequence].append((r.offset + i % r.per_sequence * r.length, r.length))
    assert {n: len(v) for n, v in ranks.items()} == collections.Counter(lengths)
    assert all(sorted(v) == list(range(len(v))) for v in ranks.values())
    for places in held.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
    assert sorted(capacity - sum(n for _, n in v) for v in held.values()) == by_single_documents(lengths, capacity)
    rows = matrices.fit(lengths, capacity)
    assert sorted(capacity - sum(lengths[i] for i in r) for r in rows) == by_single_documents(lengths, capacity)


def test_plan_stays_small_for_many_documents():
    runs = packing.plan_runs({n: 10**9 + n for n in range(1, 4097)}, 4096)
    assert len(runs) < 50_000 and sum(r.documents for r in runs) == sum(10**9 + n for n in range(1, 4097))
    with pytest.raises(ValueError):
        packing.plan_runs({11: 1}, 10)


@pytest.mark.parametrize("capacity", [7, 4096])
def test_pack_keeps_every_id_once(spark, capacity):
    out = packing.pack(odd(spark).repartition(3), capacity).collect()
    wanted = []
    for doc, text, *_ in TEXTS:
        ids = np.array(whole_ids(text), "<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            wanted.append((doc, piece, start, len(part), zlib.crc32(part.tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out]
    assert sorted(map(str, got)) == sorted(map(str, wanted))
    sequences = collections.defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(sequences) == len(by_single_documents([w[3] for w in wanted], capacity))


def test_pack_of_nothing(spark):
    assert packing.pack(empty(spark)).collect() == []
    assert matrices.pack_matrices(empty(spark)).collect() == []


@pytest.mark.parametrize("window", [1, 500, 10**6])
def test_matrices_round_trip(spark, window):
    capacity = 64
    packed = matrices.pack_matrices(odd(spark), capacity, window_tokens=window)
    for r in packed.collect():
        assert len(r.ids) == 4 * capacity and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= capacity
        assert r.position_resets == r.cu_seqlens[:-1] and len(r.doc_ids) == len(r.pieces) == len(r.starts) == len(r.position_resets)
        assert not any(r.ids[4 * r.n_tokens :])
    found = collections.defaultdict(list)
    for r in matrices.unpack(packed).collect():
        found[str(r.doc_id)].append((r.piece, r.start, r.ids))
    wanted = collections.defaultdict(list)
    for doc, text, *_ in TEXTS:
        ids = whole_ids(text)
        wanted[str(doc)] += [(k, a, ids[a : a + capacity]) for k, a in enumerate(range(0, len(ids), capacity))]
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in wanted.items()}


def test_segment_tree_finds_the_least_room():
    tree, rooms = matrices.CapacityTree(100), []
    rng = np.random.default_rng(3)
    for _ in range(400):
        need = int(rng.integers(1, 101))
        assert tree.least_room(need) == min((r for r in rooms if r >= need), default=-1)
        if rooms and rng.random() < 0.4:
            tree.add(rooms.pop(), -1)
        else:
            rooms.append(int(rng.integers(1, 101)))
            tree.add(rooms[-1], 1)
