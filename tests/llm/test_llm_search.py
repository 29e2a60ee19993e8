"""Hard negatives, ranked search, SentencePiece: against plain versions, and on odd rows."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import LONG, TEXTS, empty, odd
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from milepost.llm import negatives, pieces, queries, ranked
from milepost.llm.best import Best

# Best few


@settings(max_examples=100, deadline=None)
@given(
    st.integers(1, 4), st.integers(1, 5),
    st.lists(st.lists(st.tuples(st.integers(-3, 3), st.integers(0, 9), st.booleans()), min_size=1, max_size=12), max_size=6),
)
def test_best_keeps_the_first_of_all_that_was_offered(slots, k, tiles):
    heaps, other, seen = Best(slots, k), Best(slots, k), collections.defaultdict(list)
    for n, tile in enumerate(tiles):
        scores, ids, allowed = (np.array(c) for c in zip(*tile))
        every = np.arange(slots)
        table = scores + every[:, None] % 2
        (heaps if n % 2 else other).offer(every, table, ids, np.broadcast_to(allowed, table.shape))
        for slot in range(slots):
            seen[slot] += [(-int(s), int(i)) for s, i, a in zip(table[slot], ids, allowed) if a]
    heaps.add(*other.rows())
    got = collections.defaultdict(list)
    for slot, score, i in zip(*heaps.rows()):
        got[int(slot)].append((-int(score), int(i)))
    assert got == {slot: sorted(rows)[:k] for slot, rows in seen.items() if rows}


# Hard negatives


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(0, 40), st.integers(1, 40), st.integers(1, 5), st.integers(0, 10**6))
def test_strassen_equals_plain_products(n, k, m, leaf, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-(2**28), 2**28, (n, k)), rng.integers(-(2**28), 2**28, (k, m))
    assert (negatives.strassen(a, b, leaf) == a @ b).all()


def plain_negatives(rows, is_anchor, positives=5, negatives=10):
    """Every anchor with every row, in Python's integers."""
    good = [
        (i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows
        if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    last = lambda i: math.inf if i is None else i
    out = []
    for anchor in sorted({i for i, _, _ in good if is_anchor(i)}):
        label, vector = min((lab, v) for i, lab, v in good if i == anchor)
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), last(i), i, lab) for i, lab, v in good)
        for s, _, positive, _ in [r for r in scored if r[3] == label and r[2] != anchor][:positives]:
            inside = [r for r in scored if r[3] != label and -30 * s <= -100 * r[0] <= -90 * s]
            out += [(anchor, positive, k, r[2], -s, -r[0]) for k, r in enumerate(inside[:negatives], 1)]
    return sorted(out, key=str)


def vectors(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    return df.withColumns({c: F.lit("x") for c in ("id", "vector", "slot", "score", "rank", "finite", "first", "_part")})


def random_rows(seed, n, copies=0):
    rng = np.random.default_rng(seed)
    rows = [(i, int(rng.integers(0, 3)), [float(x) for x in np.float32(rng.normal(0.2, 0.4, 5))]) for i in range(n)]
    return rows + [(n + i, i % 2, rows[0][2]) for i in range(copies)]


@pytest.mark.parametrize("block", [3, 8192])
def test_negatives_equal_brute_force(spark, block, monkeypatch):
    rows = random_rows(7, 90, copies=60)
    monkeypatch.setattr(negatives, "ROWS", 16)
    got = negatives.mine(vectors(spark, rows).repartition(5), F.col("vec_id") % 10 == 0, block=block).collect()
    assert sorted(map(tuple, got), key=str) == plain_negatives(rows, lambda i: i % 10 == 0)


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = random_rows(3, 40) + [
        (100, None, [1.0]), (101, 1, None), (102, 1, [1.0, None]), (103, 2, [nan]), (104, 2, [1.0, inf]), (110, 1, []),
        (111, 1, [1.0]), (112, 2, [0.5] * 9), (None, 0, [0.3] * 5), (10, 1, [0.9] * 5), (5, 1, [0.2] * 5), (5, 1, [0.2] * 5),
    ]
    got = negatives.mine(vectors(spark, rows), F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got), key=str) == plain_negatives(rows, lambda i: i is not None and i % 10 == 0)
    assert any(r.negative_id is None or r.positive_id is None for r in got)


def test_negatives_of_nothing(spark):
    none = vectors(spark, random_rows(1, 4))
    assert negatives.mine(none.where("false"), F.col("vec_id") == 0).collect() == []
    assert negatives.mine(none, F.col("vec_id") == 77).collect() == []
    # a score of zero leaves only zeros in the window, a negative one leaves nothing
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [0.0, 1.0]), (2, 1, [-1.0, 0.0]), (3, 2, [0.0, 2.0]), (4, 2, [1.0, 0.0])]
    got = negatives.mine(vectors(spark, rows), F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 3, 0, 0)]
    huge = [(0, 1, [3e38]), (1, 1, [3e38]), (2, 2, [-3e38])]
    assert negatives.mine(vectors(spark, huge), F.col("vec_id") == 0).count() >= 0


# Ranked search

_TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return _TERMS.findall((text or "").translate(_LOWER))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZ09 @[`{/:\x00\x7f\x1c\x85ÄäİK中😀_\n\t", max_size=30))
def test_terms_are_the_maximal_matches(text):
    assert [t.decode() for t in ranked.terms(text)] == plain_terms(text)


def plain_ranking(docs, items, k):
    held = [(d, collections.Counter(plain_terms(t))) for d, t in docs]
    n = sum(1 for _, c in held if c)
    total = sum(c.total() for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        rows = []
        for d, c in held:
            if not c:
                continue
            m = 100 - 50 + 50 * c.total() * n // total
            asked = set(plain_terms(text)) & set(c)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in asked)
            if score > 0:
                rows.append((-score, math.inf if d is None else d, d))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(rows)[:k], 1)]
    return sorted(out, key=str)


ITEMS = [
    (1, "the quick Fox, the FOX"), (2, "tie"), (3, None), (4, ""), (5, "!!!"), (6, "no such words anywhere"), (None, "same line"),
    (7, "wort5 line5 Ünïcødé 中文"), (8, LONG),
]


@pytest.mark.parametrize("tile, items, k", [(4096, 1024, 50), (7, 2, 3)])
def test_ranking_equals_brute_force(spark, monkeypatch, tile, items, k):
    docs = odd(spark).repartition(3)
    monkeypatch.setattr(ranked, "DOCUMENTS", 4 if tile < 100 else ranked.DOCUMENTS)
    asked = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumns({c: F.lit("x") for c in ("slot", "id", "rank", "score")})
    got = ranked.rank(docs, asked, k, block_items=items).collect()
    assert sorted(map(tuple, got), key=str) == plain_ranking([(d, t) for d, t, *_ in TEXTS], ITEMS, k)


def test_ranking_of_nothing(spark):
    asked = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert ranked.rank(empty(spark), asked).collect() == []
    assert ranked.rank(odd(spark), asked.where("false")).collect() == []
    assert ranked.rank(odd(spark), spark.createDataFrame([(1, None)], "item_id bigint, text string")).collect() == []


def test_repeated_items_take_their_smallest_text(spark):
    asked = spark.createDataFrame([(1, "tie"), (1, "quick"), (1, "tie")], "item_id bigint, text string")
    got = ranked.rank(odd(spark), asked).collect()
    assert sorted(map(tuple, got), key=str) == plain_ranking([(d, t) for d, t, *_ in TEXTS], [(1, "quick")], 50)


def test_tiles_stay_exact():
    heavy = np.array([25_000], "int64")
    assert ranked.tile_width(heavy, 10**9) * 25_000 * 1_000_000 < 2**53
    assert ranked.tile_width(np.array([], "int64")) == ranked.TERMS
    large = ranked.lengths(np.array([10**9, 3]), 10**10, 10**13)
    assert large.tolist() == [50 + 50 * 10**9 * 10**10 // 10**13, 50 + 50 * 3 * 10**10 // 10**13]
    tf = np.arange(1, 10**6, 997)
    assert (ranked.impacts(heavy, tf, np.full(len(tf), 50)) < 25_000 * 1_000_000).all()


# SentencePiece


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=pieces.default_model())


@pytest.fixture(scope="module")
def encoder():
    return pieces.PieceEncoder(pieces.default_model(), parts=40, pairs=60)


def ids(blob):
    return np.frombuffer(blob, "int32").tolist()


@settings(max_examples=400, deadline=None)
@given(st.one_of(
    st.text(max_size=40),
    st.text(alphabet="abehinorst ▁.,'\n\t²é-_/(=<0x1>sß中İ😀\x00\x1c", max_size=60),
    st.lists(st.sampled_from(["the", "    ", " of", "ing", "'s", "²", ".", "//", "====", "é", "<s>", "</s>", "<unk>", "<0x0A>", "▁▁", "привет"]), max_size=14).map("".join),
))
def test_ids_are_those_of_the_library(encoder, library, text):
    got = ids(encoder(text))
    assert got == library.encode(text)
    assert library.decode(got) == library.decode(library.encode(text))


def test_ids_of_long_texts(encoder, library):
    for text in (LONG, "a" * 3000, " " * 500 + "x", "ab" * 700 + "\n" * 300, "=" * 999, "中" * 300, "e" * 120 + " e"):
        assert ids(encoder(text)) == library.encode(text)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aehinorst▁", min_size=1, max_size=14))
def test_cut_is_the_plain_merging(encoder, text):
    assert encoder.cut(text) == encoder.merged(text)


def test_places_fail_where_the_longest_piece_is_wrong(encoder, library):
    """Greedy longest matching differs from merging, so pieces must be taken back."""
    words = {w for _, t, *_ in TEXTS if t for w in t.split()} | {"erenthend", "ationshe", "thereason", "inthenot"}
    greedy = 0
    for word in words:
        cut, at = encoder.cut("▁" + word), 0
        text, longest = "▁" + word, []
        while at < len(text):
            size = max((n for n in range(1, 17) if text[at : at + n] in encoder._id), default=1)
            longest.append(text[at : at + size])
            at += size
        greedy += cut != longest
        assert ids(encoder(word)) == library.encode(word)
    assert greedy > 0


def test_coarser_parts_give_the_same_ids(library):
    other = pieces.PieceEncoder(pieces.default_model())
    other._parts = lambda text: [text]
    for _, text, *_ in TEXTS:
        if text and len(text) < 1000:
            assert ids(other(text)) == library.encode(text)


def test_documents_round_trip(spark, library):
    encoded = pieces.encode(odd(spark), decoded=True)
    want = sorted(((d, library.encode(t or ""), library.decode(library.encode(t or ""))) for d, t, *_ in TEXTS), key=str)
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in encoded.collect()), key=str) == want
    back = pieces.decode(encoded).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((d, t) for d, _, t in want), key=str)
    assert pieces.encode(empty(spark)).collect() == []
    nothing = spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>")
    assert pieces.decode(nothing).collect()[0].text is None


def test_query_digests(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op13(spark, sf).collect()
    assert len(rows) == len(texts)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        want = library.encode(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(want), digest(",".join(map(str, want))))
        assert r.decoded_sha256 == digest(library.decode(want))
