import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from llm_cases import CLASH, LONG, TEXTS, empty, odd
from xxhash import xxh64

import corpus_pipeline
from milepost.llm import components, decontaminate, lines, packing, quality, simhash

SF = "/root/testdata/sf0.001"


# components and SimHash


def roots(pairs):
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {x: top(x) for x in list(parent)}


def test_components_of_chains_stars_and_repeats(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5)]
    pairs += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(150)]
    rng.shuffle(pairs)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs + pairs[:20], "a bigint, b bigint")).collect()}
    assert got == {k: v for k, v in roots([p for p in pairs if p[0] != p[1]]).items()}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@pytest.mark.parametrize("distance", [1, 3, 4, 7])
def test_links_equal_all_pairs(spark, distance):
    rng = np.random.default_rng(distance)
    made = {0, 2**64 - 1}
    for base in rng.integers(0, 2**64, 40, dtype=np.uint64).tolist():
        for _ in range(12):
            made.add(base)
            for bit in rng.choice(64, int(rng.integers(0, distance + 3)), replace=False):
                base ^= 1 << int(bit)
    prints = sorted(int(np.uint64(x).view(np.int64)) for x in made)
    wanted = {(a, b) for k, a in enumerate(prints) for b in prints[k + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= distance}
    rows = simhash.links(spark.createDataFrame([(p,) for p in prints], "fingerprint bigint"), distance).collect()
    assert len(rows) == len(wanted) and {tuple(sorted(r)) for r in rows} == wanted


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def named(pairs):
    """(id, fingerprint, component id) by comparing everything with everything."""
    prints = {f for _, f in pairs}
    top = roots([(a, b) for a in prints for b in prints if (a ^ b).bit_count() <= 4])
    ids = defaultdict(list)
    for d, f in pairs:
        if d is not None:
            ids[top[f]].append(d)
    return sorted(str((d, f"{f:016x}", min(ids[top[f]], default=None))) for d, f in pairs)


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 7)
    rows = [(d, t[:4000]) for d, t in duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()]
    rows += [(d, t) for d, t, *_ in TEXTS if t is not LONG] + [(300, "one two"), (301, "ONE\ntwo"), (None, "lonely words without an id here")]
    got = simhash.near_duplicates(odd(spark, [(d, t, "en", "s") for d, t in rows])).collect()
    assert sorted(str(tuple(r)) for r in got) == named([(d, plain_fingerprint(t)) for d, t in rows])
    assert simhash.near_duplicates(empty(spark)).collect() == []
    assert simhash.one_of_each(empty(spark)).collect() == []


def test_one_of_each_keeps_the_smallest_id(spark):
    docs = odd(spark, [*TEXTS, (9, LONG + " changed", "en", "s9"), (5, LONG, "en", "s3")])
    left = simhash.one_of_each(docs)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter([1, 2, None, 5, 6, 8])


def test_one_of_each_among_rows_of_one_id_and_text(spark):
    """Whatever the order and the partitions, the same of them is kept."""
    rows = [(1, "one text of some words", lang, f"s{k}") for k, lang in enumerate(["en", "de", None, "fr", "es"])]
    kept = {tuple(simhash.one_of_each(odd(spark, rows[k:] + rows[:k]).repartition(1 + k % 3)).first()) for k in range(5)}
    assert len(kept) == 1


# lines


def test_lines_near_and_far_from_the_limit(spark):
    spread = {"nine sites": 9, "ten sites": 10, "eleven sites": 11, "sixty sites": 60}
    rows = [(1000 + k, f" own line {k} {line}\n{line} \t\n\nlast {k} {line}", "en", f"site{k % 100}") for k, line in
            enumerate(line for line, n in spread.items() for _ in range(n))]
    copied = "a whole document\nthat many sites copy\nword for word"
    rows += [(500 + k, copied, "en", f"site{k}") for k in range(40)]
    block = "subscribe to us\nfollow us\nabout us\nterms of use\nall rights reserved"  # its inner lines always have the same neighbours
    rows += [(700 + k, f"story {k}\n{block}\nend {k}", "en", f"site{k}") for k in range(12)]
    rows += [(6000, "ten sites", "en", None), (6000, "ten sites", "en", None), (None, "own\nsixty sites\nmore", "en", "s"), *TEXTS]
    out = lines.without_boilerplate(odd(spark, rows)).collect()
    assert len(out) == len(rows)
    text_of = defaultdict(list)
    for r in out:
        text_of[r.row.doc_id].append(r.text)
        assert r.row.h == "xh" and r.n_lines == (0 if r.row.text is None else r.row.text.count("\n") + 1)
        assert r.n_removed == (0 if r.text is None or r.text == r.row.text else r.n_lines - (r.text.count("\n") + 1 if r.text else 0))
    for k, (_, text, *_) in enumerate(rows[:90]):
        line = text.split("\n")[1].strip()
        first = k == [t.split("\n")[1].strip() for _, t, *_ in rows[:90]].index(line)
        gone = spread[line] >= 10 and not first
        assert text_of[1000 + k] == [text.replace(f"\n{line} \t", "") if gone else text]
    assert all(text_of[500 + k] == [copied] for k in range(40))
    assert text_of[700] == [f"story 0\n{block}\nend 0"] and all(text_of[700 + k] == [f"story {k}\nend {k}"] for k in range(1, 12))
    assert text_of[6000] == ["", ""] and "own\nmore" in text_of[None]
    assert lines.without_boilerplate(empty(spark)).collect() == []


def test_line_dedup_runs_no_python(plan, spark):
    text = plan(lines.without_boilerplate(odd(spark)))
    assert "Python" not in text and "Arrow" not in text.replace("ArrowEval", "Arrow") and "Cartesian" not in text


# quality


def plain_counts(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside)


def test_counts_equal_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    rows += [(d, t) for d, t, *_ in TEXTS] + [(400, "a a a a a b a a a"), (401, "x\n x\nx\n\n\n \nx"), (402, "a\x1cb\x85c d　e")]
    for _, text in rows:
        assert quality.statistics(text)[:5] == plain_counts(text)
    ids = np.array([0, 1, 2, 0, 1, 2, 5])
    assert quality.repeated_words(ids, 2**30) == quality.repeated_words(ids, 6) == 6


def test_forest_isolates_outliers():
    rng = np.random.default_rng(1)
    usual, far = rng.normal(0, 1, (2000, 3)), rng.normal(0, 1, (20, 3)) + 9
    forest = quality.grow(np.concatenate([usual, far]))
    assert np.quantile(forest.scores(usual), 0.99) < forest.scores(far).min()
    same = quality.grow(np.zeros((5, 3)))
    assert np.isfinite(same.scores(np.zeros((4, 3)))).all()


def test_forest_scores_equal_a_walk_node_by_node():
    rng = np.random.default_rng(4)
    rows = np.concatenate([rng.normal(0, 1, (300, 4)), np.ones((40, 4)), rng.normal(5, 3, (30, 4))])
    forest = quality.grow(rows, trees=9, tree_rows=64)

    def usual(n):
        return 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else float(n == 2)

    assert forest.usual == pytest.approx(usual(64))
    want = []
    for row in rows:
        total = 0.0
        for tree in range(9):
            node = 0
            while forest.low[tree][node] != node:
                node = forest.low[tree][node] if row[forest.column[tree][node]] < forest.cut[tree][node] else forest.high[tree][node]
            total += forest.path[tree][node]
        want.append(2 ** (-total / 9 / forest.usual))
    assert forest.scores(rows) == pytest.approx(np.array(want))


def test_verdicts_and_threshold(spark):
    rng = random.Random(3)
    good = [(2000 + k, " ".join(f"wort{rng.randrange(900)}" for _ in range(60 + k)), "en", "s") for k in range(200)]
    bad = [(1000 + k, " ".join(f"%%%|XYZ!!$$$&{j}" for j in range(80 + k)), "en", "s") for k in range(10)]
    docs = odd(spark, good + bad + TEXTS)
    labels = spark.createDataFrame(
        [(d, 1, 0) for d, *_ in good[:120]] + [(d, 0, 0) for d, *_ in bad[:6]] + [(2000, None, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int"
    )
    rows = quality.verdicts(docs, labels).collect()
    assert len(rows) == len(good) + len(bad) + len(TEXTS)
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.kept and r.base_failed)
    kept = {r.doc_id for r in rows if r.kept}
    assert not kept & {d for d, *_ in bad} and len(kept & {d for d, *_ in good}) >= 195
    left = quality.keep(docs, labels)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == kept
    unlabelled = quality.verdicts(docs, labels.where("false")).collect()
    assert all(r.kept != r.base_failed for r in unlabelled)
    assert quality.verdicts(empty(spark), labels).collect() == [] and quality.keep(empty(spark), labels).collect() == []


# the pipeline


def plain_line_dedup(rows):
    held = defaultdict(lambda: (set(), set(), []))
    for d, text, source in rows:
        keys = {x.strip(lines.BLANK) for x in text.split("\n")} - {""}
        for key in keys:
            sites, wholes, ids = held[key]
            sites.add(source)
            wholes.add(frozenset(keys))
            ids.append(d)
    common = {k: min(ids) for k, (sites, wholes, ids) in held.items() if len(sites) >= lines.SITES and len(wholes) >= lines.SITES}
    out = []
    for d, text, source in rows:
        left = [x for x in text.split("\n") if common.get(x.strip(lines.BLANK), d) == d]
        if len(left) == text.count("\n") + 1 or "".join(left).strip():
            out.append((d, "\n".join(left), source))
    return out


@pytest.fixture(scope="module")
def passed(spark):
    """What each stage returns on sf0.01, in order, beginning with the documents."""
    sf = "/root/testdata/sf0.01"
    docs = [spark.read.parquet(f"{sf}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(corpus_pipeline.written(stage(spark, docs[-1], sf), name.replace(" ", "-")))
    return docs


def test_stages_equal_brute_force(passed):
    documents, kept, cut, single, clean, packed = ([tuple(r) for r in d.collect()] for d in passed)
    assert all(d.columns == passed[0].columns for d in passed[:5])
    good = {d for d, q in duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall() if q == 1}
    fine = {d for d, t, *_ in documents if (c := plain_counts(t))[0] >= 50 and 100 * c[4] <= 50 * c[0]}
    gone = fine - {d for d, *_ in kept}
    assert {d for d, *_ in kept} <= fine and len(gone & good) <= 0.02 * len(good & fine)
    assert sorted((r[0], r[1], r[3]) for r in cut) == sorted(plain_line_dedup([(r[0], r[1], r[3]) for r in kept]))
    assert all(r[4] == len(r[1]) for r in cut if r[1] != dict((k[0], k[1]) for k in kept)[r[0]])
    names = named([(r[0], plain_fingerprint(r[1])) for r in cut])
    assert sorted(r[0] for r in single) == sorted({int(n.rsplit(", ", 1)[1][:-1]) for n in names})
    assert set(single) <= set(cut) and set(clean) <= set(single)
    items = [decontaminate.normal(t) for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/benchmark.parquet'").fetchall()]
    whole = {r[0] for r in single if any(i in decontaminate.normal(r[1]) for i in items)}
    removed = {r[0] for r in single} - {r[0] for r in clean}
    assert whole <= removed and len(removed - whole) <= 0.01 * len(single)
    assert {r[0] for r in packed} == {r[0] for r in clean}
    room = defaultdict(int)
    for r in packed:
        room[r[5]] += r[3]
    assert max(room.values()) <= 4096
    need = packing.plan_runs(Counter(r[3] for r in packed), 4096)
    assert len(room) == len({r.first_sequence + i // r.per_sequence for r in need for i in range(r.documents)})


def test_stages_bear_odd_rows(spark, tmp_path):
    docs = odd(spark)
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for table in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, str(tmp_path))
            assert name == "best-fit packing" or out.columns == table.columns
            assert set(CLASH) <= set(out.columns) or name == "best-fit packing"
            out.count()
