"""Ranked search, decontamination and whitening against brute force on hostile rows."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest

from tidemark.llm import decontaminate, ranking, whitening
from tidemark.llm.vocabulary import Vocabulary

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
PASSAGE = "what is the tallest tower that was ever built by seven patient masons of the old river town"
LONG = " ".join(f"word{i % 997} item{i}" for i in range(30_000))
DOCS = [
    (1, PASSAGE), (2, "Ask: " + PASSAGE.upper().replace(" ", " -- ") + "!"), (3, None), (4, ""), (5, " ...\x00\x7f "), (6, LONG + " " + PASSAGE), (7, PASSAGE + " " + PASSAGE),
    (8, "é" * 50 + " naïve ÉCOLE 北京 " + PASSAGE[:60]), (9, "tower tower tower"), (10, "tower"), (11, "tower"), (None, PASSAGE), (None, "tower"), (12, "short item"), (12, "short item"),
    (13, " " + PASSAGE[9:-3] + "퟿ x"), (14, "a" * 300_000 + " tower"), (15, "What is\tthe TALLEST tower that was ever built by"),
]
ITEMS = [(1, PASSAGE), (2, "short item"), (3, None), (4, ""), (10, "naïve école 北京"), (5, "what is the tallest tower that was ever built by"), (5, "masons tower"), (None, "tower tower"), (21, PASSAGE), (7, "absent words only here")]
ROWS = "doc_id long, text string, item long, doc string, n int, row long, block int"
ITEM_ROWS = "item_id long, text string, term string, doc_id string, block int"


def words(text):
    return TERM.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*d, 1, "d", 2, 3, 4) for d in DOCS], ROWS).repartition(3).cache()


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(*i, "t", "d", 0) for i in ITEMS], ITEM_ROWS).repartition(2).cache()


def brute_rank(docs, items, k):
    texts = [(i, words(t)) for i, t in docs]
    n_docs, total = sum(bool(w) for _, w in texts), sum(len(w) for _, w in texts)
    df = collections.Counter(t for _, w in texts for t in set(w))
    wanted = collections.defaultdict(set)
    for i, t in items:
        wanted[i] |= set(words(t))
    out = []
    for item, terms in wanted.items():
        scored = []
        for doc, w in texts:
            tf = collections.Counter(w)
            m = 100 - 50 + (50 * len(w) * n_docs) // total if w else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m)) for t in terms if tf[t])
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("k,block_terms", [(50, 200_000), (3, 200_000), (2, 5)])
def test_ranking(docs, items, k, block_terms):
    got = sorted([tuple(r) for r in ranking.rank(docs, items, k, block_terms=block_terms).collect()], key=str)
    assert got == brute_rank(DOCS, ITEMS, k)


def test_ranking_of_many_tiles_and_ties(spark, monkeypatch):
    for name, size in (("ITEMS", 3), ("COLUMNS", 4), ("DOCUMENTS", 5), ("TOGETHER", 16)):
        monkeypatch.setattr(ranking, name, size)
    draw = random.Random(5)
    some = [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(draw.choices(some, k=draw.choice([1, 2, 3, 9])))) for i in range(300)]
    items = [(i, " ".join(draw.sample(some, 6))) for i in range(11)]
    found = ranking.rank(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"), 7)
    assert sorted([tuple(r) for r in found.collect()], key=str) == brute_rank(docs, items, 7)


def test_partial_sums_stay_exact():
    block = ranking.Block.__new__(ranking.Block)
    block.ids, block.item, block.term = [0], np.zeros(5, np.int64), np.arange(5)
    for _, _, parts in ranking.tiles(block, np.full(5, (1 << 53) // (2 * ranking.SCALE))):
        assert [len(names) for names, _ in parts] == [2, 2, 1]


def test_ranking_of_nothing(docs, items):
    assert ranking.rank(docs.limit(0), items).count() == 0
    assert ranking.rank(docs, items.limit(0)).count() == 0
    assert ranking.rank(docs.where("doc_id IN (3, 4, 5)"), items).count() == 0


def test_vocabulary_checks_bytes():
    vocabulary = Vocabulary([b"abc", b"tower"])
    vocabulary.hashes = vocabulary.hashes.copy()
    data = np.frombuffer(b"ABC tower abd", np.uint8)
    assert vocabulary.find(data, np.array([0, 13]))[0].tolist() == [0, 1, -1]
    at = np.argsort(vocabulary.order)
    vocabulary.data = np.frombuffer(b"abd tower", np.uint8)  # as if abc had the hash of another word
    assert vocabulary.find(data, np.array([0, 13]))[0].tolist() == [-1, 1, -1] and len(at) == 2


def brute_windows(docs, items, window):
    patterns = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        for a in range(max(1, len(w) - window + 1) if w else 0):
            patterns[tuple(w[a : a + window])].add(i)
    sizes = {len(p) for p in patterns}
    out = []
    for doc, text in docs:
        plain = (text or "").translate(LOWER)
        spots = [m.span() for m in TERM.finditer(plain)]
        w = [plain[a:b] for a, b in spots]
        hit, own = set(), set()
        for size in sizes:
            for a in range(len(w) - size + 1):
                if found := patterns.get(tuple(w[a : a + size])):
                    hit |= set(range(a, a + size))
                    own |= found
        spans = []
        for i in sorted(hit):
            if i - 1 in hit:
                spans[-1] = (spans[-1][0], spots[i][1])
            else:
                spans.append(spots[i])
        out.append((doc, len(w), len(hit), len(own), sorted(i for i in own if i is not None), spans))
    return sorted(out, key=str)


@pytest.mark.parametrize("window,block_words", [(10, 500_000), (10, 6), (4, 500_000), (4, 20)])
def test_decontamination(docs, items, window, block_words):
    found = decontaminate.contamination(docs, items, window=window, block_words=block_words).collect()
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, list(r["items"]), [tuple(s) for s in r.spans]) for r in found]
    assert sorted(got, key=str) == brute_windows(DOCS, ITEMS, window)


def test_decontamination_of_nothing(docs, items):
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(docs, items.limit(0)).collect()} == {0}


def brute_whitening(rows, count=16):
    usable = [(i, v) for i, v in rows if v and all(e is not None and math.isfinite(e) for e in v)]
    x = [(i, tuple(math.floor(64 * e) + 1_000_000 for e in v)) for i, v in usable]
    fit = sorted({v for _, v in x})
    n, d = len(fit), len(fit[0])
    total = [sum(v[j] for v in fit) for j in range(d)]
    centred = np.array([[float(n * v[j] - total[j]) / n for j in range(d)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    keep = [j for j in range(d)[::-1] if values[j] > 1e-12 * values[-1]][:count]
    return x, n, total, values, vectors, keep


def check_whitening(spark, rows, tolerance=1e-9):
    found = whitening.whiten(spark.createDataFrame([(i, v, 1, "c") for i, v in rows], "vec_id long, embedding array<double>, id int, chunk string").repartition(3)).collect()
    x, n, total, values, vectors, keep = brute_whitening(rows)
    assert collections.Counter(r.vec_id for r in found) == collections.Counter({k: c * len(keep) for k, c in collections.Counter(i for i, _ in x).items()})
    by = collections.defaultdict(lambda: collections.defaultdict(list))
    for r in found:
        by[r.vec_id][r.component].append(r)
    for i, v in x:
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, total))
        for r in by[i][1]:
            assert r.n == n
        assert deviation in [r.deviation for r in by[i][1]] or deviation >= 1 << 63
    for c, j in enumerate(keep, 1):
        assert all(abs(r.explained - values[j] / values.sum()) < 1e-9 for i in by for r in by[i][c])
    assert max(r.identity_error for r in found) < 1e-9
    gaps = np.diff([values[j] for j in keep])
    if len(gaps) == 0 or np.abs(gaps).min() > 1e-6 * values[-1]:  # distinct: compare every projection but for its sign
        for c, j in enumerate(keep, 1):
            want = {}
            for i, v in x:
                want.setdefault(i, []).append(float(np.array([(n * a - s) / n for a, s in zip(v, total)]) @ vectors[:, j] / math.sqrt(values[j])))
            sign = next((math.copysign(1, by[i][c][0].whitened * want[i][0]) for i in want if len(want[i]) == 1 and abs(want[i][0]) > 0.1), 1)
            for i, w in want.items():
                assert np.allclose(sorted(sign * r.whitened for r in by[i][c]), sorted(w), atol=tolerance)


def test_whitening_of_hostile_rows(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(e) for e in draw.normal(size=6) * [9, 5, 3, 2, 1, 0.5]]) for i in range(60)]
    rows += [(70 + i, rows[0][1]) for i in range(40)] + [(None, rows[1][1]), (None, rows[1][1]), (5, rows[5][1])]
    rows += [(200, None), (201, [None] * 6), (202, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0]), (203, [float("inf")] * 6), (204, [1.0, 2.0, 3.0, None, 5.0, 6.0])]
    check_whitening(spark, rows)
    ragged = rows + [(300, [1.0, 2.0]), (301, [])]
    found = whitening.whiten(spark.createDataFrame(ragged, "vec_id long, embedding array<double>"))
    assert found.where("vec_id >= 300").count() == 0


def test_whitening_of_lower_rank_and_repeated_eigenvalues(spark):
    draw = np.random.default_rng(4)
    flat = draw.normal(size=(50, 2)) * 10
    check_whitening(spark, [(i, [float(a), float(b), 7.0, 0.0, float(-a)]) for i, (a, b) in enumerate(np.round(flat))], 1e-7)
    cube = [[a, b, c] for a in (-1.0, 1.0) for b in (-1.0, 1.0) for c in (-1.0, 1.0)]
    check_whitening(spark, list(enumerate(cube)))


def test_whitening_of_large_entries(spark):
    draw = np.random.default_rng(5)
    check_whitening(spark, [(i, [float(e) * 1e12 for e in draw.normal(size=3) * [1, 2, 4]]) for i in range(30)])


def test_whitening_of_nothing(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).count() == 0


def test_digest_of_no_items(spark, sf):
    from tidemark.llm import QUERIES

    rows = QUERIES["op12_decontamination"](spark, sf).where("NOT contaminated").select("items_sha256").distinct().collect()
    assert [r.items_sha256 for r in rows] == [hashlib.sha256(b"").hexdigest()]
