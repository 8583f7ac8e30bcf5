"""Each operator against a brute-force version on hostile rows: nulls, empty and long texts, ties, repeats, clashing columns."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe, exact_dedup, graph, html_text, jaccard, langid, packing, pii, search, suffixes, toxicity
from tidemark.llm.text import pack_columns, unpack_columns

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BASE = "the quick brown fox jumps over the lazy dog while seven wizards brew a pot of strong black tea near the old mill"
LONG = " ".join(f"word{i % 997} item{i}" for i in range(20_000))
TEXTS = [
    (1, BASE), (2, BASE), (3, BASE.upper()), (4, BASE + " today"), (5, "Vorwort. " + BASE), (6, None), (7, ""), (8, " \n\t "),
    (9, "short one"), (10, "short one"), (11, "Short One"), (12, LONG), (13, "prefix " + LONG[:3000]), (14, "é" * 60 + "x"), (15, "é" * 60 + "y"),
    (16, "mail a.b@c.example.com or +1 (555) 010-2030, ip 10.0.0.256 and 10.1.2.3, card 4111 1111 1111 1111 and 4111111111111112"),
    (17, "<|endoftext|> don't 're  12 3 　 x\n\n y"), (18, "a" * 3000), (19, "1" * 3000), (20, "one\x1ctwo\u0085three"), (None, BASE),
]
COLUMNS = "doc_id long, text string, id string, part int, sig long, keys string, ids string, row long, root long, n int, digest string, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, 3, 1, "k", "i", 2, None, 9, None, None if n % 3 else "en") for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows + rows[:2], COLUMNS).repartition(3).cache()


@pytest.fixture(scope="module")
def whole(docs):
    """Rows without a null id."""
    return docs.where("doc_id IS NOT NULL")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def text_of(t):
    return t or ""


def test_bpe_round_trip(docs, empty):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.RANKS, "rb"))}
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = bpe.decode(bpe.encode(docs)).collect()
    got = sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in rows)
    want = sorted((str(i), plain.encode_ordinary(text_of(t)), text_of(t).encode()) for i, t in TEXTS + TEXTS[:2])
    assert got == want
    assert bpe.decode(bpe.encode(empty)).count() == 0


def test_bpe_spaces_beyond_the_library_and_unknown_ids(spark):
    own = bpe.codec(bpe.RANKS)
    old, bpe.LONG_SPACE = bpe.LONG_SPACE, 20
    try:
        for text in ("x" + " " * 90 + "y", " " * 50, "a " + "\n" * 45 + " b" + "\t" * 30 + "c", " " * 30 + "end"):
            assert own.encode_text(text) == own.encoding.encode_ordinary(text)
    finally:
        bpe.LONG_SPACE = old
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(spark.createDataFrame([(1, [10**6])], "doc_id long, ids array<int>")).collect()


def check_packing(rows, texts, capacity=packing.CAPACITY):
    encoder = Tokenizer.from_file(packing.TOKENIZER)
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, text in texts:
        ids, at = [*encoder.encode(text_of(text), add_special_tokens=False).ids, 1], 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert list(r.ids) == ids[at : at + r.length]
            at += r.length
        assert at == len(ids)
    padded = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        padded += capacity - at if at & (at - 1) else 0
    return padded


def test_packing(spark, empty):
    texts = [(i, t) for i, t in TEXTS if i is not None] + [(100 + i, BASE * (i % 7)) for i in range(300)]
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    padded = check_packing(rows, texts)
    assert padded < 0.01 * sum(r.length for r in rows)
    assert packing.pack(empty).count() == 0


def test_harmonic_classes_take_a_fixed_number():
    bins = packing.Bins(2048, 0)
    placed = [x for i in range(40) for x in bins.take((i, 0, 682, 682, None))]
    assert len(placed) == 39 and collections.Counter(s for _, s, _ in placed) == {s: 3 for s in range(13)}
    for rest, pieces in enumerate(packing.cuts(2048)):
        assert sum(pieces) == rest and all(p > 0 for p in pieces)


def test_exact_groups(docs, empty):
    groups = collections.defaultdict(list)
    for i, t in TEXTS + TEXTS[:2]:
        groups[text_of(t).translate(LOWER)].append(i)
    for heavy in (1024, 2):
        got = exact_dedup.exact_groups(docs, heavy=heavy).collect()
        for ids in groups.values():
            keep = max((i for i in ids if i is not None), default=None)
            own = [r for r in got if r.id in ids and (r.id is not None or len(ids) > 1) and r.keep_id == keep]
            assert len(own) == len(ids) and all(r.group_size == len(ids) for r in own) and sum(r.kept for r in own) == 1
    assert exact_dedup.exact_groups(empty).count() == 0


def test_drop_copies(docs, empty):
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    texts = [text_of(r.text).translate(LOWER) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({text_of(t).translate(LOWER) for _, t in TEXTS})
    assert exact_dedup.drop_copies(empty).count() == 0


def test_misra_gries_finds_every_frequent_digest(spark):
    rows = spark.range(5000).selectExpr("CAST(CAST(CASE WHEN id % 3 = 0 THEN 0 WHEN id % 10 = 1 THEN 1 ELSE id END AS STRING) AS BINARY) AS digest")
    found = {bytes(r.digest) for r in exact_dedup.misra_gries(rows.repartition(5), heavy=25).collect()}
    assert {b"0", b"1"} <= found and len(found) <= 25


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text_of(text).translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or (frozenset([tuple(words)]) if words else frozenset())


def brute_components(texts):
    up = {i: i for i, _ in texts}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    sets = [(i, shingles(t)) for i, t in texts]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in up}


def chain(n):
    """Texts that drift apart: neighbours are linked, far ones are not."""
    words = [f"w{i}" for i in range(200)]
    return [(1000 + i, " ".join(words[i * 4 : i * 4 + 60])) for i in range(n)] + [(2000 + i, " ".join(words[:50] + [f"x{i}"])) for i in range(12)]


@pytest.mark.parametrize("group", [jaccard.GROUP, 150])
def test_jaccard_components(spark, whole, empty, group, monkeypatch):
    texts = [(i, t) for i, t in TEXTS if i is not None] + chain(25)
    monkeypatch.setattr(jaccard.links, "__defaults__", (group,))
    rows = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = jaccard.near_groups(rows).collect()
    want = brute_components(texts)
    assert {r.id: r.component for r in got} == want
    assert {r.id: r.n_shingles for r in got} == {i: len(shingles(t)) for i, t in texts}
    kept = jaccard.drop_near(whole)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute_components([x for x in TEXTS if x[0]]).values()))
    assert kept.columns == whole.columns and jaccard.near_groups(empty).count() == 0


def test_drop_near_goes_by_rows(spark):
    """Rows of one id in different components stay apart; near copies without an id leave one."""
    other, third = " ".join(f"other{i}" for i in range(30)), " ".join(f"third{i}" for i in range(30))
    rows = [(1, BASE), (1, other), (0, BASE + " today"), (None, third), (None, third + " x"), (None, third), (7, LONG), (7, LONG), (7, ""), (7, "")]
    got = jaccard.drop_near(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    kept = sorted((str(r.doc_id), r.text) for r in got if r.doc_id is not None)
    assert kept == sorted([("1", other), ("0", BASE + " today"), ("7", LONG), ("7", ""), ("7", "")])
    assert len([r for r in got if r.doc_id is None]) == 1


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(100) if i != 50] + [(7, 7)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 if i <= 50 else 51 for i in range(101)}


@pytest.mark.parametrize("order", ["shuffled", "descending"])
def test_components_of_paths_of_thousands(spark, order):
    """The rounds must not grow with the length of a path, nor depend on where its least label is."""
    n = 4000
    names = list(range(n, 0, -1))
    if order == "shuffled":
        random.Random(7).shuffle(names)
    edges = list(zip(names, names[1:])) + [(n + 2, n + 1), (-5, -5)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, n + 1)}, n + 1: n + 1, n + 2: n + 1}
    assert graph.components(spark.createDataFrame([(3, 3)], "a long, b long")).count() == 0


def brute_spans(texts, width=50):
    seen, out = {}, {}
    for i, t in sorted(texts, key=lambda x: (x[0] is None, x[0] or 0)):
        raw, own = text_of(t).encode(), []
        key = math.inf if i is None else i
        for p in range(len(raw) - width + 1):
            if seen.setdefault(raw[p : p + width], key) < key:
                if own and p <= own[-1][1]:
                    own[-1][1] = p + width
                else:
                    own.append([p, p + width])
        out[i, t] = own
    return out


def test_repeated_spans(docs, empty, monkeypatch):
    want = brute_spans(TEXTS)
    for chunk, crowd in ((suffixes.CHUNK, suffixes.CROWD), (500, 2)):
        monkeypatch.setattr(suffixes, "CHUNK", chunk)
        monkeypatch.setattr(suffixes, "CROWD", crowd)
        rows = suffixes.repeated_spans(docs).collect()
        assert len(rows) == len(TEXTS) + 2
        texts = dict(TEXTS)
        for r in rows:
            spans, raw = want[r.id, texts[r.id]], text_of(texts[r.id]).encode()
            assert [[s.start, s.end] for s in r.spans] == spans and r.n_bytes == len(raw)
            assert bytes(r.kept) == b"".join(raw[a:b] for a, b in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(raw)]))
    assert suffixes.repeated_spans(empty).count() == 0


def plain_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        total = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return out


HARD = [
    "a@b.c@d.e x@y @z.com q.w@e-r.t.y, a@@b.cc", "1.2.3.4.5.6.7.8 001.002.003.004 1.2.3.400 9.9.9.9.", "+1 2 3 4 5 6 7 8 9 +12345678 +1+22222222",
    "4111-1111-1111-1111 4111 1111 1111 1111 0000000000000000 12345", "é4111111111111111é +49 (30) 1234-5678", "....@a.b", "x@" + "a." * 50 + "b",
]


@pytest.mark.parametrize("text", HARD + [t for _, t in TEXTS if t])
def test_base_spans(text):
    got = [(k, a, b) for k, spans in pii.base_spans(text).items() for a, b in spans]
    assert got == plain_spans(text)


def test_pii_annotate_and_mask(spark, docs, empty):
    weights = pii.fit(docs)
    rows = pii.annotate(docs, weights).collect()
    texts = dict(TEXTS)
    for r in rows:
        assert [(s.kind, s.start, s.end) for s in r.spans if s.base] == plain_spans(text_of(texts[r.doc_id]))
    masked = pii.mask(docs, weights)
    assert masked.columns == docs.columns
    for r in masked.collect():
        before = text_of(texts[r.doc_id])
        assert not plain_spans(text_of(r.text)) and (r.text is None) == (texts[r.doc_id] is None)
        assert plain_spans(before) or text_of(r.text) == before
    assert pii.mask(empty, pii.fit(empty)).count() == 0


def planted():
    """(text, span, kind, whether it is personal data) of candidates beyond the base rules."""
    draw = random.Random(6)

    def checked(digits):
        return next(digits + str(c) for c in range(10) if pii.luhn(digits + str(c)))

    def run(n):
        return "".join(str(draw.randrange(10)) for _ in range(n))

    out = []
    for i in range(30):
        words = draw.choice(["apple", "river", "stone"]), draw.choice(["two", "of", "last", "next"])
        mails = (f"anna{i} (at) gmail (dot) com", f"ben.{i}[at]mail.example.org", f"kim_{i} (at) firm{i}.net")
        out += [(f"please write to {mails[i % 3]} today", mails[i % 3], "email", True)]
        fake = f"section (at) page.{words[1]}", f"figure (at) {words[0]}.{words[1]}", f"look (at) this.{words[0]}"
        out += [(f"see {fake[i % 3]} of the text", fake[i % 3], "email", False)]
        area, exchange = draw.randrange(200, 990), draw.randrange(200, 990)
        phone = (f"{area}-{exchange}-{run(4)}", f"({area}) {exchange}-{run(4)}", f"{area}.{exchange}.{run(4)}")[i % 3]
        out += [(f"call me at {phone} after noon", phone, "phone", True)]
        serial = f"{draw.randrange(100):03d}-{draw.randrange(100):03d}-{run(4)}"
        out += [(f"the serial {serial} was printed", serial, "phone", False)]
        address = f"2001:db8:{i:x}a:0:8a2e:{draw.randrange(256):x}:7334:{draw.randrange(1, 65535):x}"
        out += [(f"the server address {address} answered", address, "ip", True)]
        clock = ":".join(f"{draw.randrange(60):02d}" for _ in range(8))
        out += [(f"order {clock} of laps", clock, "ip", False)]
        card = checked("37" + run(12))
        out += [(f"paid by amex card {card} in May", card, "card", True)]
        isbn = checked("9" + run(13))
        out += [(f"invoice {isbn} was sent", isbn, "card", False)]
    return out


def test_pii_separates_added_spans(spark):
    """The classifier, fitted on a table of base spans and planted candidates, adds the true ones only."""
    base = [f"write to anna{i}@mail.example.com or call +1 ({200 + i}) 555-0{100 + i}, host 10.0.{i}.7, card {c}" for i in range(60) for c in ["4111 1111 1111 1111"]]
    cases = planted()
    assert len(cases) >= 200
    rows = [*enumerate(base), *((1000 + i, text) for i, (text, *_) in enumerate(cases))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if not s.base] for r in pii.annotate(docs, pii.fit(docs)).collect()}
    added = 0
    for i, (text, span, kind, true) in enumerate(cases):
        at = text.index(span)
        assert found[1000 + i] == ([(kind, at, at + len(span))] if true else []), text
        added += len(found[1000 + i])
    assert added == sum(c[3] for c in cases) and not any(found[i] for i in range(len(base)))


def test_pii_known_cases(spark):
    """Candidates of other words than the fitted ones."""
    docs = spark.createDataFrame([(i, t) for i, (t, *_) in enumerate(planted())] + [(i + 9000, f"contact bob{i}@mail.test") for i in range(90)], "doc_id long, text string")
    weights = pii.fit(docs)
    cases = {
        "mail john (at) gmail (dot) com please": 1, "call me at 555-123-4567": 1, "order 55-123 call 155-223-4567": 0,
        "see section (at) page.two of the text": 0, "login from 2a00:1450:4001:81b:0:0:0:200e worked": 1, "laps 10:11:12:13:14:15:16:17": 0,
    }
    for text, want in cases.items():
        assert len([s for s in pii.accepted(text, weights) if not s[3]]) == want, text


def test_pii_votes_against_count_where_no_false_span_was_met(spark):
    docs = spark.createDataFrame([(i, f"write to anna{i}@mail.example.com or call +1 (555) 010-2{i:03d}") for i in range(300)], "doc_id long, text string")
    weights = pii.fit(docs)
    for text, want in {"see section (at) page.two of the text": 0, "mail john (at) gmail (dot) com": 1, "the serial 055-123-4567 was": 0, "call me at 555-123-4567": 1}.items():
        assert len(pii.accepted(text, weights)) == want, text


def test_labelers_are_no_worse_than_chance():
    cast = np.array([[0, 1, 1, -1, 1], [0, -1, -1, 1, -1], [1, 1, 1, -1, 1]])
    posterior, rates, _ = pii.reliabilities(cast, np.array([50.0, 50.0, 50.0]))
    assert (rates[1] >= rates[0]).all() and posterior[0] > 0.9 and posterior[1] < 0.1 and posterior[2] > 0.9


def test_language(spark, sf, docs, empty):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(table.where(~langid.held_out()))
    langs = {r.doc_id: r.lang for r in table.collect()}
    rows = langid.classify(table, model).withColumn("held_out", langid.held_out()).collect()
    test = [r for r in rows if r.held_out and langs[r.doc_id]]
    assert sum(r.lang_pred == langs[r.doc_id] for r in test) >= 0.9 * len(test) and all(0 <= r.score <= 1 for r in rows)
    odd = {r.doc_id: r for r in langid.classify(docs, model).collect()}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 for i in (6, 7, 8, 19)) and odd[9].lang_pred != "und"
    none = langid.fit(empty)
    assert none is None and {r.lang_pred for r in langid.classify(docs, none).collect()} == {"und"}


def test_toxicity(spark, docs, empty):
    def text(i, toxic):
        words = [f"w{zlib.crc32(f'{i} {k}'.encode()) % 400}" for k in range(60)]
        for k in range(0, 60, 12):
            if toxic:
                words[k] = f"bad{(i + k) % 5}"
        return " ".join(words)

    rows = [(i, text(i, i % 4 == 0), i % 4 == 0) for i in range(1500)]
    table = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    fitted = toxicity.fit(table, labels)
    held = [r for r in toxicity.score(table, fitted).withColumn("held", toxicity.folds() == 0).collect() if r.held]
    assert sum((r.score >= 0.5) == (r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    odd = toxicity.score(docs.drop("score"), fitted).collect()
    assert len(odd) == len(TEXTS) + 2 and all(0 <= r.score <= 1 for r in odd)
    blank = {r.score for r in odd if r.doc_id in (6, 7, 8)}
    assert len(blank) == 1 and toxicity.score(empty, fitted).count() == 0
    unlearned = toxicity.fit(table, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, unlearned).collect()} == {0.0}


def test_most_texts_have_evidence(spark, sf):
    table = spark.read.parquet(sf.replace("sf0.001", "sf0.01") + "/documents.parquet").where("length(text) > 0")
    labels = spark.read.parquet(sf.replace("sf0.001", "sf0.01") + "/labels.parquet")
    entries, shared, _ = toxicity.fit(table, labels)
    found = toxicity.with_evidence(table.select("doc_id", "text"), "text", entries, shared)
    assert found.where(f"{toxicity._X} <> 0").count() > table.count() // 2


def test_many_weak_bigrams_reveal_a_toxic_text(spark):
    """Toxic texts hold common words in unusual pairs; no pair is frequent, none is decisive, and words alone say nothing."""
    draw = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    odd = {(draw.randrange(40), draw.randrange(40)) for _ in range(500)}

    def text(toxic):
        out = [draw.randrange(40)]
        while len(out) < 60:
            k = draw.randrange(40)
            if ((out[-1], k) in odd) == toxic or draw.random() < 0.4:
                out.append(k)
        return " ".join(words[k] for k in out)

    rows = [(i, text(i % 2 == 0), int(i % 2 == 0)) for i in range(1200)]
    table = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    fitted = toxicity.fit(table, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    held = [r for r in toxicity.score(table, fitted).withColumn("held", toxicity.folds() == 0).collect() if r.held]
    assert sum((r.score >= 0.5) == (r.doc_id % 2 == 0) for r in held) >= 0.9 * len(held)
    assert max(abs(v) for v in fitted[1].value.values) < 1.5


def test_toxicity_uses_every_bigram(spark, monkeypatch):
    """Scores equal those of models that keep all counted bigrams, with the table broadcast and joined."""
    draw = random.Random(5)
    rows = []
    for i in range(3000):
        words = [f"w{draw.randrange(40_000)}" for _ in range(60)] + [f"c{draw.randrange(30)}" for _ in range(30)]
        if i % 3 == 0:
            for k in range(3):
                e = draw.randrange(60)
                words[20 * k : 20 * k + 2] = [f"vile{e % 8}", f"x{e}"]
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    def pairs(t):
        return set(zip(["", *t.split()], t.split()))

    n, word, front, after, before = collections.Counter(), collections.Counter(), collections.Counter(), collections.Counter(), collections.Counter()
    for i, t, y in rows:
        if zlib.crc32(str(i).encode()) % 5 in (1, 2, 3):
            for v, w in pairs(t):
                after[v] += not n[v, w, 0] + n[v, w, 1]
                before[w] += not n[v, w, 0] + n[v, w, 1]
                n[v, w, y] += 1
                word[w, y] += 1
                front[v, y] += 1
    own = [sum(k for (_, c), k in word.items() if c == y) for y in (0, 1)]
    total, spread, kinds = sum(own), sum(before.values()), len(before)

    def ratio(t, b, share, shared):
        e = b * share
        z = (t - e) ** 2 / (e + 1)
        d = (t - e) * (z / (z + toxicity.DOUBT)) ** 2
        value = math.log((e + d + shared) / (e + shared)) - math.log((b - e - d + shared) / (b - e + shared))
        return math.copysign(max(abs(value) - toxicity.LEAST, 0), value)

    def log(v, w):
        m, b, k = front[v, 0] + front[v, 1], n[v, w, 0] + n[v, w, 1], word[w, 0] + word[w, 1]
        alone = ratio(word[w, 1], k, own[1] / total, k) if k else 0.0
        return alone + (ratio(n[v, w, 1], b, front[v, 1] / m, b - 0.75 + 0.75 * after[v] * (before[w] + 1) / (spread + kinds)) if b else 0.0)

    table = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    repeated = table.where("doc_id < 200").unionByName(table.where("doc_id < 3").selectExpr("CAST(NULL AS bigint) AS doc_id", "text")).unionByName(table.where("doc_id < 9"))
    for limit in (toxicity.SHARED, 0):
        monkeypatch.setattr(toxicity, "SHARED", limit)
        fitted = toxicity.fit(table, labels)
        got = toxicity.score(repeated, fitted).collect()
        assert len(got) == 212
        a, b, c = fitted[-1]
        for r in got:
            own_pairs = pairs(r.text)
            x = sum(log(v, w) for v, w in own_pairs) / math.sqrt(len(own_pairs))
            value = a * max(-toxicity.REACH, min(toxicity.REACH, x)) + b + c * min(int(math.log2(len(own_pairs) + 1)), 15) / 16
            assert abs(r.score - 1 / (1 + math.exp(-max(-30, min(30, value))))) < 1e-6


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><header><a href=/>Site</a></header>
<div class="cookie-notice">We use cookies on this site</div><nav><ul><li><a>one</a></li><li><a>two</a></li></ul></nav><!-- x <p>no</p> -->
<article><h1>Title &amp; more</h1><p>First <b>para<br>line
 two.<p>Short.</p><aside>Related stuff</aside><div class="ad">Buy now</div><p>Last <a href="a>b">one</a> 3 &lt; 4 &eacute;</p><script>if (a<b) "</p>"</script></article>
<section id="comments"><p>Nice article, I liked it a lot and so on</p></section><form><label>Name</label><input></form><footer>&copy; us</footer>"""


def test_main_text(spark):
    want = "Title & more\n\nFirst para line two.\n\nShort.\n\nLast one 3 < 4 é"
    cases = {PAGE: want, "": "", None: "", "<p></p>": "", "<article><p>a" + " b" * 50_000: "a" + " b" * 50_000, "<script>x": "", "<!-- <p>x</p>": "", "<article><p title=it's>ok</p>": "ok"}
    rows = spark.createDataFrame([(i, f"u{i}", h, 1) for i, h in enumerate(cases)] + [(0, "again", PAGE, None)], "page_id long, url string, html string, words int")
    out = html_text.extract(rows)
    assert out.columns == ["page_id", "url", "words", "text"]
    assert {(r.page_id, r.text) for r in out.collect()} == {(i, t) for i, t in enumerate(cases.values())}
    x, y = html_text.labelled_table()
    assert sum(html_text.is_main(row, html_text.tree()) == bool(label) for row, label in zip(x.tolist(), y)) == len(y)
    assert html_text.extract(rows.limit(0)).count() == 0


STORY = [" ".join(f"s{k}w{i}" for i in range(n)) for k, n in enumerate((40, 3, 55, 28))]
FRAME = "<nav><ul><li><a>Home</a></li><li><a>News here</a></li></ul></nav>", "<aside><p>" + "aside " * 30 + "</p></aside>", "<footer>About us and legal things</footer>"


@pytest.mark.parametrize("name", html_text.WRAPPERS)
def test_wrappers_keep_the_article(name):
    """Every name, those kept out of growing too, around an ordinary 126-word article, with menus and sidebars inside and outside."""
    menu, side, foot = FRAME
    story = f"<h1>The title of it all</h1>" + "".join(f"<p>{p}</p>" for p in STORY)
    want = "\n\n".join(["The title of it all", *STORY])
    tag = name.split()[0]
    for page in (f"<{name}>{menu}{story}{side}</{tag}>{foot}", f"{menu}<{name}>{story}</{tag}>{side}{foot}", f"<{name}>{story}</{tag}><div>Five words of plain footer</div>"):
        found = html_text.main_text(f"<html><body>{page}</body></html>")
        assert found.removesuffix("\n\nFive words of plain footer") == want


@pytest.mark.parametrize("name", ["comments", "comment-list", "sidebar", "reader-comments", "share", "notice", "more", "related", "cookie-notice", "newsletter-form", "ad", "tags", "discussion", "readers"])
def test_telling_names_beside_an_article_are_left_out(name):
    menu, _, foot = FRAME
    story = f"<h1>The title of it all</h1>" + "".join(f"<p>{p}</p>" for p in STORY)
    want = "\n\n".join(["The title of it all", *STORY])
    for size in (8, 60, 300):
        extra = f'<div class="{name}"><h3>Some words</h3><p>{"other " * size}</p></div>'
        for page in (f"{menu}<article>{story}</article>{extra}{foot}", f"{menu}<div>{story}</div>{extra}{foot}", f"<div class='page no-sidebar'>{menu}{story}{extra}</div>{foot}"):
            assert html_text.main_text(f"<html><body>{page}</body></html>") == want


@pytest.mark.parametrize("name", ["svg", "select", "button", "object", "canvas", "datalist", "noscript", "template"])
def test_unclosed_concealed_elements_end_with_their_block(name):
    story = "<article><h1>Some title of it</h1><p>" + "word " * 40 + "</p></article>"
    want = html_text.main_text(f"<body><header></header>{story}</body>")
    assert want.endswith("word")
    for inner in (f"<{name}>Menu", f"<{name}><div>Menu</div>", f"<{name}>Menu<script>'</header>'</script>more</{name}>", f"<{name}>Menu<p>x</{name}>"):
        assert html_text.main_text(f"<body><header>{inner}</header>{story}</body>") == want
    assert html_text.main_text(f"<body><header><{name}>Menu</header>{story}<{name}>x</{name}></body>") == want


def test_search_against_all_scores(spark, whole, empty, monkeypatch):
    texts = [(i, t) for i, t in TEXTS if i is not None] + chain(40)
    counts = {i: collections.Counter(w.translate(LOWER) for w in re.findall("[0-9A-Za-z\x80-\U0010ffff]+", text_of(t))) for i, t in texts}
    mean = sum(sum(c.values()) for c in counts.values()) / len(counts)
    df = collections.Counter(w for c in counts.values() for w in c)

    def score(query, c):
        norm = search.K1 * (1 - search.B + search.B * sum(c.values()) / mean)
        return sum(n * math.log(1 + (len(counts) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * (search.K1 + 1) / (c[w] + norm) for w, n in query.items() if w in c)

    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    queries = docs.where("doc_id % 3 = 0").selectExpr("doc_id AS query_id", "text")
    for shard, block in ((search.SHARD, search.BLOCK), (7, 2)):
        monkeypatch.setattr(search, "SHARD", shard)
        monkeypatch.setattr(search, "BLOCK", block)
        monkeypatch.setattr(search, "QUERIES", 5)
        got = collections.defaultdict(list)
        for r in sorted(search.top_k(docs, queries, k=4).collect(), key=lambda r: r["rank"]):
            got[r.query_id].append((round(r.score, 6), r.doc_id))
        for i, _ in texts:
            if i % 3 == 0:
                scores = sorted((-round(score(counts[i], c), 6), j) for j, c in counts.items() if score(counts[i], c) > 0)[:4]
                assert got[i] == [(-s, j) for s, j in scores]
    assert search.top_k(empty, queries).count() == 0 and search.top_k(whole, queries.limit(0)).count() == 0


def test_queries_cover_every_operator():
    from tidemark.llm import QUERIES

    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


def test_op_digests_match_their_definitions(spark, sf):
    from tidemark.llm import QUERIES

    texts = {r.doc_id: text_of(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op1_bpe"](spark, sf).collect():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        ids = bpe.codec(bpe.RANKS).encoding.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    for r in QUERIES["op10_pii"](spark, sf).collect():
        spans = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert r.n_email == sum(k == "email" for k, *_ in spans)


def test_suffix_parts_of_spaced_and_null_ids(spark):
    """Ids that are multiples of the number of parts, null ids and copies spread; both sides agree on the part."""
    texts = [(8 * i, f"text {i % 7} é") for i in range(1000)] + [(None, f"other {i}") for i in range(1000)] + [(i * 16, "one copy") for i in range(1000)]
    rows = spark.createDataFrame(texts, "id long, text string").withColumn("part", suffixes.text_part(8)).collect()
    assert max(collections.Counter(r.part for r in rows).values()) < 1.25 * len(rows) / 8
    ids = np.array([suffixes._LAST if i is None else i for i, _ in texts])
    raw = [t.encode() for _, t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    tags = suffixes.text_tags(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert suffixes.part_of(ids, tags, 8).tolist() == [r.part for r in rows]


def test_texts_without_letters_are_undetermined(spark):
    table = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate([("the good house", "en"), ("das gute haus", "de")] * 30)], "doc_id long, text string, lang string")
    odd = ["½ ① ²", "123 456", "_", "Ⅷ", "", None, "٣٤", "ª", "中", "x"]
    found = langid.classify(spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string"), langid.fit(table)).collect()
    assert {odd[r.doc_id] for r in found if r.lang_pred == "und"} == {"½ ① ²", "123 456", "_", "Ⅷ", "", None, "٣٤"}
    assert {r.score for r in found if r.lang_pred == "und"} == {0.0}


def test_jaccard_parts_grow_with_the_postings(spark, whole, monkeypatch):
    """A part holds a bounded number of postings on average, whatever the number of shuffle partitions."""
    want = sorted(map(str, jaccard.near_groups(whole).collect()))
    counts, plain = [], jaccard.shared_lists
    monkeypatch.setattr(jaccard, "PART", 500)
    monkeypatch.setattr(jaccard, "shared_lists", lambda packed, count: counts.append((count, packed.select("part").distinct().count())) or plain(packed, count))
    assert sorted(map(str, jaccard.near_groups(whole).collect())) == want
    assert counts[0][0] > 4 and counts[0][1] > 4  # the session has four partitions


def test_shard_search_adds_postings_in_small_runs(monkeypatch):
    """The lists of rarer terms are added up for some queries at a time; sums are those of one run."""
    rng = np.random.default_rng(3)
    docs, terms, counts = rng.integers(0, 300, 9000), rng.integers(0, 900, 9000).astype(np.uint64), rng.integers(1, 5, 9000)
    order = np.lexsort((docs, terms))
    docs, terms, counts = docs[order], terms[order], counts[order]
    new = np.concatenate([[True], (terms[1:] != terms[:-1]) | (docs[1:] != docs[:-1])])
    docs, terms, counts = docs[new], terms[new], counts[new]
    begin = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
    arrays = {"ids": np.arange(300), "lengths": np.full(300, 30), "terms": terms[begin], "places": np.append(begin, len(terms)), "docs": docs, "counts": counts}
    shard = search.Shard({k: search.pack_bytes(arrays[k].astype(kind)) for k, kind in search._ARRAYS.items()}, 30.0)
    query, at, weight = np.repeat(np.arange(20), 40), rng.integers(0, len(begin), 800), rng.random(800)
    want = np.zeros((20, 300))
    for q, t, w in zip(query, at, weight):
        own = slice(shard.places[t], shard.places[t + 1])
        np.add.at(want[q], shard.docs[own], w * shard.shares[own])
    used, plain = [], np.bincount
    monkeypatch.setattr(search, "CACHED", 500)
    monkeypatch.setattr(search.np, "bincount", lambda x, **k: used.append(len(x)) or plain(x, **k))
    assert np.allclose(shard._listed(query, at, weight, 20), want, atol=1e-12) and len(used) > 1 and max(used) < len(docs)


def lone_texts(n, words, copies=()):
    """Texts that share nothing, and near copies of some."""
    rng = random.Random(5)
    texts = [" ".join(f"{rng.getrandbits(60):x}" for _ in range(words)) for _ in range(n)]
    return list(enumerate(texts + [texts[i] + " more" for i in copies]))


def test_jaccard_sends_the_lists_of_possible_partners_only(spark, monkeypatch):
    """Whole sets are sent only if enough of their first shingles occur in another set."""
    texts = lone_texts(300, 200, (3, 70, 150))
    sent, plain = [], jaccard.shared_lists
    monkeypatch.setattr(jaccard, "shared_lists", lambda packed, count: sent.append(packed.select(F.sum(F.length("data"))).first()[0]) or plain(packed, count))
    got = {r.id: r.component for r in jaccard.near_groups(spark.createDataFrame(texts, "doc_id long, text string").repartition(4)).collect()}
    assert got == {i: i for i in range(300)} | {300: 3, 301: 70, 302: 150}
    assert sent[0] < 20 * 196 * 30  # 30 sets; six have a partner


def test_prefixes_of_linked_sets_agree():
    rng = random.Random(11)
    for _ in range(3000):
        n, more = rng.randint(1, 60), rng.randint(0, 12)
        keys = rng.sample(range(10**6), n + more)
        x, y = set(keys[:n]), set(keys[rng.randint(0, 12) : n + rng.randint(0, more)])
        if y and 100 * len(x & y) >= 80 * len(x | y):
            first = [set(sorted(s)[: jaccard.prefix(len(s))]) for s in (x, y)]
            assert len(first[0] & first[1]) >= jaccard.agreed(min(len(x), len(y)))
            assert all(min(len(x), len(y)) >= jaccard.required(len(s)) for s in (x, y))


def test_shared_prefixes_are_never_too_few(spark):
    """Counts of one part: shared keys of different sets count, lone ones do not; a key that a set holds twice counts as often."""
    packed = [{"key": [5, 5, 9, 7, 7], "sig": [1, 2, 1, 3, 3]}, {"key": [5, 8], "sig": [4, 4]}]
    rows = [(0, bytearray(pack_columns({"key": np.array(x["key"], np.uint32), "sig": np.array(x["sig"], np.int64)}))) for x in packed]
    rows.append((1, bytearray(pack_columns({"key": np.array([6, 6, 6], np.uint32), "sig": np.array([1, 1, 2], np.int64)}))))
    got = jaccard.shared_prefixes(spark.createDataFrame(rows, "part int, data binary")).collect()
    assert {r.sig: r.shared for r in got} == {1: 3, 2: 2, 4: 1}


@pytest.mark.parametrize("most", [15, 28])
def test_marks_hold_every_digest(spark, most, monkeypatch):
    """However few the bits, what was marked passes; with enough bits, little else."""
    monkeypatch.setattr(jaccard, "MARKS", most)
    rows = spark.range(5000).select(F.xxhash64("id").alias("digest"))
    bits = jaccard.marks(rows, 5000)
    digests = np.array([r.digest for r in rows.collect()])
    others = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 20_000)
    assert jaccard.marked(bits, digests).all() and jaccard.marked(bits, others).mean() < (0.2 if most == 15 else 0.1)
    assert len(bits) == (1 << 12 if most == 15 else 1 << 14) and not jaccard.marked(jaccard.marks(rows.limit(0), 0), digests).any()


def test_small_blobs_cost_little_more_than_their_rows():
    """The bytes sent must not grow with the number of parts."""
    rng = np.random.default_rng(4)
    parts = [{"key": rng.integers(0, 2**63, n).astype(np.uint64), "sig": rng.integers(0, 2**63, n), "n": np.full(n, 300, np.int32)} for n in (1, 40, 0, 7)]
    blobs = [pack_columns(x) for x in parts]
    assert all(len(b) <= 20 * len(x["n"]) + 40 for b, x in zip(blobs, parts))
    back = unpack_columns(blobs, {"key": np.uint64, "sig": np.int64, "n": np.int32})
    assert all((back[k] == np.concatenate([x[k] for x in parts])).all() and back[k].dtype == parts[0][k].dtype for k in back)
    assert unpack_columns([], {"key": np.uint64})["key"].shape == (0,)


@pytest.mark.parametrize("repeated", [[], [(9002, "a row that is there twice")] * 2])
@pytest.mark.parametrize("drop", [exact_dedup.drop_copies, jaccard.drop_near])
def test_few_dropped_rows_move_no_text(spark, drop, repeated):
    """The rows to drop are staged, so Spark knows that they are few and broadcasts them."""
    texts = lone_texts(8000, 8) + [(i, "the same few words in both of these rows") for i in (9000, 9001)] + repeated
    rows = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        kept = drop(rows)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        # Rows of repeated ids, which are few, may be compared with the kept ones by a sort-merge semi-join.
        assert kept.count() == 8001 + len(repeated) // 2 and re.search("BroadcastHashJoin .*LeftAnti", plan)
        assert not re.search("SortMergeJoin .*(LeftAnti|LeftOuter)", plan) and (not repeated or re.search("BroadcastHashJoin .*(LeftSemi|LeftOuter)", plan))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_blob_of_one_interval_costs_little_more_than_its_row():
    """Every part of a pass sends one to every part of the next, so their number grows with the square of the parts."""
    row = {"doc": np.array([7]), "tag": np.array([3], np.uint32), "start": np.array([0], np.int32), "end": np.array([50], np.int32)}
    batch = suffixes._batch("done", [(2, row)])
    blob = batch.column(2)[0].as_py()
    assert len(blob) < 60 and batch.column(1).to_pylist() == [2]
    back = suffixes.unpack_columns([blob, blob], suffixes._SPAN)
    assert {k: v.tolist() for k, v in back.items()} == {"doc": [7, 7], "tag": [3, 3], "start": [0, 0], "end": [50, 50]}
    assert {k: v.dtype for k, v in back.items()} == suffixes._SPAN


def test_a_shard_sends_few_blobs_for_each_block_of_queries(spark, monkeypatch):
    """Each block of queries has merge parts of its own: their number does not multiply with that of the blocks."""
    found, stage = [], search.stage
    monkeypatch.setattr(search, "QUERIES", 8)
    monkeypatch.setattr(search, "stage", lambda df, name: found.append(out := stage(df, name)) or out if name == "found" else stage(df, name))
    docs = spark.createDataFrame([(i, f"common w{i % 7} w{i % 5}") for i in range(40)], "doc_id long, text string").coalesce(1)
    queries = docs.where("doc_id < 32").selectExpr("doc_id AS query_id", "text")
    rows = search.top_k(docs, queries, k=3).collect()
    assert sorted((r["query_id"], r["rank"]) for r in rows) == [(q, k) for q in range(32) for k in (1, 2, 3)]
    sent = [r["part"] for df in found for r in df.collect()]
    assert len(found) == 4 and len(sent) <= 4 and len(set(sent)) == len(sent)  # one shard, four blocks, four parts
