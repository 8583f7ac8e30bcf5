"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney bigram models, of toxic and of ordinary labelled
texts, give each text two log-likelihoods; their difference over its distinct bigrams, divided by the
root of their number (as chance adds up), is the evidence, and a logistic curve fitted on labelled rows of their own turns it
into a score.

    p(w|v, c) = (m_c(v w) + n(v) s(w|v)) / (e_c(v w) + n(v) s(w|v))  times s(w|v) p(w|c) / p(w)
    s(w|v)    = (max(n(v w) - D, 0) + freed t(w)) / n(v)
    p(w|c)    = p(w) (m_c(w) + n(w)) / (e_c(w) + n(w))
    t(w)      = (t(. w) + 1) / (t(.) + words)

with n numbers of texts, t(. w) the number of distinct words in front, ``words`` the number of distinct words, ``freed`` what the
discounts set free, e_c the count expected in class c by its share (of the word in front, or of all words), and

    m_c = e_c + (n_c - e_c) (z^2 / (z^2 + DOUBT))^2,   z^2 = (n_c - e_c)^2 / (e_toxic + 1).

Both models back off to the shared counts s, whose mass is as large as all of a bigram's own, and a class's
count is drawn toward its expectation by as much as chance could explain it: continuously, so that
every expression speaks, one met once or twice only faintly, one that is merely
commoner in a language with more toxic texts hardly at all.  ``DOUBT`` and ``LEAST`` were chosen on learning rows.

Words are 64-bit hashes, and every counted bigram takes part.  All labelled
text is counted by a shuffle that grows with it.  Log-ratios are drawn toward 0 by ``LEAST`` as well,
which spares the table the expressions that say next to nothing; the table is broadcast up to ``SHARED``
rows and joined with the texts' bigrams above that, with the same scores.

Labels are learned only from rows that are not held out; of these, the rows
with remainder 4 fit the curve (as counts on a fixed grid), the others the models.

Cases: null texts and texts without a word have no evidence and the score of
evidence 0; a label that is null teaches nothing; labels that repeat count each
row; without labels of both classes all scores are 0; an empty table gives an
empty table; further columns never matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

from .catalog import query, table
from .text import LETTERS, mix, narrow, owners, pack_arrays, parts, slices, split_by, sums_by_text, unpack_arrays, word_hashes

DISCOUNT = 0.75
DOUBT, LEAST = 16.0, 0.01
GRID, REACH, SIZES = 8192, 4.0, 16  # steps and reach of the evidence, length classes
HELD = 1_500_000  # bigrams a task gathers before it merges or sends them on
SHARED = 3_000_000  # words and bigrams up to which their table is broadcast
_STEP = np.uint64(0x9E3779B97F4A7C15)
_OPENING, _ALONE = np.uint64(0), np.uint64(1)  # in front of a text's first word, and of a word that stands for itself
_FILTER = (1 << 23) - 1
_X, _LENGTH, _ROW = "__evidence", "__length", "__row"


def folds(id_col: str = "doc_id"):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5))


def pair_keys(front, word: np.ndarray) -> np.ndarray:
    return mix(front * _STEP + word)


def bigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct bigrams - hashes of the word in front and of the word - and each text's range of them.

    A bigram counts once a text, so a text that repeats itself is not louder than others.
    """
    word, places = word_hashes(data, offsets, LETTERS)
    front = np.empty_like(word)
    front[1:] = word[:-1]
    front[places[:-1][np.diff(places) > 0]] = _OPENING
    text, key = owners(places), pair_keys(front, word)
    order = np.lexsort((key, text))
    key = key[order]
    new = np.ones(len(order), bool)
    new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])  # the order keeps texts in their places
    order = order[new]
    return front[order], word[order], np.searchsorted(text[order], np.arange(len(places)))


def _merge(front: np.ndarray, word: np.ndarray, n0: np.ndarray, n1: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of equal bigrams added up, in order of front and word."""
    order = np.lexsort((word, front))
    front, word = front[order], word[order]
    new = np.ones(len(order), bool)
    new[1:] = (front[1:] != front[:-1]) | (word[1:] != word[:-1])
    first = np.flatnonzero(new)
    n0, n1 = (np.add.reduceat(n[order], first) if len(first) else n for n in (n0, n1))
    return {"front": front[first], "word": word[first], "n0": n0, "n1": n1}


def count_bigrams(rows: DataFrame, count: int) -> DataFrame:
    """Counts of (bigram, class) of ``rows`` (text, toxic), packed by the part of the first word."""

    def run(batches):
        held, size = [], 0

        def merged():
            return _merge(*(np.concatenate([h[k] for h in held]) for k in ("front", "word", "n0", "n1")))

        def flush(x):
            part = (mix(x["front"]) >> np.uint64(33)).astype(np.int64) % count
            keys, blobs = zip(*[(k, pack_arrays(**arrays)) for k, arrays in split_by(part, count, x)])
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(blobs, pa.binary())], ["part", "data"])

        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint32)
            for a, b, data, offsets in slices(batch.column(0)):
                front, word, places = bigrams(data, offsets)
                n1 = toxic[a:b][owners(places)]
                held.append({"front": front, "word": word, "n0": np.uint32(1) - n1, "n1": n1})
                size += len(front)
                if size > HELD:
                    held = [merged()]
                    size = len(held[0]["front"])
                    if size > HELD // 2:
                        yield flush(held[0])
                        held, size = [], 0
        if size:
            yield flush(merged())

    return rows.mapInArrow(run, "part int, data binary")


def gather(packed: DataFrame) -> DataFrame:
    """Of each part: its bigrams with the counts of the word in front, and its share of every word's counts.

    A bigram stays behind if even with the least shared mass its log-ratio were drawn to 0.

    ``others`` is the number of distinct words after the front of a bigram, or in front of a word.
    """
    names = ["pair", "front", "word", "n0", "n1", "t0", "t1", "others"]

    def run(group: pa.Table) -> pa.Table:
        x = _merge(**unpack_arrays(group.column("data").to_pylist()))
        front, word, n0, n1 = x["front"], x["word"], x["n0"].astype(np.int64), x["n1"].astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], front[1:] != front[:-1]]))
        others = np.diff(np.append(starts, len(front)))
        t0, t1, others = (np.repeat(v, others) for v in (np.add.reduceat(n0, starts), np.add.reduceat(n1, starts), others))
        expected, own = drawn(n1, n0 + n1, t1 / (t0 + t1))
        use = np.abs(log_ratio(n0 + n1, expected, own, n0 + n1 - DISCOUNT)) > LEAST
        order = np.argsort(word, kind="stable")
        words = word[order]
        starts = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
        sums = [np.add.reduceat(n[order], starts) for n in (n0, n1)]
        zero = np.zeros(len(starts), np.int64)
        of_pairs = [np.ones(int(use.sum()), bool), *(v[use] for v in (front.view(np.int64), word.view(np.int64), n0, n1, t0, t1, others))]
        of_words = [np.zeros(len(starts), bool), zero, words[starts].view(np.int64), *sums, zero, zero, np.diff(np.append(starts, len(words)))]
        return pa.Table.from_arrays([pa.array(np.concatenate(v)) for v in zip(of_pairs, of_words)], names)

    kinds = ", ".join(f"{name} bigint" for name in names[1:])
    return packed.groupBy("part").applyInArrow(run, f"pair boolean, {kinds}")


def drawn(toxic: np.ndarray, both: np.ndarray, share) -> tuple[np.ndarray, np.ndarray]:
    """The toxic count to expect, and what is left of its deviation from that."""
    expected = both * share
    off = toxic - expected
    z = off * off / (expected + 1)
    return expected, off * (z / (z + DOUBT)) ** 2


def log_ratio(both: np.ndarray, expected: np.ndarray, own: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """log of the toxic against the ordinary probability, each relative to the shared one."""
    ordinary = both - expected
    return np.log((expected + own + shared) / (expected + shared)) - np.log((ordinary - own + shared) / (ordinary + shared))


def less(value: np.ndarray) -> np.ndarray:
    """Values drawn toward 0 by ``LEAST``."""
    return np.sign(value) * np.maximum(np.abs(value) - LEAST, 0)


def telling(counted: DataFrame) -> DataFrame | None:
    """(key, value): log-ratio of the classes for each word, and for each bigram what its own adds to its word's, where they are not 0.

    None without texts of both classes.
    """
    words = stage(
        counted.where("not pair").groupBy("word").agg(F.sum("n0").alias("w0"), F.sum("n1").alias("w1"), F.sum("others").alias("fronts")), "words"
    )
    total = words.agg(F.sum("w0"), F.sum("w1"), F.sum("fronts"), F.count("*")).first()
    if not (total[0] and total[1]):
        return None
    own, fronts, distinct = np.array(total[:2], float), float(total[2]), float(total[3])
    toxic_share = own[1] / own.sum()

    def rows(key: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        value = less(value)
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)[value != 0]), pa.array(value[value != 0])], ["key", "value"])

    def of_words(batches):
        for batch in batches:
            word, w0, w1 = (batch.column(k).to_numpy() for k in range(3))
            yield rows(pair_keys(_ALONE, word.view(np.uint64)), log_ratio(w0 + w1, *drawn(w1, w0 + w1, toxic_share), w0 + w1))

    def of_pairs(batches):
        for batch in batches:
            front, word, n0, n1, t0, t1, others, before = (batch.column(k).to_numpy() for k in range(8))
            seen = n0 + n1
            shared = seen - DISCOUNT + DISCOUNT * others * (before + 1) / (fronts + distinct)
            yield rows(pair_keys(front.view(np.uint64), word.view(np.uint64)), log_ratio(seen, *drawn(n1, seen, t1 / (t0 + t1)), shared))

    pairs = counted.where("pair").join(words, "word")
    names = ("front", "word", "n0", "n1", "t0", "t1", "others", "fronts")
    kind = "key bigint, value double"
    return stage(narrow(words, "word", "w0", "w1").mapInArrow(of_words, kind).unionByName(narrow(pairs, *names).mapInArrow(of_pairs, kind)), "telling")


def collected(entries: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, and their values; packed on the way to the driver."""

    def run(batches):
        for batch in batches:
            blob = pack_arrays(key=batch.column(0).to_numpy(), value=batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["data"])

    blobs = [bytes(r["data"]) for r in entries.mapInArrow(run, "data binary").collect()]
    if not blobs:
        return np.zeros(0, np.uint64), np.zeros(0)
    x = unpack_arrays(blobs)
    keys = x["key"].view(np.uint64)
    order = np.argsort(keys)
    return keys[order], x["value"][order]


class Model:
    """The telling words and bigrams in memory."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        self.filter = np.zeros(_FILTER + 1, bool)
        self.filter[keys & np.uint64(_FILTER)] = True

    def of(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys))
        at = np.flatnonzero(self.filter[keys & np.uint64(_FILTER)])
        place = np.searchsorted(self.keys, keys[at])
        hit = place < len(self.keys)
        at, place = at[hit], place[hit]
        hit = self.keys[place] == keys[at]
        out[at[hit]] = self.values[place[hit]]
        return out

    def sums(self, front: np.ndarray, word: np.ndarray, places: np.ndarray) -> np.ndarray:
        return sums_by_text(self.of(pair_keys(front, word)) + self.of(pair_keys(_ALONE, word)), places)


def with_evidence(docs: DataFrame, text_col: str, entries: DataFrame, shared) -> DataFrame:
    """All columns, the log-likelihood difference by the root of the number of bigrams, and the length class of each text.

    Without a broadcast model the texts' bigrams are joined with the table; a
    row is known by a number of its own, so repeated or null ids do no harm.
    """
    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

    def ask(batches):
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                front, word, places = bigrams(data, offsets)
                row = batch.column(0).to_numpy()[a:b][owners(places)]
                keys = np.concatenate([pair_keys(front, word), pair_keys(_ALONE, word)]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([row, row])), pa.array(keys)], [_ROW, "key"])

    joined = shared is None
    if joined:
        rows = stage(docs.withColumn(_ROW, F.monotonically_increasing_id()), "rows")
        asked = narrow(rows, _ROW, text_col).mapInArrow(ask, f"{_ROW} bigint, key bigint")
        found = asked.join(entries, "key").groupBy(_ROW).agg(F.sum("value").alias(_X))
        source = rows.join(found, _ROW, "left").select(*[rows[c] for c in docs.columns], F.coalesce(found[_X], F.lit(0.0)).alias(_X))
    else:
        source = docs
    place, width = docs.columns.index(text_col), len(docs.columns)

    def run(batches):
        for batch in batches:
            x, lengths = [np.zeros(0)], [np.zeros(0, np.int32)]
            for a, b, data, offsets in slices(batch.column(place)):
                front, word, places = bigrams(data, offsets)
                size = np.diff(places)
                sums = batch.column(width).to_numpy()[a:b] if joined else shared.value.sums(front, word, places)
                x.append(sums / np.sqrt(np.maximum(size, 1)))
                lengths.append(length_class(size).astype(np.int32))
            columns = [*batch.columns[:width], pa.array(np.concatenate(x)), pa.array(np.concatenate(lengths))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:width], _X, _LENGTH])

    return source.mapInArrow(run, StructType([*docs.schema.fields, StructField(_X, DoubleType()), StructField(_LENGTH, IntegerType())]))


def length_class(words: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(words + 1).astype(np.int64), SIZES - 1)


def calibrate(rows) -> np.ndarray:
    """Curve (per evidence, constant, per length class) from counts of (step, length class, label)."""
    if not rows or len({r["toxic"] for r in rows}) < 2:
        return np.array([20.0, -1.0, 0.0])
    step, size, y, n = (np.array([float(r[k]) for r in rows]) for k in ("step", "size", "toxic", "n"))
    x = np.stack([(step + 0.5) / GRID * 2 * REACH - REACH, np.ones(len(n)), size / SIZES], axis=1)
    w = np.zeros(3)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - y)) + 1e-3 * w
        w -= np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(3), gradient)
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
    """(telling table, its broadcast form or None, curve) from all labelled rows that are not held out; None without labels of both classes."""
    spark = docs.sparkSession
    known = labels.where(F.col(label_col).isin(0, 1) & (folds(id_col) != 0)).select(id_col, F.col(label_col).cast("int").alias("toxic"))
    # The same join at every size; labels are the side that is held, so texts need no sort.
    rows = narrow(docs.where(folds(id_col) != 0), id_col, text_col).join(known.hint("shuffle_hash"), id_col)
    taught = narrow(rows.where(folds(id_col) != 4), text_col, "toxic")
    entries = telling(stage(gather(count_bigrams(taught, parts(spark))), "bigrams"))
    if entries is None:
        return None
    shared = spark.sparkContext.broadcast(Model(*collected(entries))) if entries.count() <= SHARED else None
    fitted = with_evidence(narrow(rows.where(folds(id_col) == 4), text_col, "toxic"), text_col, entries, shared)
    step = F.least(F.greatest(F.floor((F.col(_X) + REACH) * (GRID / (2 * REACH))), F.lit(0)), F.lit(GRID - 1))
    grid = fitted.select(step.alias("step"), F.col(_LENGTH).alias("size"), "toxic").groupBy("step", "size", "toxic").agg(F.count("*").alias("n"))
    return entries, shared, calibrate(grid.collect())  # at most GRID * SIZES * 2 rows


def score(docs: DataFrame, fitted, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns and ``score_col``, from 0 to 1."""
    if score_col in docs.columns:
        raise ValueError(f"the table has a column {score_col}; name another one")
    if fitted is None:
        return docs.withColumn(score_col, F.lit(0.0))
    entries, shared, curve = fitted
    slope, constant, by_length = (float(v) for v in curve)
    x = F.least(F.greatest(F.col(_X), F.lit(-REACH)), F.lit(REACH))
    value = slope * x + constant + by_length * F.col(_LENGTH) / SIZES
    value = F.least(F.greatest(value, F.lit(-30.0)), F.lit(30.0))
    return with_evidence(docs, text_col, entries, shared).withColumn(score_col, 1 / (1 + F.exp(-value))).drop(_X, _LENGTH)


@query("op5_toxicity")
def op5_toxicity(spark, sf_dir):
    docs = narrow(table(spark, sf_dir, "documents"), "doc_id", "text")
    fitted = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, fitted).select(
        "doc_id", (folds() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
