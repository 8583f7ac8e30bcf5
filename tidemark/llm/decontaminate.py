"""Benchmark decontamination by an Aho-Corasick automaton over words.

Items and documents are normalised to words (runs of lower-case letters, digits and
characters beyond ASCII, after lowering A-Z).  Every window of ``window``
consecutive item words, or the whole of a shorter item, is a pattern.  A word of the
items' vocabulary becomes one character, any other word and the border between two
documents a character no pattern holds, so one automaton finds all windows in a single
scan, whatever the words' lengths.  Each normalised word keeps its place in the
original text, from which runs of hit words are reported.

The automaton is built in each worker from the items' words, which are broadcast.  Items
beyond ``BLOCK_WORDS`` words are dealt to blocks by a hash of their id, a block a
scan; rows with hits (not texts) are then merged by id and text digest.

Cases: null and empty texts hold no words and no hits; an item without words
has no window; rows of one item id count as one item; items with a null id are hit as one item
that ``items`` leaves out; equal windows of several items count for each; a repeated
document row gives a row for itself, null document ids too; empty documents give no rows,
empty items rows without hits; columns besides ids and texts never matter.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

from .catalog import query, table
from .ranking import in_blocks
from .text import LETTERS, narrow, owners, ranges, slices, word_spans
from .vocabulary import Vocabulary, words_of

WINDOW = 10
BLOCK_WORDS = 500_000
FIRST, MOST = 0xE000, 0x110000 - 0xE000  # characters that stand for words
OTHER = 0x20  # any other word, and the border between texts
RUN = "struct<first: bigint, last: bigint, start: bigint, end: bigint>"
HITS = f"doc bigint, digest binary, n_words bigint, runs array<{RUN}>, items array<bigint>, unnamed boolean"


class Patterns:
    """The windows of one block of items."""

    def __init__(self, ids: list, texts: list[list[bytes]], window: int):
        self.vocabulary = Vocabulary(w for words in texts for w in words)
        if len(self.vocabulary) > MOST:
            raise ValueError("an item holds more distinct words than one automaton can tell apart")
        self.names = sorted(set(ids), key=lambda i: (i is None, i))
        place = {name: i for i, name in enumerate(self.names)}
        owner: dict[str, set[int]] = {}
        for name, words in zip(ids, texts):
            text = "".join(chr(FIRST + self.vocabulary.number[w]) for w in words)
            for at in range(max(1, len(text) - window + 1) if text else 0):
                owner.setdefault(text[at : at + window], set()).add(place[name])
        self.windows = sorted(owner)
        self.sizes = np.array([len(w) for w in self.windows], dtype=np.int64)
        self.cuts = np.cumsum([0, *(len(owner[w]) for w in self.windows)])
        self.owners = np.array([i for w in self.windows for i in sorted(owner[w])], dtype=np.int64)

    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, text in enumerate(self.windows):
            made.add_word(text, i)
        if self.windows:
            made.make_automaton()
        return made

    def matches(self, automaton, found: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, last word, window) of every occurrence."""
        n = len(places) - 1
        if not self.windows or not (found >= 0).any():
            return (np.zeros(0, np.int64),) * 3
        codes = np.full(len(found) + n, OTHER, dtype=np.uint32)
        own = owners(places)
        codes[np.arange(len(found)) + own] = np.where(found >= 0, found + FIRST, OTHER)
        pairs = list(automaton.iter(codes.tobytes().decode("utf-32-le")))
        end, which = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
        text = np.searchsorted(places[1:] + np.arange(n), end, side="right")
        return text, end - text, which


def runs_of(last: np.ndarray, size: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each maximal run covered by the spans."""
    steps = np.bincount(last - size + 1, minlength=words + 1) - np.bincount(last + 1, minlength=words + 1)
    edge = np.diff(np.concatenate([[0], (np.cumsum(steps)[:words] > 0).astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _digest(data: np.ndarray, a: int, b: int) -> bytes:
    return hashlib.blake2b(data[a:b].tobytes(), digest_size=16).digest()


def _code_points(data: np.ndarray) -> np.ndarray:
    """For each byte place, the characters before it."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])


def scan(rows: DataFrame, patterns, hits_only: bool) -> DataFrame:
    """Hits of every (doc, text) row; the schema is ``HITS``.  With ``hits_only`` rows without a hit are left out."""

    def run(batches):
        block = patterns.value
        automaton = block.automaton()
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                found, starts, ends, places = block.vocabulary.find(data, offsets)
                text, last, which = block.matches(automaton, found, places)
                yield _hit_rows(block, batch.column(0).slice(a, b - a), data, offsets, starts, ends, places, text, last, which, hits_only)

    return rows.mapInArrow(run, HITS)


def _hit_rows(block, docs, data, offsets, starts, ends, places, text, last, which, hits_only) -> pa.RecordBatch:
    n = len(places) - 1
    cut = np.searchsorted(text, np.arange(n + 1))
    hit = np.flatnonzero(np.diff(cut))
    runs, items, unnamed = [[] for _ in range(n)], [[] for _ in range(n)], np.zeros(n, bool)
    nameless = block.names.index(None) if None in block.names else -1
    for t in hit.tolist():
        own = slice(cut[t], cut[t + 1])
        first, final = runs_of(last[own] - places[t], block.sizes[which[own]], int(places[t + 1] - places[t]))
        points = _code_points(data[offsets[t] : offsets[t + 1]])
        start, end = (points[x - offsets[t]] for x in (starts[places[t] + first], ends[places[t] + final]))
        runs[t] = np.stack([first, final, start, end], axis=1)
        windows = np.unique(which[own])
        names = np.unique(block.owners[ranges(block.cuts[windows], block.cuts[windows + 1] - block.cuts[windows])])
        unnamed[t] = nameless in names
        items[t] = [block.names[i] for i in names.tolist() if i != nameless]
    keep = hit if hits_only else np.arange(n)
    flat = np.concatenate([np.zeros((0, 4), np.int64), *(runs[t] for t in keep.tolist() if len(runs[t]))])
    ids = np.array([i for t in keep.tolist() for i in items[t]], dtype=np.int64)
    struct = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(4)], ["first", "last", "start", "end"])
    lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(x[t]) for t in keep.tolist())]), pa.int32()), values) for x, values in ((runs, struct), (items, pa.array(ids)))]
    digests = [_digest(data, offsets[t], offsets[t + 1]) for t in keep.tolist()] if hits_only else pa.nulls(len(keep), pa.binary())
    return pa.RecordBatch.from_arrays(
        [docs.take(pa.array(keep)), pa.array(digests, pa.binary()), pa.array(np.diff(places)[keep]), *lists, pa.array(unnamed[keep])],
        ["doc", "digest", "n_words", "runs", "items", "unnamed"],
    )


def item_blocks(items: DataFrame, item_id: str, item_text: str, window: int, limit: int):
    """The number of blocks of items, and a function that makes the patterns of one."""

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                words = words_of(data, offsets)
                own = pa.array(np.repeat(np.arange(a, b), [len(w) for w in words]))
                flat = pa.array([x for w in words for x in w], pa.binary())
                at = pa.array([i for w in words for i in range(len(w))], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(2).take(own), at, flat], ["item", "row", "place", "word"])

    rows = items.select(F.col(item_id).cast("bigint").alias("item"), F.col(item_text), F.monotonically_increasing_id().alias("row"))
    words, blocks = in_blocks(stage(rows.mapInArrow(run, "item bigint, row bigint, place bigint, word binary"), "items"), limit)

    def make(number: int) -> Patterns:
        own = words.where(F.col("block") == number).select("item", "row", "place", "word").toArrow()
        order = np.lexsort((own.column("place").to_numpy(), own.column("row").to_numpy()))
        item, row, word = (own.column(c).take(pa.array(order)).to_pylist() for c in ("item", "row", "word"))
        ids, texts = [], []
        for i, name in enumerate(item):
            if i == 0 or row[i] != row[i - 1]:
                ids.append(name)
                texts.append([])
            texts[-1].append(word[i])
        return Patterns(ids, texts, window)

    return blocks, make


def merged(rows: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """One row per document row from the hits of all blocks, joined by id and text digest."""

    def base(batches):
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                size = np.diff(word_spans(data, offsets, LETTERS)[2])
                digests = [_digest(data, x, y) for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(digests, pa.binary()), pa.array(size)], ["doc", "digest", "n_words"])

    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    # Equal rows have equal hits in a block: keep one before any row travels with its lists.
    hits = hits.groupBy("doc", "digest", "block").agg(*[F.first(c).alias(c) for c in ("runs", "items", "unnamed")])
    hits = hits.groupBy(F.col("doc").alias("__doc"), F.col("digest").alias("__digest")).agg(
        F.flatten(F.collect_list("runs")).alias("__runs"), F.flatten(F.collect_list("items")).alias("items"), F.max("unnamed").alias("unnamed")
    )
    start = F.array_sort("__runs")
    # Runs in order of their first word; one that begins inside or right behind the last run prolongs it.
    whole = F.aggregate(start, F.array().cast(f"array<{RUN}>"), _append).alias("runs")
    hits = hits.select("__doc", "__digest", whole, F.array_sort("items").alias("items"), "unnamed")
    all_rows = rows.mapInArrow(base, "doc bigint, digest binary, n_words bigint")
    match = all_rows["doc"].eqNullSafe(hits["__doc"]) & (all_rows["digest"] == hits["__digest"])
    empty = {"runs": f"array<{RUN}>", "items": "array<bigint>"}
    return all_rows.join(hits, match, "left").select(
        "doc", "n_words", *[F.coalesce(c, F.array().cast(kind)).alias(c) for c, kind in empty.items()], F.coalesce("unnamed", F.lit(False)).alias("unnamed")
    )


def _append(made, run):
    size = F.size(made)
    tail = F.get(made, size - 1)
    longer = F.struct(
        tail["first"].alias("first"), F.greatest(tail["last"], run["last"]).alias("last"), tail["start"].alias("start"), F.greatest(tail["end"], run["end"]).alias("end")
    )
    joins = (size > 0) & (run["first"] <= tail["last"] + 1)
    return F.when(joins, F.concat(F.slice(made, F.lit(1), F.greatest(size - 1, F.lit(0))), F.array(longer))).otherwise(F.concat(made, F.array(run)))


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items (ids, ascending) and spans (start and end of each hit run in code points)."""
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("bigint").alias("doc"), docs[text_col])
    blocks, make = item_blocks(narrow(items, item_id, item_text), item_id, item_text, window, block_words)
    if blocks <= 1:
        found = scan(rows, spark.sparkContext.broadcast(make(0)), False)
    else:
        parts = []
        for number in range(blocks):
            shared = spark.sparkContext.broadcast(make(number))
            parts.append(stage(scan(rows, shared, True).withColumn("block", F.lit(number)), "hits"))
            shared.unpersist()
        found = merged(rows, parts)
    length = F.transform("runs", lambda r: r["last"] - r["first"] + 1)
    return found.select(
        F.col("doc").alias("doc_id"), "n_words", F.aggregate(length, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n_hit"),
        (F.size("items") + F.col("unnamed").cast("int")).cast("bigint").alias("n_items"), "items",
        F.transform("runs", lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"))).alias("spans"),
    )


SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
places AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) AS b FROM items),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[b:b + 9], ' ') AS win FROM places),
sizes AS (SELECT DISTINCT size FROM windows),
spots AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS b FROM words, sizes WHERE len(w) >= size),
found AS (SELECT doc_id, b, size, item_id FROM (SELECT doc_id, b, size, array_to_string(w[b:b + size - 1], ' ') AS win FROM spots) JOIN windows USING (size, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(b, b + size)) AS p FROM found) GROUP BY doc_id),
own AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN own USING (doc_id)"""


@query("op12_decontamination", SQL)
def op12_decontamination(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
