"""Ranked lexical search by dense blocked matrix products in whole numbers.

The distinct terms of the items are the vocabulary; documents are read once and kept
as counts of vocabulary terms.  With the corpus statistics at hand, item
tiles (``ITEMS`` rows, only the terms that occur in the tile, cut into column tiles) are
multiplied with document tiles of impacts by BLAS in float64.  A column tile is
so narrow that every partial sum stays below 2**53, so products are exact; tiles add up in 64-bit
integers.  Every task keeps the best k of each item: whatever reaches the
k-th score takes part in the cut, ties by id, so the merge over tasks is exact.

    score  = sum over the item's terms of  weight * impact
    weight = floor(1000 ln((2 N + 2) / (2 df + 1)))
    impact = 10**9 tf div (1000 tf + 20 m),  m = (1 - b) 100 + 100 b n N div L,  b = 1/2

N counts documents that hold a term, L their terms, n one document's terms.  Terms are
runs of letters, digits and characters beyond ASCII, A-Z lowered, compared byte by byte.

Items are searched in blocks of about ``BLOCK_TERMS`` terms, dealt by a hash
of the id; only a block's terms are sent to the workers, and each block is one pass over the documents.

Cases: null and empty texts hold no terms, are never found and find nothing;
rows of one item id form one item, null ids among them; every document row is ranked for
itself; ties go to the smaller id, null last; fewer than k documents above 0
give fewer rows; without items, documents or terms there are no rows; columns
besides ids and texts never matter.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

from .catalog import query, table
from .text import list_array, narrow, owners, slices
from .vocabulary import Vocabulary, words_of

ITEMS, COLUMNS, DOCUMENTS = 256, 4096, 256  # sizes of the tiles
TOGETHER = 2048  # documents whose scores a task holds
BLOCK_TERMS = 200_000
EXACT = 1 << 53
SCALE = 1_000_000  # no impact reaches it: 10**9 tf div (1000 tf + 20 m) with m > 0
SALTS = 64


def item_terms(items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """Distinct (item, term) of all items; written to the shared folder."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for a, b, data, offsets in slices(batch.column(1)):
                sets = [sorted(set(words)) for words in words_of(data, offsets)]
                own = pa.array(np.repeat(np.arange(a, b), [len(s) for s in sets]))
                yield pa.RecordBatch.from_arrays([ids.take(own), pa.array([w for s in sets for w in s], pa.binary())], ["item", "term"])

    rows = narrow(items, item_id, item_text).select(F.col(item_id).cast("bigint").alias("item"), item_text)
    return stage(rows.mapInArrow(run, "item bigint, term binary").distinct(), "items")


def in_blocks(terms: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """The rows with a block each, and the number of blocks: twice ``limit`` rows at most, or a single item's."""
    total = terms.count()
    blocks = -(-total // limit)
    while True:
        dealt = terms.withColumn("block", F.pmod(F.xxhash64("item", F.lit("block")), F.lit(max(blocks, 1))))
        if blocks <= 1 or blocks > total:
            return dealt, blocks
        largest = dealt.groupBy("block").agg(F.count("*").alias("n"), F.min("item").alias("low"), F.max("item").alias("high"))
        if largest.where(f"n > {2 * limit} AND NOT low <=> high").isEmpty():
            return dealt, blocks
        blocks *= 2


class Block:
    """Items of one block: ids, vocabulary, and (item, term) pairs in order of item."""

    def __init__(self, rows: pa.Table):
        names = rows.column("item").to_pylist()
        self.ids = sorted(set(names), key=lambda i: (i is None, i))
        place = {name: i for i, name in enumerate(self.ids)}
        terms = rows.column("term").to_pylist()
        self.vocabulary = Vocabulary(terms)
        item = np.array([place[n] for n in names], dtype=np.int64)
        term = np.array([self.vocabulary.number[t] for t in terms], dtype=np.int64)
        order = np.lexsort((term, item))
        self.item, self.term = item[order], term[order]


def counts(docs: DataFrame, block, id_col: str, text_col: str) -> DataFrame:
    """Each document's id, number of terms, and vocabulary terms with their counts; written to the shared folder."""

    def run(batches):
        vocabulary = block.value.vocabulary
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                found, _, _, places = vocabulary.find(data, offsets)
                hit = found >= 0
                pair, tf = np.unique(owners(places)[hit] * len(vocabulary) + found[hit], return_counts=True)
                cut = np.searchsorted(pair, np.arange(b - a + 1) * len(vocabulary))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(places)), list_array(pair % len(vocabulary), cut, pa.int32()), list_array(tf, cut, pa.int32())],
                    ["doc", "n", "terms", "tf"],
                )

    rows = docs.select(docs[id_col].cast("bigint").alias("doc"), docs[text_col])
    return stage(rows.mapInArrow(run, "doc bigint, n bigint, terms array<int>, tf array<int>"), "counts")


def statistics(entries: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, their terms, and the document frequency of each vocabulary term, over all documents."""

    def run(batches):
        df, documents, total = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            n = batch.column(0).to_numpy(zero_copy_only=False)
            documents, total = documents + int((n > 0).sum()), total + int(n.sum())
            df += np.bincount(batch.column(1).flatten().to_numpy(zero_copy_only=False), minlength=size)
        keys = [-2, -1, *np.flatnonzero(df).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([total, documents, *df[df > 0].tolist()], pa.int64())], ["key", "value"])

    rows = narrow(entries, "n", "terms").mapInArrow(run, "key bigint, value bigint").groupBy("key").agg(F.sum("value").alias("value"))
    found = {r.key: r.value for r in rows.collect()}
    return found.get(-1, 0), found.get(-2, 0), np.array([found.get(i, 0) for i in range(size)], dtype=np.int64)


class Best:
    """The best k documents so far of each item."""

    def __init__(self, items: int, k: int):
        self.items, self.k = items, k
        self.item, self.score, self.lost, self.doc = (np.zeros(0, np.int64) for _ in range(4))
        self.floor = np.zeros(items, np.int64)

    def add(self, first: int, scores: np.ndarray, lost: np.ndarray, docs: np.ndarray) -> None:
        """Scores (item, document) of the items from ``first`` on; ``lost`` marks documents without an id."""
        floor = self.floor[first : first + len(scores)]
        if scores.shape[1] > self.k:
            floor = np.maximum(floor, np.partition(scores, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k])
        row, column = np.nonzero((scores > 0) & (scores >= floor[:, None]))
        if not len(row):
            return
        item = np.concatenate([self.item, row + first])
        score = np.concatenate([self.score, scores[row, column]])
        gone, doc = np.concatenate([self.lost, lost[column]]), np.concatenate([self.doc, docs[column]])
        order = np.lexsort((doc, gone, -score, item))
        begin = np.searchsorted(item[order], np.arange(self.items + 1))
        place = np.arange(len(order)) - np.repeat(begin[:-1], np.diff(begin))
        keep = order[place < self.k]
        self.item, self.score, self.lost, self.doc = item[keep], score[keep], gone[keep], doc[keep]
        full = order[place == self.k - 1]
        self.floor[item[full]] = score[full]


def impacts(n: np.ndarray, row: np.ndarray, tf: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Whole-number impact of each (document row, count)."""
    lengths, which = np.unique(n, return_inverse=True)
    m = np.array([50 + 50 * x * documents // total for x in lengths.tolist()], dtype=np.int64)[which]
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m[row])


def tiles(block: Block, weight: np.ndarray):
    """(first item, number of items, [(terms of a column tile, dense weights)]) of every item tile."""
    for first in range(0, len(block.ids), ITEMS):
        own = slice(*np.searchsorted(block.item, [first, first + ITEMS]).tolist())
        size = min(ITEMS, len(block.ids) - first)
        item, term = block.item[own] - first, block.term[own]
        names, column = np.unique(term, return_inverse=True)
        width = max(1, min(COLUMNS, (EXACT - 1) // (SCALE * max(1, int(weight[names].max(initial=1))))))
        parts = []
        for low in range(0, len(names), width):
            use = (column >= low) & (column < low + width)
            dense = np.zeros((size, min(width, len(names) - low)))
            dense[item[use], column[use] - low] = weight[term[use]]
            parts.append((names[low : low + width], dense))
        yield first, size, parts


def multiply(parts, size: int, n: int, row: np.ndarray, term: np.ndarray, impact: np.ndarray, vocabulary: int) -> np.ndarray:
    """Scores (item, document) of one item tile and ``n`` documents, whose impacts come in order of document."""
    scores = np.zeros((size, n), np.int64)
    cuts = np.searchsorted(row, np.arange(0, n + DOCUMENTS, DOCUMENTS))
    for names, dense in parts:
        column = np.full(vocabulary, -1)
        column[names] = np.arange(len(names))
        for i, low in enumerate(range(0, n, DOCUMENTS)):
            own = slice(cuts[i], cuts[i + 1])
            at = column[term[own]]
            use = at >= 0
            tile = np.zeros((min(DOCUMENTS, n - low), len(names)))
            tile[row[own][use] - low, at[use]] = impact[own][use]
            scores[:, low : low + len(tile)] += (dense @ tile.T).astype(np.int64)
    return scores


def best_of_block(entries: DataFrame, block, k: int, documents: int, total: int, df: np.ndarray) -> DataFrame:
    """The best k documents of each item within every task: item, doc, score, salt."""
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)

    def run(batches):
        own = block.value
        salt = TaskContext.get().partitionId() % SALTS
        best = Best(len(own.ids), k)
        for batch in batches:
            for low in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(low, TOGETHER)
                lost = part.column(0).is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                docs = part.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                length = part.column(1).to_numpy(zero_copy_only=False)
                term, tf = (part.column(c).flatten().to_numpy(zero_copy_only=False) for c in (2, 3))
                row = np.repeat(np.arange(part.num_rows), part.column(2).value_lengths().to_numpy(zero_copy_only=False))
                impact = impacts(length, row, tf, documents, total).astype(np.float64)
                for first, size, parts in tiles(own, weight):
                    best.add(first, multiply(parts, size, part.num_rows, row, term, impact, len(own.vocabulary)), lost, docs)
        yield pa.RecordBatch.from_arrays(
            [pa.array([own.ids[i] for i in best.item.tolist()], pa.int64()), pa.array(best.doc, mask=best.lost > 0), pa.array(best.score), pa.array(np.full(len(best.doc), salt), pa.int32())],
            ["item", "doc", "score", "salt"],
        )

    return stage(entries.mapInArrow(run, "item bigint, doc bigint, score bigint, salt int"), "best")


def rank(
    docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """Columns item_id, rank (from 1), doc_id, score: the best k documents of every item."""
    spark = docs.sparkSession
    terms, blocks = in_blocks(item_terms(items, item_id, item_text), block_terms)
    found = spark.createDataFrame([], "item bigint, doc bigint, score bigint, salt int")
    for number in range(blocks):
        rows = terms.where(F.col("block") == number).select("item", "term").toArrow()
        if not rows.num_rows:
            continue
        block = spark.sparkContext.broadcast(Block(rows))
        entries = counts(docs, block, id_col, text_col)
        documents, total, df = statistics(entries, len(block.value.vocabulary))
        if documents:
            found = found.unionByName(best_of_block(entries, block, k, documents, total, df))
        block.unpersist()
    best = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    for keys in (["item", "salt"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best))).where(F.col("rank") <= k)
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


SQL = r"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
items AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scores AS (SELECT item_id, doc_id, sum(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT
      * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms)))))::BIGINT AS score
  FROM items JOIN df USING (term) JOIN tf USING (term) JOIN lengths USING (doc_id) CROSS JOIN total GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50"""


@query("op11_ranked_search", SQL)
def op11_ranked_search(spark, sf_dir):
    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
