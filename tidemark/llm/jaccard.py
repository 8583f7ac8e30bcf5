"""N-gram Jaccard join by T-occurrence search over inverted lists.

The set of a document holds its distinct five-word shingles.  With threshold t,
a set y can only be linked to x if it occurs in at least T = ceil(t |x|) of the
inverted lists of x's shingles.  The search runs in these steps.

1. Equal sets become one (their signature), so copies never meet as pairs.
2. Prefixes: with shingles in the order of their hashes, two linked sets share
   ``agreed`` of their first ``prefix`` shingles.  Only these are sent first, as
   half a hash and the set; a set that shares too few of them has no partner,
   and its text is not sent again.
3. Inverted lists of the other sets: shingles go by hash to tasks, each of which
   keeps the lists that hold two sets or more.  A set with fewer than T such
   lists has no partner.
4. Of the remaining sets, those that share one of their rarest shingles (so many
   that any T others must include one) are joined by star edges to the least set
   of the list; the components of these edges hold every linked pair.
5. Within a component the lists are searched by DivideSkip: the longest lists,
   fewer than T, are set aside; the short ones are merged and counted; only sets
   that still can reach the required overlap are probed in the long lists, by
   binary search.  A candidate already known to be connected needs no probe.
   A component with more than ``GROUP`` postings is cut into blocks, and each
   pair of blocks is searched by a task of its own, so no task holds a whole
   component however large.
6. Components of the links found; every document gets the least id of its own.

No list, partner or group is dropped; blobs keep the shuffles compact.

Cases: words are runs without white space, A-Z lowered; a text with fewer than
five words is one shingle; null, empty and blank texts have no shingles and no
links; rows that repeat share a set; a null id is never the least while a
component has another; an empty table gives an empty table; columns besides
the id and the text never matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

from .catalog import query, table
from .graph import components
from .text import mix, narrow, owners, pack_columns, parts, release, slices, split_by, unpack_columns, word_hashes

WORDS, THRESHOLD = 5, 80  # shingle length; least similarity in hundredths
GROUP = 4_000_000  # postings that one task searches at once
PART = 1_000_000  # postings of a part, on average; a task unpacks one part at a time
CHUNK = 1_500_000  # shingles a task gathers before it sends them on
AGREE = 10  # linked sets share one in so many of their shingles among their prefixes
MARKS = 28  # the marks of texts are 2 ** MARKS bits at most (32 MB); with more texts, more pass that need not
MU = 0.0085  # cost of merging against probing, in DivideSkip's choice of long lists
_STEP = np.uint64(0x9E3779B97F4A7C15)
_DIGEST = "__digest"
# Columns of what is sent packed.
_POSTING = {"key": np.uint64, "sig": np.int64, "n": np.int32}
_HALF = {"key": np.uint32, "sig": np.int64}
_LISTED = {"sig": np.int64, "n": np.int32, "key": np.uint64, "df": np.int32}


def required(size: int, threshold: int = THRESHOLD) -> int:
    """The least overlap that a partner of a set of this size must have."""
    return -(-size * threshold // 100)


def agreed(size):
    """Shingles that linked sets, the lesser of this size, share among their prefixes at least."""
    return 1 + size // AGREE


def prefix(size, threshold: int = THRESHOLD):
    """Length of a set's prefix.

    Linked sets x and y share T(x) and T(y) shingles or more, so x lacks at most
    |x| - T(x) of its own in y.  The first k shared ones in any common order are
    then among the first |x| - T(x) + k of x, and likewise of y.
    """
    return size - required(size, threshold) + agreed(size)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS):
    """Distinct shingle hashes of each text and the range of each; sorted within a text."""
    hashes, places = word_hashes(data, offsets)
    n = np.diff(places)
    own = owners(places)
    window = hashes.copy()
    reach = len(hashes) - words + 1
    for j in range(1, words):
        if reach > 0:
            window[:reach] = mix(window[:reach] * _STEP + hashes[j : j + reach])
    at = np.arange(len(hashes))
    whole = at + words <= places[1:][own] if len(hashes) else np.zeros(0, bool)
    keys, texts = window[whole], own[whole]
    short = np.flatnonzero((n > 0) & (n < words))
    few = np.zeros(len(short), np.uint64)
    for i, text in enumerate(short.tolist()):
        value = np.array([n[text]], np.uint64)
        for h in hashes[places[text] : places[text + 1]]:
            value = mix(value * _STEP + h)
        few[i] = value[0]
    keys, texts = np.concatenate([keys, few]), np.concatenate([texts, short])
    order = np.lexsort((keys, texts))
    keys, texts = keys[order], texts[order]
    if len(keys):
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (texts[1:] != texts[:-1])
        keys, texts = keys[new], texts[new]
    return keys, np.searchsorted(texts, np.arange(len(offsets)))


def signatures(keys: np.ndarray, ranges_: np.ndarray) -> np.ndarray:
    """One 64-bit number a set (0 for an empty one), equal for equal sets."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(keys), dtype=np.uint64)])
    sizes = np.diff(ranges_)
    out = mix(sums[ranges_[1:]] - sums[ranges_[:-1]] + sizes.astype(np.uint64) * _STEP)
    return np.where(sizes > 0, out | np.uint64(1), np.uint64(0)).view(np.int64)


def set_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n_shingles, sig, digest (of the text)."""

    def run(batches):
        for batch in batches:
            sizes, sigs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, data, offsets in slices(batch.column(1)):
                keys, places = shingle_sets(data, offsets)
                sizes.append(np.diff(places))
                sigs.append(signatures(keys, places))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(sizes), pa.int64()), pa.array(np.concatenate(sigs), pa.int64()), batch.column(2)],
                ["id", "n_shingles", "sig", "digest"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("digest"))
    return texts.mapInArrow(run, f"id {kind}, n_shingles bigint, sig bigint, digest bigint")


def part_count(spark, postings_: int, part: int | None = None) -> int:
    """Parts of the inverted lists: their number grows with the postings, so a part does not."""
    return max(parts(spark), -(-postings_ // (part or PART)))


def _rows(parts_) -> pa.RecordBatch:
    keys, blobs = [], []
    for key, arrays in parts_:
        keys.append(key)
        blobs.append(pack_columns(arrays))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(blobs, pa.binary())], ["part", "data"])


def packed_sets(texts: DataFrame, count: int, columns, known=None, first=None) -> DataFrame:
    """``columns(keys, sigs, sizes)`` of all texts, packed by the shingle's part; equal sets of a task once.

    ``texts`` has the text, then its digest.  With ``known`` marks only texts whose digest they hold, with ``first`` only as
    many shingles of a set of a size as it says, the least ones.
    """

    def run(batches):
        seen: set[int] = set()
        held, size = [], 0

        def flush():
            keys, sigs, sizes = (np.concatenate(x) for x in zip(*held))
            return _rows(split_by((keys >> np.uint64(33)).astype(np.int64) % count, count, columns(keys, sigs, sizes)))

        for batch in batches:
            if known is not None:
                batch = batch.filter(pa.array(marked(known.value, batch.column(1).to_numpy())))
            for _, _, data, offsets in slices(batch.column(0)):
                keys, places = shingle_sets(data, offsets)
                sigs, sizes = signatures(keys, places), np.diff(places)
                new = np.zeros(len(sigs), bool)
                for i in np.flatnonzero(sizes).tolist():
                    if sigs[i] not in seen:
                        seen.add(sigs[i])
                        new[i] = True
                use = np.repeat(new, sizes)
                if first is not None:
                    use &= np.arange(len(keys)) - np.repeat(places[:-1], sizes) < np.repeat(first(sizes), sizes)
                held.append((keys[use], np.repeat(sigs, sizes)[use], np.repeat(sizes, sizes)[use].astype(np.int32)))
                size += len(held[-1][0])
                if size > CHUNK:
                    yield flush()
                    held, size, seen = [], 0, set()
        if size:
            yield flush()
            held.clear()
            release()

    return texts.mapInArrow(run, "part int, data binary")


def postings(texts: DataFrame, count: int, known=None) -> DataFrame:
    """(shingle, set, set size) of the texts (of those with known digests)."""
    return packed_sets(texts, count, lambda keys, sigs, sizes: {"key": keys, "sig": sigs, "n": sizes}, known)


def prefix_postings(texts: DataFrame, count: int, threshold: int = THRESHOLD) -> DataFrame:
    """(half a shingle's hash, set) of the prefixes of all texts."""

    def columns(keys, sigs, sizes):
        return {"key": keys.astype(np.uint32), "sig": sigs}

    return packed_sets(texts, count, columns, first=lambda size: prefix(size, threshold))


def shared_prefixes(packed: DataFrame) -> DataFrame:
    """(sig, shared): how many shingles of each set's prefix other prefixes hold.

    A number may be too high, never too low: shingles of a part may have the lower half of their hash in common, and a set
    that came from two tasks counts twice.
    """

    def run(group: pa.Table) -> pa.Table:
        x = unpack_columns(group.column("data").to_pylist(), _HALF)
        order = np.lexsort((x["sig"], x["key"]))
        key, sig = x.pop("key")[order], x.pop("sig")[order]
        del order
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        lengths = np.diff(np.append(starts, len(key)))
        sigs, shared = np.unique(sig[np.repeat(sig[starts] != sig[starts + lengths - 1], lengths)], return_counts=True)
        out = pa.Table.from_arrays([pa.array(sigs, pa.int64()), pa.array(shared, pa.int64())], ["sig", "shared"])
        del key, sig, starts, lengths, sigs, shared
        release()
        return out

    return packed.groupBy("part").applyInArrow(run, "sig bigint, shared bigint").groupBy("sig").agg(F.sum("shared").alias("shared"))


def marks(digests: DataFrame, rows: int) -> np.ndarray:
    """A bit for the leading digits of each digest; as many bits as suit the rows, 2 ** MARKS at most."""
    width = min(MARKS, max(15, (16 * rows).bit_length()))
    place = F.shiftrightunsigned("digest", 64 - width) + 1
    blocks = digests.groupBy(F.bitmap_bucket_number(place).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros((1 << (width - 15), 4096), np.uint8)
    for row in blocks.collect():
        out[row.block - 1] = np.frombuffer(row.bits, np.uint8)
    return out.ravel()


def marked(bits: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Whether the bit of each digest is set; it is for all that were marked."""
    width = (8 * len(bits)).bit_length() - 1
    place = (digests.view(np.uint64) >> np.uint64(64 - width)).astype(np.int64)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def shared_lists(packed: DataFrame, count: int) -> DataFrame:
    """(set, size, shingle, list length) of every list with two sets or more, packed by the set's part."""

    def run(group: pa.Table) -> pa.Table:
        x = unpack_columns(group.column("data").to_pylist(), _POSTING)
        order = np.lexsort((x["sig"], x["key"]))
        key, sig, n = (x.pop(name)[order] for name in ("key", "sig", "n"))
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])
        key, sig, n = key[new], sig[new], n[new]
        del order, new
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        which = np.cumsum(first) - 1
        length = np.bincount(which)[which]
        use = length > 1
        arrays = {"sig": sig[use], "n": n[use], "key": key[use], "df": length[use].astype(np.int32)}
        out = pa.Table.from_batches([_rows(split_by(arrays["sig"] % count, count, arrays))])
        del key, sig, n, first, which, length, use, arrays
        release()
        return out

    return packed.groupBy("part").applyInArrow(run, "part int, data binary")


def candidates(lists: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Sets that occur in enough lists: sig, n, keys (rarest first, then by hash), and how many of them are probed first."""

    def run(group: pa.Table) -> pa.Table:
        x = unpack_columns(group.column("data").to_pylist(), _LISTED)
        order = np.lexsort((x["key"], x["df"], x["sig"]))
        sig, n, key = x["sig"][order], x["n"][order], x["key"][order]
        starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        lengths = np.diff(np.append(starts, len(sig)))
        need = -(-n[starts].astype(np.int64) * threshold // 100)
        out = [
            (int(sig[s]), int(n[s]), key[s : s + size].tobytes(), int(size - t + 1))
            for s, size, t in zip(starts.tolist(), lengths.tolist(), need.tolist())
            if size >= t
        ]
        columns = list(zip(*out)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int32())
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["sig", "n", "keys", "first"])

    return lists.groupBy("part").applyInArrow(run, "sig bigint, n int, keys binary, first int")


def star_edges(sets: DataFrame) -> DataFrame:
    """(a, b): each set and the least set of every list among its rarest shingles."""

    def run(batches):
        for batch in batches:
            sigs, keys = [], []
            for sig, data, first in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = np.frombuffer(data, np.int64)[:first]
                keys.append(own)
                sigs.append(np.full(len(own), sig, np.int64))
            empty = [np.zeros(0, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(empty + keys)), pa.array(np.concatenate(empty + sigs))], ["key", "sig"])

    rare = stage(narrow(sets, "sig", "keys", "first").mapInArrow(run, "key bigint, sig bigint"), "rare")
    least = rare.groupBy("key").agg(F.min("sig").alias("a"), F.max("sig").alias("high")).where("a < high")
    return rare.join(least, "key").where("a <> sig").select("a", F.col("sig").alias("b")).distinct()


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)


def search(sizes: np.ndarray, sets: list[np.ndarray], side: np.ndarray | None = None, threshold: int = THRESHOLD) -> Forest:
    """Links among the sets (sorted keys each) by DivideSkip, as a forest.

    With ``side``, only sets of different sides are compared.
    """
    forest = Forest(len(sets))
    keys = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    own = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.lexsort((own, keys))
    keys, own = keys[order], own[order]
    distinct = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    names, ends = keys[distinct], np.append(distinct[1:], len(keys))
    for x, mine in enumerate(sets):
        t = required(int(sizes[x]), threshold)
        at = np.searchsorted(names, mine)
        lists = sorted((own[a:b] for a, b in zip(distinct[at].tolist(), ends[at].tolist()) if b - a > 1), key=len)
        if len(lists) < t:
            continue
        longest = len(lists[-1])
        aside = min(t - 1, int(t / (MU * np.log2(longest + 1) + 1)))
        short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
        found, count = np.unique(np.concatenate(short), return_counts=True)  # merged: each set with its occurrences
        found, count = found[count >= t - aside], count[count >= t - aside]
        keep = found < x
        if side is not None:
            keep &= side[found] != side[x]
        least = -(-(sizes[x] + sizes[found]) * threshold // (100 + threshold))
        keep &= (count + aside >= least) & (100 * np.minimum(sizes[x], sizes[found]) >= threshold * np.maximum(sizes[x], sizes[found]))
        found, count, least = found[keep], count[keep], least[keep]
        best = np.argsort(-count, kind="stable")
        for i in best.tolist():
            y = int(found[i])
            if forest.find(x) == forest.find(y):
                continue
            overlap, left = int(count[i]), len(long)
            for entry in long:  # probe the long lists
                if overlap + left < least[i]:
                    break
                left -= 1
                place = int(np.searchsorted(entry, y))
                overlap += place < len(entry) and entry[place] == y
            if overlap >= least[i]:
                forest.join(x, y)
    return forest


def links(sets: DataFrame, edges: DataFrame, count: int, group: int = GROUP) -> DataFrame:
    """(a, b) edges that connect exactly the linked sets."""
    roots = components(edges).select(F.col("node").alias("sig"), "root")
    placed = stage(narrow(sets, "sig", "n", "keys").join(roots, "sig"), "placed")
    sizes = placed.groupBy("root").agg(F.sum(F.length("keys") / 8).alias("postings"))
    cut = sizes.select("root", F.ceil(2 * F.col("postings") / group).cast("int").alias("blocks"))
    rows = placed.join(cut, "root").withColumn("block", F.when(F.col("blocks") <= 2, 0).otherwise(F.pmod(F.xxhash64("sig"), "blocks")).cast("int"))
    # A set of a cut component goes to every pair of blocks with its own.
    pairs = F.when(F.col("blocks") <= 2, F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", F.explode(pairs)).withColumn(
        "task", F.when(F.col("other") < 0, F.pmod(F.xxhash64("root"), F.lit(4 * count))).otherwise(F.lit(-1)).cast("int")
    )
    low, high = F.least("block", "other"), F.greatest("block", "other")
    rows = rows.select("sig", "n", "keys", "root", "block", "task", F.when(F.col("other") < 0, -1).otherwise(low).alias("low"), F.when(F.col("other") < 0, -1).otherwise(high).alias("high"))
    lone = F.when(F.col("task") < 0, F.col("root")).otherwise(F.lit(0)).alias("apart")

    def run(batch: pa.Table) -> pa.Table:
        batch = batch.sort_by([("root", "ascending"), ("sig", "ascending")])
        root, sig = batch.column("root").to_numpy(), batch.column("sig").to_numpy()
        n, block = batch.column("n").to_numpy().astype(np.int64), batch.column("block").to_numpy()
        keys, apart = batch.column("keys").to_pylist(), batch.column("low").to_numpy() != batch.column("high").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], root[1:] != root[:-1]]))
        a, b = [], []
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(root)]):
            sets_ = [np.sort(np.frombuffer(k, np.uint64)) for k in keys[s:e]]
            forest = search(n[s:e], sets_, block[s:e] if apart[s] else None)
            for i in range(e - s):
                top = forest.find(i)
                if top != i:
                    a.append(int(sig[s + top]))
                    b.append(int(sig[s + i]))
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.select("*", lone).groupBy("task", "apart", "low", "high").applyInArrow(run, "a bigint, b bigint")


def possible(own: DataFrame, texts: DataFrame, threshold: int = THRESHOLD) -> tuple[DataFrame, int]:
    """(sig, n, digest) of the sets that may have a partner, and the parts that suit the prefixes."""
    spark = own.sparkSession
    length = F.expr(f"n_shingles - (n_shingles * {threshold} + 99) div 100 + 1 + n_shingles div {AGREE}")
    count = part_count(spark, own.where("n_shingles > 0").agg(F.sum(length)).first()[0] or 0)
    shared = shared_prefixes(prefix_postings(texts, count, threshold))
    # A partner has T shingles at least.
    enough = F.expr(f"shared >= 1 + (n * {threshold} + 99) div 100 div {AGREE}")
    sets = own.where("n_shingles > 0").select("sig", F.col("n_shingles").alias("n"), "digest").distinct()
    return stage(sets.join(shared, "sig").where(enough).select("sig", "n", "digest"), "possible"), count


def classed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The set table, and (sig, low, root): each set, its least id, and the set that stands for its component."""
    spark = docs.sparkSession
    own = stage(set_table(docs, id_col, text_col), "sets")
    texts = docs.select(docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("digest"))
    some, count = possible(own, texts)
    size = some.select("sig", "n").distinct().agg(F.sum("n")).first()[0] or 0
    count = max(count, part_count(spark, size))
    known = spark.sparkContext.broadcast(marks(some, some.count()))
    near = stage(candidates(shared_lists(postings(texts, count, known), count)), "candidates")
    known.unpersist()
    found = stage(links(near, stage(star_edges(near), "stars"), count), "links")
    roots = components(found)
    least = own.where("n_shingles > 0").groupBy("sig").agg(F.min("id").alias("low"))
    return own, stage(least.join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig")), "classes")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, n_shingles, component (the least id reachable by links)."""
    own, joined = classed(docs, id_col, text_col)
    lowest = joined.groupBy("root").agg(F.min("low").alias("component"), F.count("*").alias("sets"))
    linked = joined.join(lowest.where("sets > 1").drop("sets"), "root", "left")
    classes = linked.select("sig", F.coalesce("component", "low").alias("component"))
    return own.join(classes, "sig", "left").select("id", "n_shingles", F.coalesce("component", "id").alias("component"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the least id, null last (of rows that repeat it, one).

    A row is known by its id and a digest of its text, so rows of one id in different components do not meet.
    """
    own, joined = classed(docs, id_col, text_col)
    rows = own.where("n_shingles > 0").join(joined.select("sig", "root"), "sig").groupBy("root", "id", "digest").agg(F.count("*").alias("n"))
    rows = stage(rows, "rows")
    best = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "digest")).alias("best"), F.count("*").alias("rows"))
    best = best.where("rows > 1").select("root", F.col("best")["id"].alias("best_id"), F.col("best")["digest"].alias("best_digest"))
    gone = rows.join(best, "root").where(~(F.col("id").eqNullSafe(F.col("best_id")) & (F.col("digest") == F.col("best_digest"))))
    again = stage(rows.where("n > 1").select("id", "digest"), "again")
    marked = docs.withColumn(_DIGEST, F.xxhash64(docs[text_col]))

    def same(other: DataFrame):
        return marked[id_col].eqNullSafe(other["id"]) & (marked[_DIGEST] == other["digest"])

    # Staged, their size is known: few rows are broadcast and no text moves.
    gone = stage(gone.select("id", "digest"), "gone")
    marked = marked.join(gone, same(gone), "left_anti")
    if again.isEmpty():
        return marked.select(*docs.columns)
    twice = marked.join(again, same(again), "left_semi").dropDuplicates([id_col, _DIGEST])
    return marked.join(again, same(again), "left_anti").unionByName(twice).select(*docs.columns)


@query("op7_jaccard_join")
def op7_jaccard_join(spark, sf_dir):
    groups = near_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))
