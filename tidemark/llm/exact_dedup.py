"""Exact duplicates by a heavy-hitter split.

Misra-Gries summaries of each task find the digests that may be frequent; at
most ``heavy`` of them pass the merged bound.  Their size and winner are then
counted exactly and broadcast (never more than ``heavy`` rows), so rows of a
frequent text are settled where they lie.  All other digests are shuffled.

Cases: null equals the empty text; texts are equal after lowering A-Z; of
equal texts the largest id stays (null ids lose), and of rows that repeat both
id and text exactly one stays; an empty table gives an empty result; columns
besides the id and the text never matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

from .catalog import query, table
from .text import narrow, slices

HEAVY = 1024  # frequent digests at most; also the counters of a task's summary
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns id, digest (SHA-256 of the lowered text)."""

    def run(batches):
        for batch in batches:
            out = []
            for _, _, data, offsets in slices(batch.column(1)):
                lowered = memoryview(_LOWER[data])
                out += [hashlib.sha256(lowered[a:b]).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "digest"])

    kind = docs.schema[id_col].dataType.simpleString()
    return narrow(docs, id_col, text_col).mapInArrow(run, f"id {kind}, digest binary")


def misra_gries(rows: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """At most ``heavy`` digests; every digest with at least 2 / heavy of all rows is among them.

    A task's counters miss at most rows / (heavy + 1) of a digest, so a digest
    whose summed counters reach rows / heavy is kept; the counters sum to no
    more than all rows, which bounds their number.
    """

    def run(batches):
        counters: dict[bytes, int] = {}
        for batch in batches:
            for digest in batch.column(0).to_pylist():
                if digest in counters:
                    counters[digest] += 1
                elif len(counters) < heavy:
                    counters[digest] = 1
                else:
                    counters = {k: v - 1 for k, v in counters.items() if v > 1}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counters), pa.binary()), pa.array(list(counters.values()), pa.int64())], ["digest", "n"]
        )

    least = max(rows.count(), 2 * heavy) / heavy
    found = rows.select("digest").mapInArrow(run, "digest binary, n bigint").groupBy("digest").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= least).select("digest")


def winners(rows: DataFrame) -> DataFrame:
    """Size and surviving row of each digest; ``rows`` has id, digest, row."""
    return rows.groupBy("digest").agg(
        F.count("*").alias("group_size"),
        F.max(F.struct(F.col("id").isNotNull().alias("known"), "id", "row")).alias("best"),
    ).select("digest", "group_size", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """One row per input row: id, digest, keep_id, group_size, kept."""
    rows = stage(digests(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "digests")
    frequent = stage(misra_gries(rows, heavy), "frequent")
    hot = rows.join(F.broadcast(frequent), "digest", "left_semi")
    verified = stage(winners(hot), "winners")
    settled = rows.join(F.broadcast(verified), "digest")
    rest = rows.join(F.broadcast(frequent), "digest", "left_anti")
    shuffled = rest.join(winners(rest), "digest")
    columns = ["id", "digest", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept")]
    return settled.select(*columns).unionByName(shuffled.select(*columns))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    groups = exact_groups(docs, id_col, text_col, heavy)
    lost = groups.where(~F.col("kept")).groupBy("id").agg(F.count("*").alias("lost"))
    own = groups.where("kept").groupBy("id").agg(F.count("*").alias("kept"))
    fate = stage(lost.join(own, "id", "full"), "fate")
    # Staged, their size is known: few ids are broadcast and no text moves.
    gone = stage(fate.where(F.col("kept").isNull() & F.col("id").isNotNull()).select(F.col("id").alias(id_col)), "gone")
    # An id both kept and lost (rows repeated whole, or ids used twice) is decided row by row.
    mixed = stage(fate.where("kept IS NOT NULL AND lost IS NOT NULL OR id IS NULL OR kept > 1").select(F.col("id").alias(id_col)), "mixed")
    plain = docs.join(gone, id_col, "left_anti")
    if mixed.isEmpty():
        return plain.select(*docs.columns)
    marked = mixed.withColumn("__mixed", F.lit(True))
    key = F.sha2(F.translate(F.coalesce(F.col(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), 256)
    both = plain.join(marked, plain[id_col].eqNullSafe(marked[id_col]), "left").drop(marked[id_col])
    clear = both.where("__mixed IS NULL").select(*docs.columns)
    best = groups.where("kept").select(F.col("id").alias("__id"), F.lower(F.hex("digest")).alias("__key"))
    odd = both.where("__mixed").withColumn("__key", key)
    odd = odd.join(best, (F.col(id_col).eqNullSafe(F.col("__id"))) & (odd["__key"] == best["__key"]), "left_semi")
    return clear.unionByName(odd.dropDuplicates([id_col, "__key"]).select(*docs.columns))


SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)"""


@query("op8_exact_dedup", SQL)
def op8_exact_dedup(spark, sf_dir):
    groups = exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )
