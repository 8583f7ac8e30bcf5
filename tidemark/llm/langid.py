"""Language by hierarchical discrimination.

A linear support vector machine a family decides the language family; within
it one-versus-one machines separate the related languages, and the language
that wins most pairs (then has the largest summed margin) is the answer.  All
machines see the same features, relative frequencies of hashed byte trigrams
(A-Z lowered), so a whole text is scored by one table look-up a byte.

Fitting uses a bounded sample: about ``per_language`` labelled rows a language
(fewer if there are many languages), chosen by a hash of the id.  Languages
without a listed family are families of their own.

Cases: null texts and texts without a letter are ``und`` with score 0; texts
that hold letters but no whole trigram are padded with spaces; ties go to the
first language by name; without any labelled row all texts are ``und``; an
empty table gives an empty table; further columns never matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import query, table
from .text import narrow, slices, sums_by_text

FAMILIES = {
    "germanic": ("de", "en", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "pl", "cs", "uk", "bg", "sk", "hr", "sr", "sl"),
    "uralic": ("fi", "et", "hu"),
}
DIMENSIONS = 4096
PER_LANGUAGE, ALTOGETHER = 1000, 8000  # rows of the fitting sample
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32


def family_of(lang: str) -> str:
    return next((name for name, langs in FAMILIES.items() if lang in langs), lang)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature number of every trigram of the texts, each with a space on both sides."""
    n = len(offsets) - 1
    wide = np.full(len(data) + 2 * n, 32, dtype=np.uint32)
    room = offsets + 2 * np.arange(n + 1)
    wide[np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, np.diff(offsets))] = _FOLD[data]
    code = wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA77) + wide[2:] * np.uint32(0xC2B2AE3D)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    code >>= np.uint32(32 - DIMENSIONS.bit_length() + 1)
    inside = np.ones(len(wide), dtype=bool)
    inside[room[1:] - 1] = False
    inside[room[1:] - 2] = False
    return code[inside[: len(code)]].astype(np.int32), offsets


def _frequencies(column) -> np.ndarray:
    rows = []
    for _, _, data, offsets in slices(column):
        codes, places = trigrams(data, offsets)
        for a, b in zip(places[:-1].tolist(), places[1:].tolist()):
            rows.append((np.bincount(codes[a:b], minlength=DIMENSIONS) / max(1, b - a)).astype(np.float32))
    return np.array(rows, dtype=np.float32).reshape(-1, DIMENSIONS)


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Labelled rows with text, about ``per_language`` of each language by a hash of the id."""
    rows = docs.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
    sizes = rows.groupBy(lang_col).count()
    few = F.least(F.lit(per_language), F.floor(F.lit(ALTOGETHER) / F.greatest(F.lit(1), F.count("*").over(_all()))))
    share = sizes.select(F.col(lang_col).alias("__lang"), (few / F.col("count")).alias("__share"))
    place = F.pmod(F.xxhash64(F.col(id_col), F.lit("language")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (
        rows.join(F.broadcast(share), rows[lang_col] == F.col("__lang"))
        .where(place < F.col("__share"))
        .select(F.col("__lang").alias("lang"), F.col(text_col).alias("text"))
    )


def _all():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(1))


def svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, passes: int = 30) -> np.ndarray:
    """Linear SVM (hinge loss, last weight is the bias) by dual coordinate descent in a fixed order."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    square = np.maximum(np.einsum("ij,ij->i", x, x), 1e-12)
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1], dtype=x.dtype)
    order = np.random.default_rng(7)
    for _ in range(passes):
        moved = 0.0
        for i in order.permutation(len(x)):
            gradient = y[i] * (x[i] @ w) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            if new != alpha[i]:
                w += x.dtype.type((new - alpha[i]) * y[i]) * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


class Model:
    """Weights of all machines: one column a family, then one a pair of languages of a family."""

    def __init__(self, langs: list[str], x: np.ndarray, y: np.ndarray):
        self.langs = langs
        self.families = sorted({family_of(lang) for lang in langs})
        self.members = {f: [lang for lang in langs if family_of(lang) == f] for f in self.families}
        self.pairs = [(a, b) for f in self.families for i, a in enumerate(self.members[f]) for b in self.members[f][i + 1 :]]
        scale = 1 / np.sqrt(x.mean(axis=0) + 1e-5)
        x = x * scale.astype(np.float32)
        names = np.array(langs)[y]
        families = np.array([family_of(n) for n in names])
        columns = [svm(x, np.where(families == f, 1.0, -1.0)) for f in self.families] if len(self.families) > 1 else []
        for a, b in self.pairs:
            own = (names == a) | (names == b)
            columns.append(svm(x[own], np.where(names[own] == a, 1.0, -1.0)))
        weights = np.array(columns).reshape(-1, DIMENSIONS + 1).T
        self.table = (weights[:-1] * scale[:, None]).astype(np.float32)
        self.bias = weights[-1]

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        codes, places = trigrams(data, offsets)
        size = np.maximum(np.diff(places), 1)
        return sums_by_text(self.table[codes], places) / size[:, None] + self.bias

    def predict(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language number and confidence of each row."""
        n, many = len(margins), len(self.families) > 1
        chosen = margins[:, : len(self.families)].argmax(axis=1) if many else np.zeros(n, dtype=int)
        sure = np.ones(n)
        if many:
            top = np.sort(margins[:, : len(self.families)], axis=1)
            sure = 1 / (1 + np.exp(-np.clip(top[:, -1] - top[:, -2], 0, 30)))
        best, score = np.zeros(n, dtype=int), np.zeros(n)
        shift = len(self.families) if many else 0
        for f, family in enumerate(self.families):
            rows, langs = np.flatnonzero(chosen == f), self.members[family]
            wins, total, least = (np.zeros((len(rows), len(langs))) for _ in range(3))
            least += 30
            for p, (a, b) in enumerate(self.pairs):
                if a in langs:
                    m, i, j = margins[rows, shift + p], langs.index(a), langs.index(b)
                    for k, signed in ((i, m), (j, -m)):
                        wins[:, k] += signed > 0
                        total[:, k] += signed
                        least[:, k] = np.minimum(least[:, k], signed)
            pick = (wins + np.tanh(total / 10) / 4).argmax(axis=1)
            best[rows] = np.array([self.langs.index(x) for x in langs])[pick]
            score[rows] = sure[rows] / (1 + np.exp(-np.clip(least[np.arange(len(rows)), pick], -30, 30)))
        return best, score


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """The machines, or None if no row is labelled.  The sample's features come to the driver; their size is bounded."""

    def run(batches):
        for batch in batches:
            x = _frequencies(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.astype(np.float16).tobytes() for r in x], pa.binary())], ["lang", "x"]
            )

    rows = sample(docs, id_col, text_col, lang_col).mapInArrow(run, "lang string, x binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.lang, r.x))
    langs = sorted({r.lang for r in rows})
    x = np.array([np.frombuffer(r.x, dtype=np.float16) for r in rows], dtype=np.float32)
    return Model(langs, x, np.array([langs.index(r.lang) for r in rows]))


def classify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns id, lang_pred, score."""
    ascii_letter = np.zeros(256, dtype=bool)
    ascii_letter[[*range(65, 91), *range(97, 123)]] = True

    def run(batches):
        for batch in batches:
            names, scores = [], []
            for _, _, data, offsets in slices(batch.column(1)):
                if model is None:
                    names += ["und"] * (len(offsets) - 1)
                    scores.append(np.zeros(len(offsets) - 1))
                    continue
                seen = np.concatenate([[0], np.cumsum(ascii_letter[data])])
                lettered = seen[offsets[1:]] > seen[offsets[:-1]]
                for i in np.flatnonzero(~lettered & (np.diff(offsets) > 0)):
                    lettered[i] = any(map(str.isalpha, data[offsets[i] : offsets[i + 1]].tobytes().decode()))
                best, score = model.predict(model.margins(data, offsets))
                names += [model.langs[b] if ok else "und" for b, ok in zip(best.tolist(), lettered.tolist())]
                scores.append(np.where(lettered, score, 0.0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                [id_col, "lang_pred", "score"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return narrow(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """Rows never learned from: crc32 of the id's decimal text is divisible by 5."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0


@query("op9_language")
def op9_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    found = classify(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
