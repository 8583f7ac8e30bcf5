"""Personal data by weak supervision.

Strict patterns give the base spans, looser ones further candidates.  Five
labelers - base rule, format, gazetteer, context, surroundings - vote for,
against or abstain on each candidate.  Only the counts of vote patterns and span traits leave
the tasks (at most kinds x 3**5 votes x 8 lengths x 4 x 4 neighbours x 3 x 3 mixtures of characters, whatever the corpus);
expectation-maximisation over them estimates how reliable each labeler's votes are on true and on false spans, and the
share of true spans among base and other candidates of each kind.  A labeler that abstains says nothing; one is
taken to be no worse than chance: where its votes for would be likelier on false spans, both rates become
their mean.  The posteriors train a logistic span classifier on the votes of the four fallible labelers and on the
span's own traits - its length, what stands around it, its share of digits and of separators.
Base spans always stay; the classifier decides on the others.

Offsets are code points, ends exclusive; a kind's spans never overlap.

Cases: null and empty texts have no spans; patterns run in time linear in the
text, so very long digit or letter runs are no trap; rows that repeat are
annotated each; an empty table gives an empty table and the base rules; columns
besides the text are passed through by ``mask``.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import query, table
from .text import narrow, slices, text_array

KINDS = ("email", "ip", "card", "phone")
ADDED_AT = 0.9  # probability from which a span outside the base rules is added
ROUNDS = 50
BASE_RATES = (0.2, 0.98)  # of votes for, on false and on true spans, that the base rule is taken to have
RIDGE = 0.1
LENGTHS, CLASSES, THIRDS = 8, 4, 3

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPELLED = re.compile(r"[\x20]?[(\[]at[)\]][\x20]?[A-Za-z0-9-]+(?:[\x20]?(?:[(\[]dot[)\]]|\.)[\x20]?[A-Za-z0-9-]+)+", re.I)
_NATIONAL = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9])")
_IP6 = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])")
# Mail domains, top-level domains, calling codes, first digits of cards, first groups of assigned addresses.
_MAIL_WORDS = ("mail", "example", "post", "inbox", "web", "yahoo", "outlook", "proton", "icloud", "gmx")
_TOP_LEVEL = frozenset(
    "com org net edu gov mil int info biz io co me tv app dev ai us uk ca au de fr es it nl be ch at pl pt se no dk fi ie cz hu"
    " gr ro ru ua cn jp kr in br mx ar cl nz za eu test example local".split()
)
_ASSIGNED = ("2001", "2400", "2404", "2406", "2600", "2604", "2606", "2607", "2620", "2800", "2a", "fc", "fd", "fe80")
_CALLING_CODES = ("+1", "+33", "+34", "+39", "+41", "+43", "+44", "+49", "+52", "+54", "+61", "+81", "+86", "+91")
_CARD_HEADS = ("34", "35", "36", "37", "38", "4", "5", "6", "22", "23", "24", "25", "26", "27")
_FOR = {
    "email": re.compile(r"mail|contact|write|kontakt|contacto|courriel|correo", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|login|adresse|servidor", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|karte|carte|tarjeta|pay", re.I),
    "phone": re.compile(r"tel|phone|call|mobile|fax|anruf|appel|llam", re.I),
}
_AT, _DOT = re.compile(r"[(\[]at[)\]]", re.I), re.compile(r"[\x20]?[(\[]dot[)\]][\x20]?", re.I)
_AGAINST_MAIL = re.compile(r"\b(?:see|section|page|chapter|figure|table|meet|met|room|line|version|release|look|stand|arrive)\b", re.I)
_AGAINST = re.compile(r"version|release|isbn|issn|invoice|order|serial|\bv\.?\s*$|#\s*$|\bid\b", re.I)
_SEEN = np.zeros(256, dtype=bool)
_SEEN[[*range(48, 58), 64, 40, 91]] = True  # digits, @ and the brackets of spelled-out addresses


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        value = int(c) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their @ outwards."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            out.append((start, found.end()))
        done = found.end() if found else at + 1
        at = text.find("@", done)
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    ips = []
    for run in _DOTTED.finditer(text):
        if run.group().count(".") >= 3:
            ips += [m.span() for m in _IP.finditer(text, run.start(), run.end())]
    ips = [(a, b) for a, b in ips if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text[a:b].split("."))]
    cards = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
    phones = [m.span() for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return {"email": emails(text), "ip": ips, "card": cards, "phone": phones}


def loose_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    spelled = []
    for m in _SPELLED.finditer(text) if "(" in text or "[" in text else ():
        start = m.start()
        while start > 0 and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            spelled.append((start, m.end()))
    short = []
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 15 and luhn(digits):
            short.append(m.span())
    return {
        "email": spelled,
        "ip": [m.span() for m in _IP6.finditer(text)] if text.count(":") >= 7 else [],
        "card": short,
        "phone": [m.span() for m in _NATIONAL.finditer(text)],
    }


def votes(text: str, kind: str, start: int, end: int, base: bool) -> tuple[int, ...]:
    """One vote of each labeler: 1 for, -1 against, 0 abstains."""
    span = text[start:end]
    before, after = text[max(0, start - 24) : start], text[end : end + 24]
    digits = "".join(c for c in span if c.isdigit())
    against = _AGAINST
    if kind == "email":
        plain = _DOT.sub(".", span)
        local, domain = plain.rsplit("@", 1) if "@" in plain else _AT.split(plain, maxsplit=1)
        domain = domain.strip().lower()
        shape = 1 if domain.rpartition(".")[2] in _TOP_LEVEL else -1
        known = 1 if any(w in domain for w in _MAIL_WORDS) else 0
        before_local, against = f"{before} {local.strip()}", _AGAINST_MAIL
    elif kind == "ip" and ":" in span:
        groups = span.lower().split(":")
        shape = -1 if all(g.isdigit() and len(g) <= 2 for g in groups) else 1
        known = 1 if span.lower().startswith(_ASSIGNED) else 0
    elif kind == "ip":
        parts = span.split(".")
        shape = 1 if len(parts) == 4 and all(str(int(p)) == p for p in parts if p.isdigit() and len(p) < 9) else 0
        known = -1 if parts[0] in ("0", "00", "000") else 1 if parts[0] in ("10", "172", "192") else 0
    elif kind == "card":
        grouped = r"[0-9]+|(?:[0-9]{4}[ -]?)+|[0-9]{4}[ -]?[0-9]{6}[ -]?[0-9]{4,5}"
        shape = 1 if re.fullmatch(grouped, span) else -1
        heads = {15: ("34", "37"), 14: ("30", "36", "38"), 13: ("4",)}.get(len(digits), _CARD_HEADS)
        known = 1 if digits.startswith(heads) else -1
    elif span.startswith("+"):
        shape = 1 if re.search(r"\([0-9]{1,4}\)|[0-9][ .-][0-9]", span) else 0
        known = 1 if span.startswith(_CALLING_CODES) else 0
    else:  # a national number: no area begins with 0 or 1
        shape, known = (1, 0) if digits[0] > "1" else (-1, -1)
    around = before_local if kind == "email" else before
    context = -1 if against.search(around) else 1 if _FOR[kind].search(before) or _FOR[kind].search(after) else 0
    touching = before[-1:].isalnum() or after[:1].isalnum() or before[-1:] in ("=", "_") or before[-1:] == "."
    return (1 if base else 0, shape, known, context, -1 if touching else 1)


def _class(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isalpha() else 2 if c.isdigit() else 3


def traits(text: str, start: int, end: int) -> tuple[int, ...]:
    """Length class, kinds of the characters before and behind, and thirds of digits and of separators."""
    span = text[start:end]
    digits, letters = sum(c.isdigit() for c in span), sum(c.isalpha() for c in span)
    size = max(1, end - start)
    return (
        min(size // 8, LENGTHS - 1), _class(text[start - 1 : start]), _class(text[end : end + 1]),
        min(2, 3 * digits // size), min(2, 6 * (size - digits - letters) // size),
    )


def candidates(text: str) -> list[tuple[int, int, int, bool, tuple[int, ...]]]:
    """(kind number, start, end, base, votes and traits) of all candidates in order."""
    out = []
    base, loose = base_spans(text), loose_spans(text)
    for k, kind in enumerate(KINDS):
        taken = base[kind]
        free = [(a, b) for a, b in loose[kind] if not any(a < d and c < b for c, d in taken)] if taken else loose[kind]
        spans = sorted([(a, b, True) for a, b in taken] + [(a, b, False) for a, b in free])
        out += [(k, a, b, own, (*votes(text, kind, a, b, own), *traits(text, a, b))) for a, b, own in spans]
    return out


def _texts(column):
    """Texts that may hold a candidate, others as empty."""
    for a, b, data, offsets in slices(column):
        seen = np.concatenate([[0], np.cumsum(_SEEN[data])])
        some = seen[offsets[1:]] > seen[offsets[:-1]]
        raw = data.tobytes()
        for i in range(b - a):
            yield raw[offsets[i] : offsets[i + 1]].decode() if some[i] else ""


def pattern_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """How often each (kind, votes, traits) occurs."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in _texts(batch.column(0)):
                if text:
                    counts.update((c[0], *c[4]) for c in candidates(text))
        keys = [",".join(map(str, k)) for k in counts]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(list(counts.values()), pa.int64())], ["pattern", "n"])

    return narrow(docs, text_col).mapInArrow(run, "pattern string, n bigint").groupBy("pattern").agg(F.sum("n").alias("n"))


def posteriors(cast: np.ndarray, rates: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Probability that a span with these votes is true; ``share`` is that of true spans before any vote."""
    odds = np.log(share / (1 - share)) + (cast > 0) @ np.log(rates[1] / rates[0]) + (cast < 0) @ np.log((1 - rates[1]) / (1 - rates[0]))
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def reliabilities(cast: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of each vote pattern, P(for | truth, not abstaining) of each labeler, and the share of true spans among loose and base ones.

    EM with independent labelers.  The first labeler is the base rule: it never votes against, and its reliability is given.
    """
    base = (cast[:, 0] > 0).astype(int)
    posterior = 1 / (1 + np.exp(-cast.sum(axis=1)))
    rates, shares = np.empty((2, cast.shape[1])), np.full(2, 0.5)
    for _ in range(rounds):
        weight = np.stack([n * (1 - posterior), n * posterior])
        for truth in (0, 1):
            votes_for, votes_against = weight[truth] @ (cast > 0), weight[truth] @ (cast < 0)
            # As much belief as five votes, four of them right.
            rates[truth] = (votes_for + (1.0, 4.0)[truth]) / (votes_for + votes_against + 5.0)
        worse = rates[1] < rates[0]
        rates[:, worse] = rates[:, worse].mean(axis=0)
        rates[:, 0] = BASE_RATES
        shares = np.array([(posterior[base == g] @ n[base == g] + 1) / (n[base == g].sum() + 2) for g in (0, 1)])
        posterior = posteriors(cast, rates, shares[base])
    return posterior, rates, shares


def _features(kind: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Kind, votes for and against of all but the base rule, and traits, each as zeros and ones."""
    cast = keys[:, 1:5]
    hot = [np.eye(size)[keys[:, 5 + i]] for i, size in enumerate((LENGTHS, CLASSES, CLASSES, THIRDS, THIRDS))]
    return np.hstack([np.eye(len(KINDS))[kind], cast > 0, cast < 0, *hot]).astype(np.float64)


WIDTH = len(KINDS) + 8 + LENGTHS + 2 * CLASSES + 2 * THIRDS


def fit(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Weights of the span classifier; zeros (nothing is added) without candidates."""
    rows = pattern_counts(docs, text_col).collect()  # bounded by the number of patterns
    if not rows:
        return np.zeros(WIDTH)
    rows.sort()
    keys = np.array([list(map(int, r.pattern.split(","))) for r in rows])
    n = np.array([float(r.n) for r in rows])
    # Every vote pattern of a loose span is taught once by the labelers' rates, met or not: else a corpus
    # without false spans would teach nothing about votes against.
    every = np.array(list(product((-1, 0, 1), repeat=4)))
    every = np.hstack([np.zeros((len(every), 1), int), every])
    x, target, weight = [_features(keys[:, 0], keys[:, 1:])], np.empty(len(n)), [n]
    taught = []
    for k in range(len(KINDS)):
        own = keys[:, 0] == k
        target[own], rates, shares = reliabilities(keys[own, 1:6], n[own])
        alone = _features(np.full(len(every), k), np.hstack([every, np.zeros((len(every), 5), int)]))
        alone[:, len(KINDS) + 8 :] = 0
        x.append(alone)
        taught.append(posteriors(every, rates, np.full(len(every), shares[0])))
        weight.append(np.ones(len(every)))
    x, target, n, w = np.vstack(x), np.concatenate([target, *taught]), np.concatenate(weight), np.zeros(WIDTH)
    for _ in range(30):  # Newton steps of a ridge-regularised logistic regression on soft labels
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - target)) + RIDGE * w
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(WIDTH)
        w -= np.linalg.solve(hessian, gradient)
    return w


def probability(kind: int, key: tuple[int, ...], weights: np.ndarray) -> float:
    return float(1 / (1 + np.exp(-np.clip(_features(np.array([kind]), np.array([key]))[0] @ weights, -30, 30))))


def accepted(text: str, weights: np.ndarray, added_at: float = ADDED_AT) -> list[tuple[int, int, int, bool]]:
    found = candidates(text)
    out = []
    for k, a, b, base, key in found:
        if base or probability(k, key, weights) >= added_at:
            out.append((k, a, b, base))
    return out


def annotate(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``spans``: array of (kind, start, end, base), by kind as listed, then start."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])

    def run(batches):
        for batch in batches:
            out = [
                [{"kind": KINDS[k], "start": a, "end": b, "base": base} for k, a, b, base in accepted(text, weights)] if text else []
                for text in _texts(batch.column(1))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(span))], [id_col, "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return narrow(docs, id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, spans array<struct<kind:string,start:int,end:int,base:boolean>>"
    )


def mask(docs: DataFrame, weights: np.ndarray, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """All columns, with every accepted span written as ``[KIND]`` and ``size_col`` brought up to date."""
    place = docs.columns.index(text_col)
    sized = docs.columns.index(size_col) if size_col in docs.columns else None

    def cover(text: str) -> str:
        done, out = 0, []
        for a, b, k in sorted((a, b, k) for k, a, b, _ in accepted(text, weights)):
            if b <= done:
                continue
            out += [text[done : max(a, done)], f"[{KINDS[k].upper()}]"]
            done = b
        return "".join([*out, text[done:]]) if out else text

    def run(batches):
        for batch in batches:
            own = text_array(batch.column(place))
            changed = {}
            for i, text in enumerate(_texts(own)):
                if text and (new := cover(text)) != text:
                    changed[i] = new
            columns = list(batch.columns)
            if changed:
                values = columns[place].to_pylist()
                for i, new in changed.items():
                    values[i] = new
                columns[place] = pa.array(values, batch.schema.field(place).type)
                if sized is not None:
                    sizes = columns[sized].to_pylist()
                    for i, new in changed.items():
                        sizes[i] = len(new)
                    columns[sized] = pa.array(sizes, batch.schema.field(sized).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def digest_columns(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Base counts by kind, the digest of the base spans, and all spans as text."""

    def joined(spans) -> str:
        return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)

    def run(batches):
        for batch in batches:
            lists = batch.column(1).to_pylist()
            base = [[s for s in spans if s["base"]] for spans in lists]
            counts = [pa.array([sum(s["kind"] == k for s in spans) for spans in base], pa.int64()) for k in KINDS]
            digests = pa.array([hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, digests, pa.array([joined(s) for s in lists], pa.string())],
                [id_col, *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    kind = rows.schema[id_col].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return narrow(rows, id_col, "spans").mapInArrow(run, f"`{id_col}` {kind}, {counts}, base_sha256 string, spans string")


@query("op10_pii")
def op10_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return digest_columns(annotate(docs, fit(docs)))
