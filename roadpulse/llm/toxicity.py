"""Toxicity: a learned lexicon, matched with spelling errors, and context that tells quotation from abuse.

The lexicon is learned from a bounded sample of labelled documents: words, and beginnings of words that
many words share, that occur in toxic ones and hardly ever in others, more of them than chance gives among
terms as rare. Copies are no evidence: a term must occur between as many different neighbours. Levenshtein automata over
tries of the lexicon find its terms in every word of every text, with one edit where a term is long enough. Beginnings are matched as they are; the words of the sample that have one stand
beside it, for words misspelt in the beginning itself. Each occurrence gets a probability: how often occurrences of that
entry, spelt so, stood in toxic sample documents, moved by its context window (inside quotation marks,
after a verb of saying, words around it). A document has the probability of its worst occurrence.

Null and empty texts, and texts without an occurrence, score NOTHING. A null doc_id counts as empty text in the
fold and is never learned from. Repeated rows are scored each. Long texts are whole. Extra columns are
ignored; an empty table gives no rows; without toxic labels the lexicon is empty.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm import hashing
from roadpulse.llm.automaton import Entry, Lexicon
from roadpulse.llm.common import first_by_hash, fold, labelled, lower_ascii, ship
from roadpulse.session import materialize

FOLDS, HELD = 3, 1
#: Bounds of the training sample, in documents.
TOXIC, CLEAN = 6_000, 18_000
#: Of the terms taken into the lexicon, so large a share may be there by chance; a term is seen LEAST times at least.
BY_CHANCE, LEAST, MOST = 0.02, 3, 64
#: So large a share of an entry's occurrences must stand between different words.
VARIED = 0.2
LIMIT = 0.7
NOTHING = 0.02
LETTERS = r"[^\x00-\x40\x5B-\x60\x7B-\xBF\u2000-\u207F]+"
#: Terms of at least so many letters may have one edit.
EDIT_FROM = 5
STEMS = (4, 5, 6)
WINDOW = 80

_INSIDE = np.zeros(256, bool)
_INSIDE[65:91] = _INSIDE[97:123] = _INSIDE[128:] = True

#: Verbs of saying in the languages of the corpus.
_SAYING = re.compile(
    r"\b(said|says|say|called|calls|wrote|writes|quoted|quote|word|term|sagte?|nannte|schrieb|wort|"
    r"dit|disait|appelé|écrit|mot|dijo|dice|llamó|escribió|palabra)\b"
)
_BINS = 32
_PRIOR = np.array([-2.5, -0.7] + [0.0] * _BINS)


def context(data: bytes, start: int, end: int) -> np.ndarray:
    """Features of an occurrence: quoted, after a verb of saying, hashed words around it."""
    before = data[max(0, start - WINDOW) : start].decode(errors="ignore").rpartition("\n")[2]
    after = data[end : end + WINDOW].decode(errors="ignore").partition("\n")[0]
    out = np.zeros(2 + _BINS)
    opened = before.count('"') % 2 == 1 and '"' in after
    opened |= before.rfind("“") > before.rfind("”") and "”" in after
    opened |= before.rfind("«") > before.rfind("»") and "»" in after
    opened |= before.rfind("„") > before.rfind("“") and "“" in after
    out[0] = opened
    out[1] = bool(_SAYING.search(before.lower()))
    near = [*before.lower().split()[-5:], *after.lower().split()[:5]]
    for word in near:
        out[2 + sum(word.encode()) * 31 % _BINS] += 1 / len(near)
    return out


@dataclass
class Model:
    automaton: Lexicon | None = None
    #: Log odds of an occurrence of each entry: exact, edited.
    odds: np.ndarray = field(default_factory=lambda: np.zeros((0, 2)))
    weights: np.ndarray = field(default_factory=lambda: _PRIOR.copy())


def _hits(texts: hashing.Texts, automaton: Lexicon) -> tuple[hashing.Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts; (word, entry, edits) of every occurrence."""
    plain = hashing.Texts(hashing.without_marks(texts.data), texts.offsets)
    found = hashing.words(plain, inside=_INSIDE)
    return found, *automaton.find(hashing.LOWER[plain.data], found)


def occurrences(texts: hashing.Texts, automaton: Lexicon) -> tuple[np.ndarray, ...]:
    """(text, entry, edited, features) of every occurrence."""
    found, word, entry, edits = _hits(texts, automaton)
    rows = []
    for w in word:
        t = found.text[w]
        low, high = texts.offsets[t], texts.offsets[t + 1]
        s, e = found.start[w], found.end[w]
        part = texts.data[max(low, s - WINDOW) : min(high, e + WINDOW)].tobytes()
        rows.append(context(part, s - max(low, s - WINDOW), e - max(low, s - WINDOW)))
    x = np.array(rows).reshape(-1, 2 + _BINS)
    return found.text[word], entry, (edits > 0).astype(np.int64), x


def score(texts: hashing.Texts, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(probability, occurrences) for each text."""
    out, n = np.full(len(texts), NOTHING), np.zeros(len(texts), np.int64)
    if model.automaton is not None and len(texts.data):
        text, entry, edited, x = occurrences(texts, model.automaton)
        margin = model.odds[entry, edited] + x @ model.weights
        np.maximum.at(out, text, 1 / (1 + np.exp(-np.clip(margin, -30, 30))))
        n = np.bincount(text, minlength=len(texts))
    return out, n


def needed(terms: dict[tuple[int, bool], int], toxic: int, clean: int) -> float:
    """How often a term must occur, only in toxic documents, for few of the terms found so to be chance.

    ``terms`` counts them by how often they occur (up to MOST) and whether only in toxic ones. Seen a times, a
    term has probability share ** a of standing in toxic documents alone; so rare terms need as much evidence as there are
    terms that rare, not as there are terms at all.
    """
    share = toxic / (toxic + clean)
    for a in range(LEAST, MOST + 1):
        seen = sum(n for (k, _), n in terms.items() if k >= a)
        alone = sum(n for (k, only), n in terms.items() if k >= a and only)
        if alone and seen * share**a <= BY_CHANCE * alone:
            return a
    return math.inf


def choose(terms: list[tuple[str, bool, int, int, int]], least: float) -> list[Entry]:
    """Entries among (term, stem, in toxic, in clean, most in toxic of one word)."""
    chosen: list[Entry] = []
    stems: set[str] = set()
    begun: set[str] = set()  # by the stems chosen
    for term, stem, a, b, top in sorted(terms, key=lambda t: (-t[2], t[1], -len(t[0]), t[0])):
        if a < least or b > 0.02 * a or (stem and a < 2 * top):
            continue
        if any(term[:k] in stems for k in STEMS if k <= len(term)) or (stem and term in begun):
            continue
        chosen.append(Entry(term, stem, int(not stem and len(term) >= EDIT_FROM)))
        if stem:
            stems.add(term)
            begun |= {term[:k] for k in STEMS if k <= len(term)}
    return chosen


def with_families(entries: list[Entry], words: list[str]) -> list[Entry]:
    """The entries, and with one edit the words that begin with a stem among them."""
    have = {e.term for e in entries if not e.stem}
    stems = tuple(e.term for e in entries if e.stem)
    family = sorted({w for w in words if len(w) >= EDIT_FROM and w.startswith(stems)} - have)
    return entries + [Entry(w, False, 1) for w in family]


def _neighbours(automaton: Lexicon):
    """Of each occurrence: its entry, and a hash of the words before and after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in hashing.pieces(batch):
                found, word, entry, _ = _hits(hashing.as_texts(piece.column("text")), automaton)
                beside = np.zeros(len(word), np.uint64)
                for step in (-1, 1):
                    at = np.clip(word + step, 0, max(len(found.hash) - 1, 0))
                    inside = (at == word + step) & (found.text[at] == found.text[word])
                    beside = hashing.mix(beside + np.where(inside, found.hash[at], np.uint64(0)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(entry), pa.array(beside.view(np.int64))], names=["entry", "beside"]
                )

    return run


def _learn_occurrences(automaton: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in hashing.pieces(batch):
                text, entry, edited, x = occurrences(hashing.as_texts(piece.column("text")), automaton)
                marks = piece.column("mark").to_numpy()[text]
                exact = np.bincount(text[edited == 0], minlength=piece.num_rows)[text] > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(entry),
                        pa.array(edited),
                        pa.array(exact),
                        pa.array(marks.astype(np.int64)),
                        pa.array([r.tobytes() for r in x], pa.binary()),
                    ],
                    names=["entry", "edited", "exact", "mark", "x"],
                )

    return run


def _fit_context(x: np.ndarray, y: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Logistic weights around their prior."""
    w = _PRIOR.copy()
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(offset + x @ w, -30, 30)))
        w -= 0.5 / (1 + len(y) / 8) * (x.T @ (p - y) + 5.0 * (w - _PRIOR))
    return w


def train(documents: DataFrame, labels: DataFrame) -> Model:
    ship(documents.sparkSession)
    marked = labelled(labels, "toxic").filter(fold(F.col("doc_id"), FOLDS) != HELD)
    bad = first_by_hash(marked.filter("mark = 1"), TOXIC)
    good = first_by_hash(marked.filter("mark = 0"), CLEAN)
    chosen = documents.select("doc_id", "text").join(F.broadcast(bad.union(good)), "doc_id").select("text", "mark")
    # The one pass over the documents; all that follows reads the sample.
    sample = materialize(chosen, "toxicity-sample")
    words = sample.select(
        "mark", F.explode(F.array_distinct(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(LETTERS), F.lit(0)))).alias("word")
    )
    counted = words.groupBy("word").agg(
        F.count(F.when(F.col("mark") == 1, 1)).alias("a"), F.count(F.when(F.col("mark") == 0, 1)).alias("b")
    )
    begun = counted.select(
        F.explode(
            F.array(
                F.struct(F.col("word").alias("term"), F.lit(False).alias("stem")),
                *[
                    F.when(
                        F.length("word") > k,
                        F.struct(F.substring("word", 1, k).alias("term"), F.lit(True).alias("stem")),
                    )
                    for k in STEMS
                ],
            )
        ).alias("t"),
        "a",
        "b",
    ).filter("t is not null")
    terms = begun.groupBy("t").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.max("a").alias("top"))
    sizes = {r["mark"]: r["count"] for r in sample.groupBy("mark").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Model()
    only = (F.col("a") >= LEAST) & (F.col("b") <= 0.02 * F.col("a"))
    often = terms.groupBy(F.least(F.col("a") + F.col("b"), F.lit(MOST)).alias("n"), only.alias("only")).count().collect()
    least = needed({(r["n"], r["only"]): r["count"] for r in often}, sizes[1], sizes[0])
    # As many as the sample gives, which is bounded.
    likely = terms.filter(only & (F.col("a") >= least)).select("t.term", "t.stem", "a", "b", "top").collect()
    entries = choose([tuple(r) for r in likely], least)
    if not entries:
        return Model()
    exact = Lexicon([Entry(e.term, e.stem) for e in entries])
    places = (
        sample.filter("mark = 1")
        .mapInArrow(_neighbours(exact), "entry long, beside long")
        .groupBy("entry")
        .agg(F.count_distinct("beside").alias("different"), F.count("*").alias("n"))
        .collect()
    )
    varied = {r["entry"] for r in places if r["different"] >= max(least, VARIED * r["n"])}
    entries = [e for k, e in enumerate(entries) if k in varied]
    if not entries:
        return Model()
    stems = [e.term for e in entries if e.stem]
    if stems:
        begins = [F.substring("word", 1, k).isin([t for t in stems if len(t) == k]) for k in STEMS]
        family = counted.filter("a > 0 and b <= 0.02 * a").filter(begins[0] | begins[1] | begins[2]).select("word")
        entries = with_families(entries, [r["word"] for r in family.collect()])
    automaton = Lexicon(entries)
    seen = sample.mapInArrow(
        _learn_occurrences(automaton), "entry long, edited long, exact boolean, mark long, x binary"
    )
    # Edited occurrences tell something only where no exact one explains the label.
    totals = seen.filter("edited = 0 or not exact").groupBy("entry", "edited", "mark").count().collect()
    counts = np.zeros((len(entries), 2, 2))
    for r in totals:
        counts[r["entry"], r["edited"], int(r["mark"] > 0)] += r["count"]
    prior = np.array([[9.0, 1.0], [3.0, 1.0]])
    odds = np.log((counts[:, :, 1] + prior[None, :, 0]) / (counts[:, :, 0] + prior[None, :, 1]))
    rows = some_rows(seen, sum(r["count"] for r in totals))
    x = np.frombuffer(b"".join(r["x"] for r in rows)).reshape(-1, 2 + _BINS)
    entry, edited, y = (np.array([r[k] for r in rows], np.int64) for k in ("entry", "edited", "mark"))
    return Model(automaton, odds, _fit_context(x, y, odds[entry, edited]) if len(rows) else _PRIOR.copy())


def some_rows(seen: DataFrame, n: int, most: int = 20_000) -> list:
    """About ``most`` of the n occurrences, by hash, in an order of their own, for the context weights."""
    share = int(10**6 * min(1.0, most / max(n, 1)))
    rows = seen.filter(F.pmod(F.xxhash64("x", "entry"), F.lit(10**6)) < share).collect()
    return sorted(rows, key=lambda r: (r["entry"], r["edited"], r["mark"], bytes(r["x"])))


def _apply(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in hashing.pieces(batch):
                p, n = score(hashing.as_texts(piece.column("text")), model)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(p), pa.array(n)], names=["doc_id", "score", "n_found"]
                )

    return run


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_found) per row."""
    model = train(documents, labels)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = texts.mapInArrow(_apply(model), "doc_id long, score double, n_found long")
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"),
        "score",
        (F.col("score") >= LIMIT).cast("int").alias("predicted"),
        "n_found",
    )
