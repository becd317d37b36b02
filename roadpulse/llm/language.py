"""Language identification by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary have a probability in each language. A word's probability is the
sum, over all its segmentations into pieces, of their products: a forward pass over its bytes. A text is
its words; no piece crosses from one word into the next, so the sum over the text's segmentations is the product
over its words. Piece probabilities are fitted by expectation maximisation (forward and backward) on
the frequent words of a bounded sample of documents of known language.

Runs of letters are the words; capitals are lowered. Long runs, as scripts without spaces have them, are scored over
all their segmentations too; for learning they are cut into parts of LONGEST bytes.

Null texts and texts without a letter: `und`, score 0. A null doc_id counts as empty text in the fold and is not
learned from. Repeated rows are answered each. Long texts are whole. Extra columns are ignored; an empty
table gives no rows; with no known language every text is `und`.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm import hashing
from roadpulse.llm.common import fold, hash_limit, id_hash, ship

FOLDS, HELD = 3, 1
UNDETERMINED = "und"
#: Bounds of the sample: languages, the most frequent ones; documents and frequent words for each.
LANGUAGES, DOCUMENTS, WORDS = 200, 1_500, 5_000
ROUNDS = 4
#: Longer runs of letters are learned from in parts of so many bytes, and scored whole: so many runs and bytes at a time,
#: with numbers brought back into range after so many.
LONGEST = 48
TOGETHER, STEP, RESCALE = 256, 64, 16
#: Numbers a task remembers at most, some for each word and language.
REMEMBERED = 3_000_000
VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁".encode()

_INSIDE = np.zeros(256, bool)
_INSIDE[65:91] = _INSIDE[97:123] = _INSIDE[128:] = True
#: Products of probabilities are kept in range by this factor for each byte.
_SCALE = 1024.0
_SLOT_BITS = 20


def _row_hash(rows: np.ndarray) -> np.ndarray:
    """Running hashes along each row; any part's key follows from two of them."""
    out = np.zeros((rows.shape[0], rows.shape[1] + 1), np.uint64)
    np.cumsum(hashing._BYTE_VALUES[rows] * hashing.powers(hashing.BASE, rows.shape[1]), axis=1, out=out[:, 1:])
    return out


def _keys(running: np.ndarray, size: int) -> np.ndarray:
    """Keys of all parts of ``size`` bytes of each row."""
    back = hashing.powers(hashing.INVERSE, running.shape[1])
    parts = (running[:, size:] - running[:, :-size]) * back[: running.shape[1] - size]
    return hashing.mix(parts + np.uint64(size * 0xD6E8FEB86659FD93 % 2**64))


class Pieces:
    """The vocabulary's pieces by their bytes, found by key in a table with open slots."""

    def __init__(self, path: str | None = None):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(VOCABULARY))
        found: dict[bytes, int] = {}
        for number in range(model.vocab_size()):
            if model.is_byte(number):
                found.setdefault(bytes([int(model.id_to_piece(number)[3:-1], 16)]), number)
            elif not (model.is_control(number) or model.is_unknown(number)):
                found[model.id_to_piece(number).encode()] = number
        self.size = model.vocab_size()
        self.longest = max(map(len, found))
        self.length = np.zeros(self.size + 1, np.int64)
        self.slots = np.full(2**_SLOT_BITS + 64, -1, np.int64)
        keys, numbers = [], []
        for piece, number in found.items():
            self.length[number] = len(piece)
            keys.append(int(_keys(_row_hash(np.frombuffer(piece, np.uint8)[None, :]), len(piece))[0, 0]))
            numbers.append(number)
        self.keys, self.numbers = np.array(keys, np.uint64), np.array(numbers)
        self.reach = 1
        for entry, key in enumerate(keys):
            slot = first = key >> (64 - _SLOT_BITS)
            while self.slots[slot] >= 0:
                slot += 1
            self.slots[slot] = entry
            self.reach = max(self.reach, slot - first + 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these keys; ``size`` where there is none."""
        out = np.full(keys.shape, self.size)
        slot = (keys >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        for step in range(self.reach):
            entry = self.slots[slot + step]
            hit = (entry >= 0) & (self.keys[entry] == keys)
            out[hit] = self.numbers[entry[hit]]
        return out

    def lattice(self, rows: np.ndarray) -> dict[int, np.ndarray]:
        """By length in bytes: the piece at each place of each row."""
        running = _row_hash(rows)
        return {size: self.find(_keys(running, size)) for size in range(1, min(self.longest, rows.shape[1]) + 1)}


def forward(lattice: dict[int, np.ndarray], p: np.ndarray, n: int, length: int) -> np.ndarray:
    """Scaled probability of the first j bytes of each row, for j from 0 to length, in each language."""
    out = np.zeros((length + 1, n, p.shape[1]))
    out[0] = 1
    for end in range(1, length + 1):
        for size in range(1, min(end, len(lattice)) + 1):
            out[end] += out[end - size] * p[lattice[size][:, end - size]]
    return out


def backward(lattice: dict[int, np.ndarray], p: np.ndarray, n: int, length: int) -> np.ndarray:
    out = np.zeros((length + 1, n, p.shape[1]))
    out[length] = 1
    for start in range(length - 1, -1, -1):
        for size in range(1, min(length - start, len(lattice)) + 1):
            out[start] += out[start + size] * p[lattice[size][:, start]]
    return out


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers, rows of bytes) of words of one length, some thousand at a time."""
    sizes = np.array([len(w) for w in words], np.int64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        for part in np.array_split(at, -(-len(at) // 4096)):
            yield part, np.frombuffer(b"".join(words[k] for k in part), np.uint8).reshape(len(part), size)


@dataclass
class Model:
    pieces: Pieces
    languages: list[str]
    p: np.ndarray  # (pieces + 1) x languages, scaled by length; the last row is 0

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """Of each word, in each language."""
        out = np.zeros((len(words), len(self.languages)))
        sizes = np.array([len(w) for w in words], np.int64)
        # The mark that a run begins with comes on top.
        long = np.flatnonzero(sizes > LONGEST + len(SPACE))
        for part in np.array_split(long[np.argsort(sizes[long])], -(-len(long) // TOGETHER)) if len(long) else ():
            out[part] = self._long([words[k] for k in part])
        short = np.flatnonzero(sizes <= LONGEST + len(SPACE))
        for part, rows in by_length([words[k] for k in short]):
            part = short[part]
            size = rows.shape[1]
            total = forward(self.pieces.lattice(rows), self.p, len(rows), size)[size]
            out[part] = np.log(np.maximum(total, 1e-300)) - size * np.log(_SCALE)
        return out


    def _long(self, words: list[bytes]) -> np.ndarray:
        """The same for long words: the forward pass keeps what the longest piece reaches back to, brought back into
        range now and then, and looks up pieces for STEP bytes at a time."""
        sizes = np.array([len(w) for w in words])
        back, n = self.pieces.longest, len(words)
        out, scale = np.zeros((n, len(self.languages))), np.zeros((n, len(self.languages)))
        ahead = [np.ones_like(out)]  # of the last ends, the newest first
        for step in range(0, int(sizes.max()), STEP):
            low = max(0, step - back + 1)
            rows = np.stack([np.frombuffer(w[low : step + STEP].ljust(step + STEP - low, b"\0"), np.uint8) for w in words])
            lattice = self.pieces.lattice(rows)
            for end in range(step + 1, min(step + STEP, int(sizes.max())) + 1):
                total = np.zeros_like(out)
                for size in range(1, min(len(ahead), len(lattice)) + 1):
                    total += ahead[size - 1] * self.p[lattice[size][:, end - size - low]]
                ahead = [total, *ahead[: back - 1]]
                done = sizes == end
                out[done] = np.log(np.maximum(total[done], 1e-300)) + scale[done]
                if end % RESCALE == 0:
                    most = np.maximum(np.max(ahead, axis=0), 1e-300)
                    ahead = [a / most for a in ahead]
                    scale += np.log(most)
        return out - sizes[:, None] * np.log(_SCALE)


def _scaled(counts: np.ndarray, pieces: Pieces) -> np.ndarray:
    used = (pieces.length > 0)[:, None]
    p = np.where(used, counts + 0.02, 0)
    return p / p.sum(0) * _SCALE ** pieces.length[:, None]


def fit(pieces: Pieces, languages: list[str], words: list[bytes], counts: np.ndarray) -> Model:
    """``counts``: of each word in each language."""
    p = _scaled(np.zeros((pieces.size + 1, len(languages))), pieces)
    for _ in range(ROUNDS):
        expected = np.zeros_like(p)
        for part, rows in by_length(words):
            n, size = rows.shape
            lattice = pieces.lattice(rows)
            ahead, behind = forward(lattice, p, n, size), backward(lattice, p, n, size)
            weight = counts[part] / np.maximum(ahead[size], 1e-300)
            for length, numbers in lattice.items():
                for start in range(size - length + 1):
                    at = numbers[:, start]
                    gain = ahead[start] * p[at] * behind[start + length] * weight
                    for k in range(len(languages)):
                        expected[:, k] += np.bincount(at, gain[:, k], len(expected))
        expected[pieces.size] = 0
        p = _scaled(expected, pieces)
    return Model(pieces, languages, p)


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII capitals and those of Latin-1 in small letters."""
    out = hashing.LOWER[data]
    accented = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[accented] += 32
    return out


def units(texts: hashing.Texts, cut: bool = False) -> tuple[np.ndarray, hashing.Words, np.ndarray]:
    """(data, words, whether each begins a run of letters); with ``cut``, of LONGEST bytes at most."""
    data = hashing.without_marks(lowered(texts.data)) if len(texts.data) else texts.data
    found = hashing.words(hashing.Texts(data, texts.offsets), lower=False, inside=_INSIDE)
    parts = -(-(found.end - found.start) // LONGEST)
    if not cut or not len(parts) or parts.max() == 1:
        return data, found, np.ones(len(found.start), bool)
    of = np.repeat(np.arange(len(parts)), parts)
    k = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = found.start[of] + k * LONGEST
    end = np.minimum(start + LONGEST, found.end[of])
    value = hashing.range_hash(found.running, start, end)
    value[k > 0] = hashing.mix(value[k > 0] + np.uint64(1))
    return data, hashing.Words(found.text[of], start, end, value, found.running), k == 0


def _spelt(data: np.ndarray, found: hashing.Words, begins: np.ndarray, at: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    return [(SPACE if begins[k] else b"") + raw[found.start[k] : found.end[k]] for k in at]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in hashing.pieces(batch):
            data, found, begins = units(hashing.as_texts(piece.column("text")), cut=True)
            langs, of = np.unique(np.array(piece.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
            both, first, times = np.unique(
                np.stack([of[found.text].astype(np.uint64), found.hash]), axis=1, return_index=True, return_counts=True
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(langs[both[0].astype(np.int64)].tolist(), pa.string()),
                    pa.array(_spelt(data, found, begins, first), pa.binary()),
                    pa.array(times.astype(np.int64)),
                ],
                names=["lang", "word", "times"],
            )


def train(documents: DataFrame, path: str | None = None) -> Model | None:
    ship(documents.sparkSession)
    known = documents.filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD)
    )
    first = Window.partitionBy("lang").orderBy(id_hash(), "doc_id")
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    sample = (
        known.select("doc_id", "lang")
        .join(sizes, "lang")
        .filter(id_hash() < hash_limit(DOCUMENTS, F.col("n")))
        .select("doc_id", "lang")
        .distinct()
        .withColumn("k", F.row_number().over(first))
        .filter(F.col("k") <= DOCUMENTS)
        .drop("k")
    )
    counted = (
        known.select("doc_id", "lang", "text")
        .join(F.broadcast(sample), ["doc_id", "lang"])
        .select("lang", "text")
        .mapInArrow(_count, "lang string, word binary, times long")
        .groupBy("lang", "word")
        .agg(F.sum("times").alias("times"))
    )
    frequent = Window.partitionBy("lang").orderBy(F.desc("times"), "word")
    rows = counted.withColumn("k", F.row_number().over(frequent)).filter(F.col("k") <= WORDS).collect()
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    if len(languages) >= LANGUAGES and (found := known.agg(F.count_distinct("lang")).first()[0]) > LANGUAGES:
        warnings.warn(f"{found} languages are given; the {LANGUAGES} most frequent are learned", stacklevel=2)
    words = sorted({bytes(r["word"]) for r in rows})
    of_word, of_lang = {w: k for k, w in enumerate(words)}, {g: k for k, g in enumerate(languages)}
    counts = np.zeros((len(words), len(languages)))
    for r in rows:
        counts[of_word[bytes(r["word"])], of_lang[r["lang"]]] = r["times"]
    return fit(Pieces(path), languages, words, counts)


class _Memory:
    """Log-probabilities of words a task has met."""

    def __init__(self, model: Model):
        self.model = model
        self.hash = np.zeros(0, np.uint64)
        self.value = np.zeros((0, len(model.languages)))

    def look(self, data: np.ndarray, found: hashing.Words, begins: np.ndarray) -> np.ndarray:
        distinct, first, back = np.unique(found.hash, return_index=True, return_inverse=True)
        if self.value.size + self.hash.size > REMEMBERED:
            self.hash, self.value = self.hash[:0], self.value[:0]
        at = np.searchsorted(self.hash, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self.hash)
        new[inside] = self.hash[at[inside]] != distinct[inside]
        values = self.model.log_probabilities(_spelt(data, found, begins, first[new]))
        order = np.argsort(np.concatenate([self.hash, distinct[new]]), kind="stable")
        self.hash = np.concatenate([self.hash, distinct[new]])[order]
        self.value = np.concatenate([self.value, values])[order]
        return self.value[np.searchsorted(self.hash, distinct)][back]


def _no_letter(texts: hashing.Texts) -> np.ndarray:
    letters = ((texts.data | 32) >= 97) & ((texts.data | 32) <= 122) & (texts.data < 128)
    seen = np.concatenate([[0], np.cumsum(letters)])
    out = seen[texts.offsets[1:]] == seen[texts.offsets[:-1]]
    for k in np.flatnonzero(out):
        text = texts.data[texts.offsets[k] : texts.offsets[k + 1]].tobytes().decode(errors="ignore")
        out[k] = not any(c.isalpha() for c in text)
    return out


def _apply(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Memory(model) if model is not None else None
        for batch in batches:
            for piece in hashing.pieces(batch):
                texts = hashing.as_texts(piece.column("text"))
                n = len(texts)
                silent = _no_letter(texts)
                if memory is None:
                    names, best = [UNDETERMINED] * n, np.zeros(n)
                else:
                    data, found, begins = units(texts)
                    each = memory.look(data, found, begins)
                    total = np.stack([np.bincount(found.text, each[:, k], n) for k in range(each.shape[1])], 1)
                    share = np.exp(total - total.max(1, keepdims=True))
                    share /= share.sum(1, keepdims=True)
                    names = [
                        UNDETERMINED if s else model.languages[k] for s, k in zip(silent, share.argmax(1), strict=True)
                    ]
                    best = np.where(silent, 0, share.max(1))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(names, pa.string()), pa.array(best)],
                    names=["doc_id", "lang_pred", "score"],
                )

    return run


def identify(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row."""
    model = train(documents, path)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = texts.mapInArrow(_apply(model), "doc_id long, lang_pred string, score double")
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "lang_pred", "score"
    )
