"""Shape and letter features of texts, for classifiers of quality."""

from __future__ import annotations

import numpy as np

from roadpulse.llm import hashing

TRIGRAM_BINS = 64


CAPITALS, SMALL, SYMBOLS, SHOUTS, STOPS, DIGITS, OTHERS, NONE = range(8)
_KIND = np.full(256, NONE, np.int64)
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = CAPITALS, SMALL, DIGITS, OTHERS
_KIND[list(b"#*$%&|<>")], _KIND[list(b"!?")], _KIND[list(b".,;:")] = SYMBOLS, SHOUTS, STOPS

#: Per line, then for the whole text and for its worst line.
_LINE = 7
WIDTH = 2 * _LINE + 5 + TRIGRAM_BINS


def _ratios(kinds: np.ndarray, words: np.ndarray, again: np.ndarray) -> np.ndarray:
    """``kinds`` counts the bytes of each kind, a row for each line or text."""
    per, size = np.maximum(words, 1), kinds.sum(1)
    return np.stack(
        [
            kinds[:, CAPITALS] / np.maximum(kinds[:, CAPITALS] + kinds[:, SMALL], 1),
            np.minimum(kinds[:, SYMBOLS] / per, 3),
            np.minimum(kinds[:, SHOUTS] / per, 3),
            np.minimum(kinds[:, STOPS] / per, 3),
            kinds[:, DIGITS] / np.maximum(size, 1),
            again / per,
            np.log1p(size / per),
        ],
        1,
    )


def features(texts: hashing.Texts) -> np.ndarray:
    """One row of WIDTH numbers for each text; empty texts get zeros."""
    n, data, ends = len(texts), texts.data, texts.offsets
    out = np.zeros((n, WIDTH), np.float32)
    if not len(data):
        return out
    breaks = np.flatnonzero(data == 10) + 1
    lines = np.unique(np.concatenate([ends, breaks]))
    owner = np.searchsorted(ends, lines[:-1], "right") - 1
    found = hashing.words(texts, lower=False)
    line = np.searchsorted(lines, found.start, "right") - 1
    again = np.zeros(len(line))
    again[1:] = (found.hash[1:] == found.hash[:-1]) & (line[1:] == line[:-1])

    count = lambda owners, size, weights=None: np.bincount(owners, weights, size)
    in_line = np.repeat(np.arange(len(owner)) * 8, np.diff(lines)) + _KIND[data]
    kinds = np.bincount(in_line, minlength=8 * len(owner)).reshape(-1, 8)
    words_in_line = count(line, len(owner))
    per_line = _ratios(kinds, words_in_line, count(line, len(owner), again))
    per_line[words_in_line < 3] = 0
    first = np.searchsorted(owner, np.arange(n))
    full = np.flatnonzero(np.diff(ends))
    in_text = np.zeros((n, 8), np.int64)
    in_text[full] = np.add.reduceat(kinds, first[full], axis=0)
    words_in_text = count(found.text, n)
    out[:, :_LINE] = _ratios(in_text, words_in_text, count(found.text, n, again))
    out[full, _LINE : 2 * _LINE] = np.maximum.reduceat(per_line, first[full], axis=0)
    text, _ = hashing.distinct(found.text, found.hash)
    out[:, 2 * _LINE] = count(text, n) / np.maximum(words_in_text, 1)
    used = words_in_line > 0
    lines_of, kept = owner[used], hashing.range_hash(found.running, lines[:-1][used], lines[1:][used] - 1)
    n_lines = count(lines_of, n)
    different, _ = hashing.distinct(lines_of, kept)
    out[:, 2 * _LINE + 1] = count(different, n) / np.maximum(n_lines, 1)
    out[:, 2 * _LINE + 2] = np.log1p(words_in_text)
    out[:, 2 * _LINE + 3] = np.log1p(n_lines)
    out[:, 2 * _LINE + 4] = in_text[:, OTHERS] / np.maximum(np.diff(ends), 1)
    low = hashing.LOWER[data].astype(np.uint32)
    if len(low) > 2:
        code = (low[:-2] * np.uint32(65599) + low[1:-1]) * np.uint32(65599) + low[2:]
        bins = (code * np.uint32(2654435761)) >> np.uint32(26)
        at = np.repeat(np.arange(n), np.diff(ends))[: len(bins)]
        grams = np.bincount(at * TRIGRAM_BINS + bins, minlength=n * TRIGRAM_BINS).reshape(n, TRIGRAM_BINS)
        out[:, 2 * _LINE + 5 :] = grams / np.maximum(np.diff(ends), 1)[:, None]
    return out
