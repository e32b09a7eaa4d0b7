"""Hashed word shingles of whole texts, many texts at a time with numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A word's hash is a
polynomial over random numbers of its bytes, taken from running sums; a
shingle's hash mixes the hashes of its words in order. All are 64 bits wide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pageflow.llm.scan import at_task_end

WORDS = 5
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_BASE = 0xD6E8FEB86659FD93
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _byte_numbers(seed: int) -> np.ndarray:
    table = np.random.default_rng([seed, 5]).integers(1, 1 << 63, 256, dtype=np.uint64)
    table[65:91] = table[97:123]  # A-Z as a-z
    return table


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, as far as the longest slice of the task."""
    global _powers, _inverse
    if len(_powers) < n:
        n = 1 << (n - 1).bit_length()
        _powers, _inverse = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)]))
                             for b in (_BASE, pow(_BASE, -1, 1 << 64)))
    return _powers, _inverse


@at_task_end
def drop_tables() -> None:
    """Gives the tables' memory back; Spark keeps a task's worker process for other stages."""
    global _powers, _inverse
    _powers = _inverse = np.ones(1, np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _STEP
    return h ^ (h >> np.uint64(29))


def word_hashes(texts: pa.StringArray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and where each text's words start (one entry more than texts)."""
    n_texts = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + n_texts + 1].astype(np.int64)
    if texts.null_count:  # a null's bytes are undefined
        texts = texts.fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + n_texts + 1].astype(np.int64)
    low, high = offsets[0], offsets[-1]
    none = np.zeros(0, np.uint64), np.zeros(n_texts + 1, np.int64)
    if low == high:
        return none
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[low:high]
    offsets = offsets - low
    n = len(raw)
    letter = ~_SPACE[raw]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    before = np.concatenate([[False], letter[:-1]])
    starts = np.flatnonzero(letter & (~before | border[:n]))
    ends = np.flatnonzero(letter & (np.concatenate([~letter[1:], [True]]) | border[1:])) + 1
    if not len(starts):
        return none
    powers, inverse = _tables(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_byte_numbers(seed)[raw] * powers[:n], out=sums[1:])
    word = _mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _MIX)
    return word, np.searchsorted(starts, offsets)


def shingle_sets(texts: pa.StringArray, seed: int = 0) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (empty for null and wordless texts).

    A text of fewer than ``WORDS`` words has its whole word sequence as one shingle.
    """
    word, first = word_hashes(texts, seed)
    count = np.diff(first)
    whole = word[:max(0, len(word) - WORDS + 1)]
    for k in range(1, WORDS):
        whole = _mixed(whole * _MIX) + word[k:k + len(whole)]
    whole = _mixed(whole)
    out = []
    for at, c in zip(first[:-1].tolist(), count.tolist()):
        if c >= WORDS:
            out.append(np.unique(whole[at:at + c - WORDS + 1]))
        elif c:
            h = word[at:at + 1]
            for k in range(1, c):
                h = _mixed(h * _MIX) + word[at + k:at + k + 1]
            out.append(_mixed(h + np.uint64(c)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def pair_hashes(word: np.ndarray, first: np.ndarray, apart: int) -> np.ndarray:
    """Hash of each word with the one ``apart`` words on (0: the word alone), 0 where its text ends before that."""
    if not apart:
        return _mixed(word ^ _STEP)
    out = np.zeros(len(word), np.uint64)
    if len(word) > apart:
        out[:-apart] = _mixed(_mixed(word[:-apart] * _MIX) + word[apart:])
    for k in range(1, apart + 1):  # the last words of each text have no partner
        at = first[1:] - k
        out[at[(at >= first[:-1])]] = 0
    return out
