"""Vectorised 64-bit hashes of words and shingles over the buffers of an Arrow text column.

Words are maximal runs of bytes other than space and 0x09-0x0D, with A-Z lowered. A word's hash
is a polynomial over random byte codes, taken from prefix sums, so a batch costs a few numpy
passes and no Python step per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2_000_000
#: Bytes that the numpy passes read at once: they hold about 45 bytes for each.
STEP_BYTES = 250_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_CODES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null as empty) and where each begins; one more entry ends the last."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), starts


def chunks(starts: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about size bytes; a longer text is a run of its own."""
    first = 0
    while first < len(starts) - 1:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + size, "right")) - 1)
        last = min(last, len(starts) - 1)
        yield first, last
        first = last


def words_in(part: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first and end position of every word of part; no word crosses one of bounds, which lead from 0 to the end."""
    steps = list(chunks(bounds, STEP_BYTES))
    if len(steps) == 1:
        return _words_in(part, bounds)
    found = []
    for first, last in steps:
        at = bounds[first]
        hashes, begins, ends = _words_in(part[at : bounds[last]], bounds[first : last + 1] - at)
        found.append((hashes, begins + at, ends + at))
    return tuple(np.concatenate(column) for column in zip(*found)) if found else _words_in(part, bounds)


def _words_in(part: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(part):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = _SPACE[part]
    edge = np.zeros(len(part) + 1, dtype=bool)
    edge[bounds] = True
    begins = np.flatnonzero(~space & (edge[:-1] | np.concatenate(([True], space[:-1]))))
    ends = np.flatnonzero(~space & (edge[1:] | np.concatenate((space[1:], [True])))) + 1
    with np.errstate(over="ignore"):
        powers = np.full(len(part) + 1, _BASE)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_CODES[part] * powers[:-1], out=sums[1:])
        powers[:] = _BASE_INVERSE
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        return mixed((sums[ends] - sums[begins]) * powers[begins]), begins, ends


def word_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: the first text's position, the hashes of all words, and where each text's words begin."""
    data, starts = text_buffers(column)
    for first, last in chunks(starts):
        local = starts[first : last + 1] - starts[first]
        hashes, begins, _ = words_in(LOWER[data[starts[first] : starts[last]]], local)
        yield first, hashes, np.searchsorted(begins, local)


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes; a text with fewer words is one shingle, none without words."""
    for _, hashes, bounds in word_hashes(column):
        with np.errstate(over="ignore"):
            runs = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
            for k in range(words):
                runs += hashes[k : len(hashes) - words + 1 + k] * _STEP[k % 4] ** np.uint64(2 * (k // 4) + 1)
            runs = mixed(runs)
            for begin, end in zip(bounds[:-1], bounds[1:]):
                if end - begin >= words:
                    yield np.unique(runs[begin : end - words + 1])
                elif end > begin:
                    whole = np.uint64(end - begin)
                    for h in hashes[begin:end]:
                        whole = whole * _STEP[3] + h
                    yield mixed(np.array([whole], np.uint64))
                else:
                    yield np.zeros(0, np.uint64)
