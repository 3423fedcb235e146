"""Hashed character n-grams of whole texts, computed over the code points of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_STEP = np.uint32(0x01000193)
_SPREAD = np.uint32(0x9E3779B1)


def _codes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, framed by spaces; first and end position of each."""
    lower = [f" {(x or '').lower()} " for x in texts]
    lengths = np.fromiter(map(len, lower), np.int64, len(lower))
    codes = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    codes[(codes >= 9) & (codes <= 13)] = 32
    ends = np.cumsum(lengths)
    return codes, ends - lengths, ends


def grams(texts: Sequence[str | None], sizes: Sequence[int], bits: int, within_words: bool = False) \
        -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each of the rising ``sizes``: an array of features, and where each text's begin and stop in it.

    A text is lower-cased, its white space counts as spaces and it is framed
    by one space on either side, so that n-grams know where words end.
    ``within_words`` leaves out n-grams with a space between other
    characters.  Null counts as empty.
    """
    codes, starts, ends = _codes(texts)
    space = codes == 32 if within_words else None
    inner = None  # a space inside, not at either end
    h = codes * _STEP
    for n in range(1, max(sizes) + 1):
        if n > 1:
            h = (h[:-1] ^ (codes[n - 1:] * np.uint32(2 * n + 1))) * _STEP
        if within_words and n > 2:
            inner = space[1:-1] if n == 3 else inner[:-1] | space[n - 2:-1]
        if n not in sizes:
            continue
        stops = np.maximum(starts, ends - n + 1)
        mixed = h
        if inner is not None:
            kept = np.flatnonzero(~inner)
            mixed = h[kept]
            yield _bucket(mixed, bits), np.searchsorted(kept, starts), np.searchsorted(kept, stops)
        else:
            yield _bucket(mixed, bits), starts, stops


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    return ((h ^ (h >> np.uint32(15))) * _SPREAD >> np.uint32(32 - bits)).view(np.int32)


def by_text(texts: Sequence[str | None], sizes: Sequence[int], bits: int, within_words: bool = False) -> Iterator[np.ndarray]:
    """The features of each text, repeats included."""
    found = list(grams(texts, sizes, bits, within_words))
    for i in range(len(texts)):
        yield np.concatenate([f[a[i]:b[i]] for f, a, b in found])


def distinct(features: np.ndarray, scratch: np.ndarray) -> np.ndarray:
    """The features without repeats, in no particular order.  ``scratch``: an int32 array, an entry for each possible feature."""
    at = np.arange(len(features), dtype=np.int32)
    scratch[features] = at
    return features[scratch[features] == at]


def sums(texts: Sequence[str | None], sizes: Sequence[int], bits: int, tables: Sequence[np.ndarray]) \
        -> tuple[np.ndarray, np.ndarray]:
    """For each text and each table, the sum of the table's entries over the features; the number of features."""
    total, number = np.zeros((len(texts), len(tables))), np.zeros(len(texts), np.int64)
    for features, first, stop in grams(texts, sizes, bits):
        has = np.flatnonzero(stop > first)
        if not len(has):
            continue
        edges = np.stack([first[has], np.minimum(stop[has], len(features) - 1)], axis=1).ravel()
        at_end = stop[has[-1]] == len(features)  # reduceat can't name the end: the last range runs to it
        edges = edges[:-1] if at_end else edges
        for k, table in enumerate(tables):
            total[has, k] += np.add.reduceat(table[features], edges)[::2]
        number[has] += (stop - first)[has]
    return total, number
