"""Word shingles of whole texts as 64-bit numbers, with numpy."""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd multipliers, from the golden ratio; word k of a shingle is multiplied by its own.
_GOLDEN = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _odd(k: int) -> np.uint64:
    return np.uint64((_GOLDEN * (2 * k + 1) * (k + 3)) & _MASK | 1)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Each number scattered over 64 bits, one to one."""
    x = x ^ np.uint64(_GOLDEN * seed & _MASK)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class Codes(dict):
    """The 8-byte hash of each word; remembers ``most`` words, so that memory is bounded."""

    def __init__(self, most: int = 150_000) -> None:
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> bytes:
        code = xxhash.xxh3_64_digest(word)
        if len(self) < self.most:
            self[word] = code
        return code


def shingle_set(text: bytes | None, k: int, codes: Codes) -> np.ndarray:
    """The sorted distinct ``k``-word shingles of a UTF-8 text, A-Z lower-cased.

    Words are runs of anything but ASCII white space, as ``bytes.split`` cuts them. A text of fewer
    than ``k`` words has its whole sequence as its one shingle; one without words has none.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.frombuffer(b"".join(map(codes.__getitem__, words)), np.uint64)
    n = min(k, len(words))
    h = np.zeros(len(w) - n + 1, np.uint64)
    for i in range(n):
        h += mixed(w[i : i + len(h)], i + 1) * _odd(i)
    h = np.sort(mixed(h, n))
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def set_id(tokens: np.ndarray, clash: frozenset[int] = frozenset(), again: int = 0) -> int:
    """A signed 64-bit id of a set of shingles; equal sets have equal ids.

    ``again`` gives a second id that has nothing to do with the first. Sets whose first id is in
    ``clash``, which other sets have too, get their second one.
    """
    found = int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes(), again)).astype(np.int64))
    return set_id(tokens, again=1) if found in clash else found
