"""Sets of hashed word shingles, computed over Arrow batches with numpy."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
#: Texts are hashed together up to this many bytes at a time.
CHUNK_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240501))
#: A random value per byte, equal for A-Z and a-z.
_VALUE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_VALUE[65:91] = _VALUE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_PLACE = _rng.integers(0, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _power(kind: str, n: int) -> np.ndarray:
    """Powers of the base (or of its inverse) modulo 2^64."""
    if len(_powers[kind]) <= n:
        steps = np.full(2 * n + 2, _BASE if kind == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps)
    return _powers[kind]


def _chunk_sets(data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    """The set of each text; texts lie in ``data`` between ``bounds``."""
    space = _SPACE[data]
    before = np.ones(len(data), bool)
    before[1:] = space[:-1]
    before[bounds[:-1][bounds[:-1] < len(data)]] = True
    starts = np.flatnonzero(~space & before)
    after = np.ones(len(data), bool)
    after[:-1] = space[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = True
    ends = np.flatnonzero(~space & after) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * _power("up", len(data))[:len(data)], out=sums[1:])
    words = _mix((sums[ends] - sums[starts]) * _power("down", len(data))[starts])
    first = np.searchsorted(starts, bounds)
    n = len(words) - WORDS + 1
    if n > 0:
        joint = np.zeros(n, np.uint64)
        for j in range(WORDS):
            joint += words[j:j + n] * _PLACE[j]
        joint = _mix(joint).view(np.int64)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= WORDS:
            yield np.unique(joint[a:b - WORDS + 1])
        elif b > a:
            yield _mix(np.array([(words[a:b] * _PLACE[:b - a]).sum() + np.uint64(b - a)], np.uint64)).view(np.int64)
        else:
            yield np.empty(0, np.int64)


def sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes (64 bits): 5-word
    shingles of the words between ASCII white space, A-Z lower-cased; with
    fewer words one hash of them all; null and wordless texts have none."""
    texts = texts.cast(pa.large_string()).fill_null("") if texts.null_count else texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts):
        return
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        yield from _chunk_sets(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
        at = to


def digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
