"""64-bit hashes of the words of many texts at once, for functions that run inside tasks on Arrow batches.

A word is [^\\x20\\x09-\\x0D]+ in the text's UTF-8 bytes. Its hash is a polynomial over random values of its bytes, taken from
running sums over the whole buffer, then mixed with its length; equal words have equal hashes wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20  # bytes worked on at once
_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_BYTES = np.random.default_rng(20_240_501).integers(0, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_LOWERED = _BYTES[[b + 32 if 65 <= b <= 90 else b for b in range(256)]]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """The finisher of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            factors = np.full(max(n, SEGMENT + 4096), base)
            factors[0] = 1
            _powers[k] = np.cumprod(factors)
    return _powers[0][:n], _powers[1]


def _buffer_words(buffer: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    space = np.concatenate([[True], _SPACE[buffer], [True]])
    starts, ends = np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:])
    up, down = _power(len(buffer))
    total = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum((_LOWERED if lower else _BYTES)[buffer] * up, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def _segments(text: bytes) -> Iterator[bytes]:
    """The text in parts that end at white space."""
    at = 0
    while len(text) - at > SEGMENT:
        cut = at + SEGMENT
        while cut < len(text) and not _SPACE[text[cut]]:
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def hashed_words(texts: list[bytes | None], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each the number of its text."""
    hashes, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    held: list[bytes] = []
    first = size = 0

    def flush(upto: int) -> None:
        nonlocal held, first, size
        if held:
            found, starts = _buffer_words(np.frombuffer(b"\n".join(held), np.uint8), lower)
            bounds = np.cumsum([len(t) + 1 for t in held])
            hashes.append(found)
            owners.append(first + np.searchsorted(bounds, starts, side="right"))
        held, first, size = [], upto, 0

    for i, text in enumerate(texts):
        text = text or b""
        if len(text) > SEGMENT:
            flush(i)
            for part in _segments(text):
                hashes.append(_buffer_words(np.frombuffer(part, np.uint8), lower)[0])
                owners.append(np.full(len(hashes[-1]), i))
            first = i + 1
            continue
        if size + len(text) > SEGMENT:
            flush(i)
        held.append(text)
        size += len(text) + 1
    flush(len(texts))
    return np.concatenate(hashes), np.concatenate(owners)


def byte_values(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def batches_by_bytes(texts: Iterable[bytes | None], limit: int = SEGMENT) -> Iterator[tuple[int, list[bytes | None]]]:
    """(first number, texts) of runs of texts with about `limit` bytes, at least one text each."""
    held: list[bytes | None] = []
    first = size = 0
    for text in texts:
        held.append(text)
        size += len(text or b"") + 64
        if size >= limit:
            yield first, held
            first, held, size = first + len(held), [], 0
    if held:
        yield first, held
