"""Word hashes for the shingle and window operators (runs inside Spark tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

BASE = 0xD6E8FEB86659FD93


def split(text: str | None, lower: bool = False) -> list[bytes]:
    """Words of a text: bytes.split cuts at space and the controls 9 to 13, and bytes.lower
    changes A-Z only."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def identity(words: list[bytes]) -> bytes:
    """128 bits that equal word sequences share."""
    return xxhash.xxh3_128_digest(b" ".join(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Independent odd multipliers: multiples of one constant would let sums of small values collide.
ODD = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive word hashes, from each start that has k."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    acc, done = h, 1
    # Doubling: a hash of 2m words from two hashes of m; the bits of k say when to add one word.
    for bit in bin(k)[3:]:
        acc = acc[: len(acc) - done] * np.uint64(pow(BASE, done, 2**64)) + acc[done:]
        done *= 2
        if bit == "1":
            acc = acc[: len(acc) - 1] * np.uint64(BASE) + h[done:]
            done += 1
    return mix(acc)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of every w consecutive values."""
    done = 1
    while done < w:
        step = min(done, w - done)
        x = np.minimum(x[: len(x) - step], x[step:])
        done += step
    return x


def shingles(h: np.ndarray, k: int = 5) -> np.ndarray:
    """Distinct hashes of k-word shingles, sorted; a shorter sequence is one shingle."""
    if len(h) == 0:
        return h
    if len(h) < k:
        with np.errstate(over="ignore"):
            return mix(np.array([(h * ODD[8:8 + len(h)]).sum() + np.uint64(len(h))], dtype=np.uint64))
    return np.unique(rolling(h, k))


# Terms: runs of digits, ASCII letters (lower-cased) and all characters beyond ASCII. Other bytes become spaces.
TERM_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Terms of a text in order, with repeats; only A-Z are lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()
