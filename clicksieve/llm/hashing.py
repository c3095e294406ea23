"""Word and word-sequence hashes with numpy, the same on every machine."""

import hashlib

import numpy as np

SHORT = 64  # bytes; over so few, sums tell apart what differs
BASE = np.uint64(0x9E3779B97F4A7C15)
# Modulo 2**64 every odd number has an inverse.
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
MULTIPLIERS = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers = {}


def mixed(x):
    """Each number with its bits spread over all 64."""
    x = x ^ (x >> np.uint64(30))
    x *= MULTIPLIERS[0]
    x ^= x >> np.uint64(27)
    x *= MULTIPLIERS[1]
    x ^= x >> np.uint64(31)
    return x


def powers(n):
    """The first ``n`` powers of the base and of its inverse."""
    if len(_powers.get("up", ())) < n:
        size = max(2 * n, 1 << 16)
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def span_hashes(values, starts, ends):
    """The hash of each ``values[start:end]``, whatever stands around it."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], dtype=np.uint64, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def keys(n):
    """A number for each of the first ``n`` places, unlike the powers of any base."""
    if len(_powers.get("keys", ())) < n:
        _powers["keys"] = mixed(np.arange(max(2 * n, 1 << 12), dtype=np.uint64) * BASE + MULTIPLIERS[1])
    return _powers["keys"][:n]


def run_hashes(values, starts):
    """The hash of each run of ``values``, one of which begins at each of ``starts`` and reaches to the next.

    Every place in a run has a key of its own, so no pattern of equal values
    cancels out in long runs, as it does in sums with the powers of a base.
    """
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = np.diff(starts, append=len(values))
    place = np.arange(starts[0], len(values)) - np.repeat(starts, lengths)
    terms = values[starts[0] :] * keys(int(lengths.max()))[place]
    return mixed(np.add.reduceat(terms, starts - starts[0]) + lengths.astype(np.uint64))


def word_hashes(text, lower=False):
    """One 64-bit hash per word of a text (``None``: none); with ``lower``, A-Z count as a-z.

    Patterns of few letters cancel out of the sums of long words, so those of
    more than ``SHORT`` bytes have a digest of their bytes instead.
    """
    if not text:
        return np.zeros(0, dtype=np.uint64)
    data = text.encode("utf-8", "surrogatepass")
    data = np.frombuffer(b" %b " % (data.lower() if lower else data), dtype=np.uint8)
    blank = BLANK[data]
    edges = (blank[1:] != blank[:-1]).nonzero()[0] + 1
    starts, ends = edges[0::2], edges[1::2]
    values = data.astype(np.uint64)
    values += np.uint64(1)
    found = span_hashes(values, starts, ends)
    for word in (ends - starts > SHORT).nonzero()[0]:
        digest = hashlib.blake2b(data[starts[word] : ends[word]].tobytes(), digest_size=8).digest()
        found[word] = int.from_bytes(digest, "little")
    return found


def sequence_hashes(words, length):
    """The hash of each run of ``length`` words (none if there are fewer words)."""
    n = max(0, len(words) - length + 1)
    up, down = powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[: len(words)], dtype=np.uint64, out=sums[1:])
    return mixed((sums[length : length + n] - sums[:n]) * down[:n] + np.uint64(length))
