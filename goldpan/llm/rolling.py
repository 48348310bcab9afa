"""Keyed hashes, Rabin-Karp windows and winnowing on numpy arrays, for use inside Spark tasks.

A sequence is an array of 64-bit symbols. Everything depends on a secret key that the driver draws (``keyed`` sends it along
with a task's function), so that nobody can choose texts that clash. Words are hashed by SipHash-1-3. Two kinds of
polynomials are built over symbols: those modulo 2**64 with a prefix sum, for k-grams and for anchors, which only choose
what is compared; and those modulo the prime 2**61 - 1 (``windows``), for windows of any length that decide. Modulo 2**64
alone strings of 1,024 symbols (Thue and Morse's) clash whatever base and symbols are.
"""

from __future__ import annotations

import ctypes
import secrets
from collections.abc import Callable
from hashlib import blake2b
from inspect import signature

import numpy as np
import pyarrow as pa

U = np.uint64
_MASK = (1 << 64) - 1
#: Powers that a worker keeps (32 MB); those of longer sequences are computed for the one call.
_KEPT_POWERS = 1 << 21
PRIME = (1 << 61) - 1


class _Key:
    """What follows from a secret of 32 bytes: SipHash keys, the bases of polynomials, and a symbol for each byte."""

    def __init__(self, secret: bytes):
        self.secret = secret
        numbers = [int.from_bytes(blake2b(bytes([i]), key=secret, digest_size=8).digest(), "little") for i in range(4)]
        self.sip = numbers[:2]
        self.base = numbers[2] | 1
        self.prime_base = numbers[3] % (PRIME - 1) + 1
        draw = np.random.Generator(np.random.PCG64(int.from_bytes(blake2b(b"symbols", key=secret, digest_size=16).digest(), "little")))
        self.byte_symbol = draw.integers(0, 2**64, size=256, dtype=U)
        self.powers: dict[str, np.ndarray] = {}


_key = _Key(secrets.token_bytes(32))


def use(secret: bytes) -> None:
    """Hash with this secret from now on."""
    global _key
    if _key.secret != secret:
        _key = _Key(secret)


def keyed(task: Callable) -> Callable:
    """``task`` as a function that hashes with the key of the process that calls ``keyed``: the driver."""
    secret = _key.secret

    def one(data):
        use(secret)
        return task(data)

    def two(left, right):
        use(secret)
        return task(left, right)

    return two if len(signature(task).parameters) == 2 else one  # Spark looks at the number of arguments


def byte_symbols(data: np.ndarray) -> np.ndarray:
    """A random 64-bit symbol for each byte."""
    return _key.byte_symbol[data]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n."""
    found = _key.powers
    if len(found.get("up", ())) < n:
        size = max(n, 1 << 16)
        found = {}
        for name, base in (("up", _key.base), ("down", pow(_key.base, -1, 1 << 64))):
            steps = np.full(size, base, U)
            steps[0] = 1
            found[name] = np.cumprod(steps, dtype=U)
        if size <= _KEPT_POWERS:
            _key.powers = found
    return found["up"][:n], found["down"][:n]


def tidy() -> None:
    """Give freed memory back to the system: a worker serves many tasks, and Arrow and malloc keep what they once had."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library: nothing to trim
        pass


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection that spreads all bits (splitmix64)."""
    x = x + U((0x9E3779B97F4A7C15 * (seed + 1)) & _MASK)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


#: Masks that keep the first n of eight bytes.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], U)
#: Bytes beyond which a string is hashed by keyed blake2b.
_LONG = 256
#: Strings that go through the rounds at once, so that their state stays in the processor's cache.
_AT_ONCE = 1 << 13


def _turn(x: np.ndarray, n: int) -> None:
    low = x >> U(64 - n)
    x <<= U(n)
    x |= low


def _round(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> None:
    """One round, in place."""
    a += b
    _turn(b, 13)
    b ^= a
    _turn(a, 32)
    c += d
    _turn(d, 16)
    d ^= c
    a += d
    _turn(d, 21)
    d ^= a
    c += b
    _turn(b, 17)
    b ^= c
    _turn(c, 32)


def _sip(eight: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """SipHash-1-3 (Aumasson and Bernstein 2012) of strings of up to ``_LONG`` bytes."""
    n, (k0, k1) = len(start), _key.sip
    v = [np.full(n, k ^ c, U) for k, c in ((k0, 0x736F6D6570736575), (k1, 0x646F72616E646F6D), (k0, 0x6C7967656E657261), (k1, 0x7465646279746573))]
    at, done = np.flatnonzero(size >= 8), 0
    while len(at):
        block, part = eight[start[at] + done], [x[at] for x in v]
        part[3] ^= block
        _round(*part)
        part[0] ^= block
        for x, y in zip(v, part):
            x[at] = y
        done += 8
        at = at[size[at] >= done + 8]
    rest = size & 7
    block = (eight[start + size - rest] & _FIRST[rest]) | ((size & 255).astype(U) << U(56))
    v[3] ^= block
    _round(*v)
    v[0] ^= block
    v[2] ^= U(255)
    for _ in range(3):
        _round(*v)
    return v[0] ^ v[1] ^ v[2] ^ v[3]


def strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes data[start:end] for each pair: keyed, so that clashes can't be aimed at."""
    size = end - start
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    out = np.empty(len(start), U)
    for i in range(0, len(start), _AT_ONCE):
        part = slice(i, i + _AT_ONCE)
        out[part] = _sip(eight, start[part], np.minimum(size[part], _LONG))
    for i in np.flatnonzero(size > _LONG).tolist():
        out[i] = int.from_bytes(blake2b(data[start[i] : end[i]], key=_key.secret, digest_size=8).digest(), "little")
    return out


def pieces(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A keyed hash at less cost than ``strings``, for callers that compare the bytes behind equal hashes."""
    size = end - start
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    out = mix((eight[start] & _FIRST[np.minimum(size, 8)]) ^ (np.minimum(size, 255).astype(U) << U(56)) ^ U(_key.sip[0]))
    at = np.flatnonzero(size > 8)
    for done in range(8, 64, 8):
        at = at[size[at] > done]
        if not len(at):
            break
        out[at] = mix(out[at] ^ (eight[start[at] + done] & _FIRST[np.minimum(size[at] - done, 8)]), done)
    for i in np.flatnonzero(size > 64).tolist():
        out[i] = int.from_bytes(blake2b(data[start[i] : end[i]], key=_key.secret, digest_size=8).digest(), "little")
    return out


def _times(x: np.ndarray, factor: int) -> np.ndarray:
    """x * factor modulo the prime, for values below it."""
    high, low = x >> U(32), x & U(0xFFFFFFFF)
    f_high, f_low = U(factor >> 32), U(factor & 0xFFFFFFFF)
    middle = high * f_low + low * f_high
    bottom = low * f_low
    out = ((high * f_high) << U(3)) + (middle >> U(29)) + ((middle & U((1 << 29) - 1)) << U(32)) + (bottom >> U(61)) + (bottom & U(PRIME))
    return _below(out)


def _below(x: np.ndarray) -> np.ndarray:
    x = (x & U(PRIME)) + (x >> U(61))
    return np.where(x >= U(PRIME), x - U(PRIME), x)


def windows(symbols: np.ndarray, length: int) -> np.ndarray:
    """Rabin-Karp hash, modulo a prime, of each window of ``length`` symbols; one for each start that has so many."""
    n = len(symbols) - length + 1
    parts = [_windows(symbols[i : i + _AT_ONCE + length - 1], length) for i in range(0, n, _AT_ONCE)]
    return np.concatenate(parts) if parts else np.zeros(0, U)


def _windows(symbols: np.ndarray, length: int) -> np.ndarray:
    """Windows of a and b symbols give those of a + b, so a few steps over the whole sequence suffice."""
    have, size, taken, left = _below(_below(symbols)), 1, 0, length
    while True:
        if left & 1:  # windows that are done so far, then ``size`` symbols more
            n = len(symbols) - taken - size + 1
            of = _below(_times(of[:n], pow(_key.prime_base, size, PRIME)) + have[taken : taken + n]) if taken else have
            taken += size
        left >>= 1
        if not left:
            return of
        n = len(have) - size
        have = _below(_times(have[:n], pow(_key.prime_base, size, PRIME)) + have[size : size + n])
        size *= 2


def prefix(symbols: np.ndarray) -> np.ndarray:
    """out[i]: sum of the first i symbols, each times its power."""
    out = np.zeros(len(symbols) + 1, U)
    np.cumsum(symbols * powers(len(symbols))[0], out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of symbols[start:end] for each pair; equal contents give equal hashes wherever they stand."""
    return (sums[end] - sums[start]) * powers(len(sums))[1][start]


def grams(sums: np.ndarray, k: int) -> np.ndarray:
    """Mixed hash of each window of k symbols."""
    n = len(sums) - k
    return mix((sums[k:] - sums[:n]) * powers(len(sums))[1][:n]) if n > 0 else np.zeros(0, U)


def _sliding(x: np.ndarray, w: int, op) -> np.ndarray:
    """op over each window of w values, by doubling."""
    if len(x) < w:
        return x[:0]
    have, out = 1, x
    while have * 2 <= w:
        out = op(out[:-have], out[have:])
        have *= 2
    return op(out[: len(x) - w + 1], out[w - have : w - have + len(x) - w + 1]) if have < w else out


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    return _sliding(x, w, np.minimum)


def fixed_windows(lengths: np.ndarray, size: int) -> np.ndarray:
    """For sequences laid end to end: True at each position where a window of ``size`` fits into its sequence."""
    total = int(lengths.sum())
    ends = np.repeat(np.cumsum(lengths), lengths)
    return np.arange(total) + size <= ends


def winnow(hashes: np.ndarray, valid: np.ndarray, w: int) -> np.ndarray:
    """``hashes``: of each k-gram; ``valid``: windows of w k-grams that lie in one sequence.

    Returns the least hash of each window (one for each entry of ``valid`` that has w hashes; invalid ones are junk).
    """
    return sliding_min(hashes, w)[: len(valid)]


def _word_ranges(is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of True."""
    edge = np.diff(np.concatenate(([0], is_word.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def ascii_lower(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


#: Bytes of words that end at white space: all but 0x20 and 0x09 to 0x0D.
SPACED = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])
#: Bytes of words made of digits, a-z and everything beyond ASCII.
ALNUM = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])


class Words:
    """Words of texts that lie end to end in one buffer, with a 64-bit hash each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, alphabet: np.ndarray, lower: bool):
        """data: bytes of all texts, with at least one separator byte after each; offsets: start of each text, and the end."""
        data = ascii_lower(data) if lower else data
        self.start, self.end = _word_ranges(alphabet[data])
        self.hash = strings(data, self.start, self.end)
        #: Number of words of each text.
        self.counts = np.diff(np.searchsorted(self.start, offsets))


def laid_out(texts, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts ``begin`` to ``end`` of an Arrow string array: bytes with a line feed after each text, and the offsets."""
    width = np.int64 if str(texts.type).startswith("large") else np.int32
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, width)[texts.offset + begin : texts.offset + end + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    at = off - off[0] + np.arange(len(off))
    out = np.full(at[-1], 10, np.uint8)
    keep = np.ones(at[-1], bool)
    keep[at[1:] - 1] = False
    out[keep] = raw
    return out, at


def slices(texts, limit: int = 1 << 20):
    """(begin, end) ranges of whole texts with about ``limit`` bytes each, so that work arrays stay small."""
    width = np.int64 if str(texts.type).startswith("large") else np.int32
    off = np.frombuffer(texts.buffers()[1], width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(off, off[begin] + limit, "right")) - 1)
        yield begin, min(end, len(texts))
        begin = end
