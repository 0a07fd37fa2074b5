"""CRC-32C of many byte strings at once, with numpy."""

from __future__ import annotations

import numpy as np

#: Reflected polynomial of CRC-32C (Castagnoli), and the constant of the masked form.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8

_CHUNK = 64


def _steps(state: np.ndarray, bits: int) -> np.ndarray:
    """The register after ``bits`` zero bits."""
    for _ in range(bits):
        state = np.where(state & 1, (state >> 1) ^ np.uint32(POLYNOMIAL), state >> 1)
    return state


_TWO = _steps(np.arange(65536, dtype=np.uint32), 16)
_BYTES = np.arange(256, dtype=np.uint32)


def _tables(unit: np.ndarray) -> np.ndarray:
    """A linear map, given by the images of the 32 unit vectors, as four tables of bytes."""
    out = np.zeros((4, 256), dtype=np.uint32)
    for k in range(4):
        for b in range(8):
            out[k] ^= np.where(_BYTES >> b & 1, unit[8 * k + b], 0).astype(np.uint32)
    return out


def _apply(t: np.ndarray, x: np.ndarray) -> np.ndarray:
    return t[0][x & 255] ^ t[1][x >> 8 & 255] ^ t[2][x >> 16 & 255] ^ t[3][x >> 24]


_ADVANCE = [_tables(_steps(np.uint32(1) << np.arange(32, dtype=np.uint32), 8 * _CHUNK))]


def _advance(k: int) -> np.ndarray:
    """Tables that run the register over ``2**k`` chunks of zero bytes."""
    while len(_ADVANCE) <= k:
        t = _ADVANCE[-1]
        unit = np.uint32(1) << np.arange(32, dtype=np.uint32)
        _ADVANCE.append(_tables(_apply(t, _apply(t, unit))))
    return _ADVANCE[k]


def crc32c(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of each string.

    Every string is padded in front to whole chunks (leading zeros change
    nothing once the initial value is folded into the first bytes), all chunks
    run in step, and the chunks' registers, linear in the input, are carried to
    the string's end by powers of two.
    """
    if not parts:
        return np.zeros(0, np.uint32)
    size = np.array([max(len(p), 4) for p in parts])
    count = -(-size // _CHUNK)
    end = np.cumsum(count)
    flat = np.zeros(int(end[-1]) * _CHUNK, dtype=np.uint8)
    for p, n, e in zip(parts, size, end):
        at = int(e) * _CHUNK - int(n)
        flat[at:at + len(p)] = np.frombuffer(p, np.uint8)
        flat[at:at + 4] ^= 255
    state = np.zeros(len(flat) // _CHUNK, dtype=np.uint32)
    for column in np.ascontiguousarray(flat.view("<u2").reshape(-1, _CHUNK // 2).T):
        state = _TWO[(state ^ column) & 0xFFFF] ^ (state >> 16)
    left = np.repeat(end, count) - 1 - np.arange(len(state))
    k = 0
    while (left >> k).any():
        far = np.flatnonzero(left >> k & 1)
        state[far] = _apply(_advance(k), state[far])
        k += 1
    out = np.bitwise_xor.reduceat(state, end - count) ^ np.uint32(0xFFFFFFFF)
    for i, p in enumerate(parts):
        if len(p) < 4:  # the initial value does not fit into so few bytes
            s = np.array([0xFFFFFFFF], dtype=np.uint32)
            for byte in p:
                s = _steps(s ^ np.uint32(byte), 8)
            out[i] = s[0] ^ np.uint32(0xFFFFFFFF)
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotated right by 15 bits plus a constant, so that checksums of checksums stay sound."""
    return ((crc >> 15) | (crc << 17)) + np.uint32(MASK_DELTA)
