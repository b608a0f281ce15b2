"""Hashed character n-grams of whole texts, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from slotwise.llm.common import PIECE

# odd 32-bit multipliers, one per place in the n-gram
FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)
PLAIN = FACTORS.tolist()


def codes(text: str) -> np.ndarray:
    """Code points."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def slots(points: np.ndarray, orders: tuple[int, ...], bits: int) -> list[np.ndarray]:
    """For each order n, the slot of the n-gram that starts at each place (short by n - 1)."""
    out = []
    shift = np.uint32(32 - bits)
    with np.errstate(over="ignore"):
        for n in orders:
            size = len(points) - n + 1
            if size <= 0:
                out.append(np.empty(0, np.uint32))
                continue
            h = points[:size] * FACTORS[0] + np.uint32(n * 0x3C6EF372 & 0xFFFFFFFF)
            for k in range(1, n):
                h = (h ^ (h >> np.uint32(15))) * FACTORS[k] + points[k:size + k]
            h = (h ^ (h >> np.uint32(16))) * FACTORS[4]
            out.append(h >> shift)
    return out


def slot(points: tuple[int, ...], bits: int) -> int:
    """The slot of one n-gram, as :func:`slots` gives it."""
    n, m = len(points), 0xFFFFFFFF
    f = PLAIN
    h = points[0] * f[0] + n * 0x3C6EF372 & m
    for k in range(1, n):
        h = (h ^ h >> 15) * f[k] + points[k] & m
    return ((h ^ h >> 16) * f[4] & m) >> 32 - bits


def pieces(texts: list[str | None], longest: int) -> Iterator[tuple[list[int], str]]:
    """Texts in runs of about ``PIECE`` characters: (row numbers, one joined text each).

    Yields ``(rows, parts)`` where ``parts[i]`` belongs to ``rows[i]``.  A text
    longer than a piece comes in several parts that overlap by
    ``longest - 1`` characters, so that no n-gram is lost or counted twice.
    """
    rows, parts, size = [], [], 0
    for i, t in enumerate(texts):
        if not t:
            continue
        step = PIECE - longest + 1
        for at in range(0, len(t), step) if len(t) > PIECE else (0,):
            part = t[at:at + PIECE] if len(t) > PIECE else t
            if at and len(part) < longest:
                continue
            rows.append(i)
            parts.append(part)
            size += len(part)
            if size >= PIECE:
                yield rows, parts
                rows, parts, size = [], [], 0
    if rows:
        yield rows, parts
