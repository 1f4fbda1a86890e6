"""Digests of objects."""

from __future__ import annotations

import hashlib

#: Least size of a part of an upload, and the most parts.
LEAST_PART, MOST_PARTS = 8 << 20, 10_000


def part_size(size: int, least: int = LEAST_PART, most: int = MOST_PARTS) -> int:
    """Bytes of a part: the least, doubled until the parts suffice."""
    part = least
    while part * most < size:
        part *= 2
    return part


def etag(data: bytes, part: int | None = None) -> str:
    """What a store reports for an object: its MD5, or for parts the MD5 of their MD5s and their number."""
    if part is None or len(data) <= part:
        return hashlib.md5(data).hexdigest()
    digests = [hashlib.md5(data[i : i + part]).digest() for i in range(0, len(data), part)]
    return f"{hashlib.md5(b''.join(digests)).hexdigest()}-{len(digests)}"
