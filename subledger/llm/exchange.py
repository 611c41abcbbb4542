"""Asking the whole corpus about keys, from blocks of documents.

A *block* is a bounded run of documents (about ``BLOCK_BYTES`` of text) stored as one row.  A block asks about each of
its distinct keys (64-bit hashes) once: it sends the sorted keys, cut by the keys' leading bits into buckets, and what it
knows of each.  The task of a bucket sees every block's part, combines equal keys and sends each block one answer per
key, in the block's own order.

So a key that a third of all documents hold costs one entry per block, never one per document, and a bucket's size is set
by the number of buckets: ``buckets_for`` aims at ``BUCKET_KEYS`` entries.  Nothing passes through the driver.
"""

from __future__ import annotations

import numpy as np
import zstandard

BLOCK_BYTES = 4 << 20
BUCKET_KEYS = 1_500_000


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_array(a: np.ndarray) -> bytes:
    return squeeze(np.ascontiguousarray(a).tobytes())


def unpack_array(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(expand(data), dtype=dtype)


def _bytewise(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted uint64 keys as differences, byte plane by byte plane: the leading planes are almost empty."""
    if not len(keys):
        return b""
    return squeeze(_bytewise(np.diff(keys, prepend=np.uint64(0))).tobytes())


def unpack_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.empty(0, dtype=np.uint64)
    planes = np.frombuffer(expand(data), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def buckets_for(entries: int) -> int:
    """A power of two, so that the leading bits name the bucket."""
    n = 1
    while n * BUCKET_KEYS < entries:
        n *= 2
    return n


def cuts(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the parts of sorted keys."""
    if buckets == 1:
        return [(0, 0, len(keys))]
    bits = buckets.bit_length() - 1
    edges = np.searchsorted(keys, np.arange(1, buckets, dtype=np.uint64) << np.uint64(64 - bits))
    edges = [0, *edges.tolist(), len(keys)]
    return [(b, edges[b], edges[b + 1]) for b in range(buckets) if edges[b] < edges[b + 1]]


def blocks(batches, size: int = BLOCK_BYTES):
    """Runs of (ids, texts) of about ``size`` bytes each; a text is never cut."""
    from subledger.llm.common import texts_of
    ids, texts, held = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
            ids.append(i)
            texts.append(t)
            held += len(t) + 16
            if held >= size:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts
