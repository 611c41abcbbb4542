"""Byte-level BPE encoding and decoding as a tree reduction over a monoid.

A text's encoding is built from its halves, on two levels.  On both, neighbours are joined by encoding a window around
their boundary anew and widening it until what lies outside provably stays:

* **Pieces** (matches of the splitting pattern).  A text is cut into leaves; the pieces of two neighbours are joined.  A match
  looks at most two characters beyond its end or three beyond its start, so pieces of the left half are final once three of its
  characters lie in the window.  A match depends on nothing before it, so pieces of the right half are final from the first
  place where a match of the window ends at one of theirs with two characters of the window to spare.
* **Tokens** of a piece, encoded by merges alone.  A sequence of tokens is the encoding of its bytes exactly if every two
  neighbours are the encoding of theirs: no merge crosses a boundary in the whole unless it does so between the two. So a window is
  final when the pairs at both its edges encode to themselves; otherwise it grows on the side that failed.

A piece that is itself in the vocabulary is that token, whole (before any merge).  Halves are cut at powers of two, so that
runs of one character stay aligned.  Pieces seen before come from a bounded worker cache.  Decoding takes leaves of the ids
and concatenates their bytes up the tree.

No shuffle: a row is encoded where it is read.  A task holds one text at a time beside its batch.

Defined results: null and empty texts have no tokens and the digests of nothing; strings of special tokens are plain text; repeated
rows, null ids and extra columns pass through or are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import BoundedCache, id_and_text, texts_of

LEAF_CHARS = 1 << 14
LEAF_BYTES = 16
LEAF_IDS = 1 << 12
SHORT = 64
UNIT_ENTRIES, PART_ENTRIES = 1 << 18, 1 << 16

#: Unicode White_Space, as the splitting pattern reads it.
_WS = r"\t-\r \x85\xa0  -     　"
#: A coarser cut than the pattern's: every place where it cuts, the pattern cuts as well.
COARSE = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")


def ranks_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _half(n: int) -> int:
    """The largest power of two below n."""
    return 1 << (n - 1).bit_length() - 1


class TreeCodec:
    """Encodes and decodes by the tree; ``leaf_*`` set where the recursion ends."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_chars: int = LEAF_CHARS, leaf_bytes: int = LEAF_BYTES,
                 leaf_ids: int = LEAF_IDS):
        self.ranks, self.bytes_of = ranks, {i: token for token, i in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.leaf_chars, self.leaf_bytes, self.leaf_ids = leaf_chars, leaf_bytes, leaf_ids
        self.none = max(ranks.values(), default=0) + 1
        self.packed = {i: i.to_bytes(4, "little") for i in ranks.values()}
        self.around = BoundedCache(self._around, PART_ENTRIES)
        self.leaves = BoundedCache(self.merge, PART_ENTRIES)
        self.units = BoundedCache(self._unit, UNIT_ENTRIES)

    # -- tokens of a piece -------------------------------------------------------------------------------------

    def merge(self, data: bytes) -> list[int]:
        """Merges of the lowest rank, leftmost first, until none is left."""
        if len(data) > SHORT:
            return self._merge_long(data)
        get, none = self.ranks.get, self.none
        parts = [data[i:i + 1] for i in range(len(data))]
        pairs = [get(data[i:i + 2], none) for i in range(len(data) - 1)]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], none)
        return [get(p) for p in parts]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same with a heap of (rank, place) over linked parts."""
        ranks, n = self.ranks, len(data)
        end, before = list(range(1, n + 1)), list(range(-1, n))
        live = bytearray(b"\1") * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not live[i] or end[i] >= n or end[end[i]] != stop:
                continue
            live[end[i]] = 0
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(data[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := ranks.get(data[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        return [ranks[data[i:end[i]]] for i in range(n) if live[i]]

    def _around(self, pair: tuple[int, int]) -> list[int]:
        """The encoding of two neighbours' bytes; themselves if no merge crosses their boundary."""
        return self.merge(self.bytes_of[pair[0]] + self.bytes_of[pair[1]])

    def fits(self, a: int, b: int) -> bool:
        return self.around[a, b] == [a, b]

    def join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right:
            return left + right
        i = j = 1
        window = self.around[left[-1], right[0]]
        while True:
            left_done = i == len(left) or self.fits(left[-i - 1], window[0])
            right_done = j == len(right) or self.fits(window[-1], right[j])
            if left_done and right_done:
                return left[:len(left) - i] + window + right[j:]
            if not left_done:
                i = min(len(left), 2 * i)
            if not right_done:
                j = min(len(right), 2 * j)
            window = self.merge(b"".join(map(self.bytes_of.__getitem__, left[len(left) - i:] + right[:j])))

    def merged(self, data: bytes) -> list[int]:
        """The encoding by merges alone, from the encodings of the halves."""
        if len(data) <= self.leaf_bytes:
            return self.leaves[data]
        mid = _half(len(data))
        return self.join_tokens(self.merged(data[:mid]), self.merged(data[mid:]))

    def piece(self, text: str) -> list[int]:
        data = text.encode("utf-8", "replace")
        whole = self.ranks.get(data)
        return self.merged(data) if whole is None else [whole]

    def _unit(self, text: str) -> bytes:
        """The ids of a coarse piece as little-endian unsigned 32-bit integers."""
        word = text[1:] if text[0] == " " else text
        # plain Latin letters are one match of the pattern, with the blank before them
        parts = [text] if word.isalpha() and max(word) < "\u0250" else self.pattern.findall(text)
        return b"".join([self.packed[i] for p in parts for i in self.piece(p)])

    # -- pieces of a text --------------------------------------------------------------------------------------

    def join_pieces(self, left: list[str], right: list[str]) -> list[str]:
        if not left or not right:
            return left + right
        i = held = 0
        while i < len(left) and held < 3:
            i += 1
            held += len(left[-i])
        j = min(4, len(right))
        head = "".join(left[len(left) - i:])
        while True:
            window = head + "".join(right[:j])
            ends, at = {len(head): 0}, len(head)
            for k, p in enumerate(right[:j], 1):
                at += len(p)
                ends[at] = k
            found, at = [], 0
            for p in COARSE.findall(window):
                found.append(p)
                at += len(p)
                k = ends.get(at)
                if k is not None and (at + 2 <= len(window) or j == len(right)):
                    if k < len(right) or at == len(window):
                        return left[:len(left) - i] + found + right[k:]
            j = min(len(right), 2 * j)

    def pieces(self, text: str) -> list[str]:
        if len(text) <= self.leaf_chars:
            return COARSE.findall(text)
        mid = _half(len(text))
        return self.join_pieces(self.pieces(text[:mid]), self.pieces(text[mid:]))

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.units.__getitem__, self.pieces(text)))

    # -- back --------------------------------------------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= self.leaf_ids:
            return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        mid = _half(len(ids))
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


_CODECS: dict[str, TreeCodec] = {}


def codec(path: str) -> TreeCodec:
    if path not in _CODECS:
        import public_tokenizers
        _CODECS[path] = TreeCodec(read_ranks(path), public_tokenizers.PATTERN)
    return _CODECS[path]


def encoder(path: str):
    def run(batches):
        encode = codec(path).encode
        for batch in batches:
            ids = [encode(t.decode("utf-8", "replace")) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])
    return run


def decoder(path: str):
    def run(batches):
        decode = codec(path).decode
        for batch in batches:
            raw = [decode(np.frombuffer(ids or b"", "<u4")) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(raw, pa.binary())],
                                             ["doc_id", "ids", "decoded"])
    return run


DECODED = "doc_id long, ids binary, decoded binary"


def encode_documents(spark: SparkSession, docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``doc_id, ids binary``: the ids of every text, unsigned, little-endian, 32 bits each."""
    return id_and_text(docs, id_col, text_col).mapInArrow(encoder(path or ranks_path()), "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded binary`` of rows with ``doc_id, ids``."""
    return encoded.select("doc_id", "ids").mapInArrow(decoder(path or ranks_path()), DECODED)


def token_digest(spark: SparkSession, docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text: encoded, then decoded from its ids, in one Python stage."""
    encode, decode = encoder(path or ranks_path()), decoder(path or ranks_path())
    rows = id_and_text(docs).mapInArrow(lambda batches: decode(encode(batches)), DECODED)
    return rows.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
