"""Cross-tokenizer alignment: which tokens of two vocabularies stand for the same bytes, and how often.

1. Every text is encoded by both tokenizers; the ids are stored.  Byte offsets where tokens of both end cut them into groups; each
   pair of tokens whose byte ranges overlap is a link.
2. The distinct id pairs of all links are dealt to shards by a hash, and each shard's task builds a minimal perfect hash:
   per level, keys alone in their slot of a bit array are settled and the others go on; a key's number is its bit's rank.
   The keys stand beside it by number, so that a look-up verifies what it found.
3. Each task counts its links into one dense vector over these numbers; vectors are summed in a tree of fan-in ``FAN``.
4. A second pass aligns the documents again from the stored ids and looks every link's count up.

The table sent to the tasks holds at most about ``SLICE_KEYS`` pairs at a time (16 bytes each at most, and about 4 bits of hash): a pass per
slice of shards, whose sums per document are exact.  Whatever the corpus, the number of pairs is bounded by the two vocabularies.
Vectors and shards are of bounded size; a pair that a third of all links hold is one number in each.  A text's ids are one row.

Defined results: null and empty texts, and texts that either tokenizer does not give back byte for byte, have no tokens: zeros and ''.
Strings of special tokens are plain text.  Repeated rows count each; null ids pass through; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import BoundedCache, byte_letters, id_and_text, lay_out, release, stored, texts_of
from subledger.llm.exchange import expand, squeeze
from subledger.llm.tokencount import vocabulary_path

SHARD_KEYS = 1 << 18
SLICE_KEYS = 1 << 22
BLOCK_BYTES = 1 << 20
STRETCH_BYTES = 1 << 21   # text whose units are looked up once each
TASK_KEYS = 1 << 21
CACHE_ENTRIES = 1 << 18
PART_ENTRIES = 1 << 16
FAN = 16
LEVELS = 64
LOAD = 2.0
SPACE_MARK = "▁"
#: Characters below this one are normalised one by one.
PLAIN_BELOW = "\u0250"
_WS = r"\t-\r \x85\xa0"
#: A run of white space and the visible run after it: both vocabularies cut before each.
UNIT = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
CROSSING = re.compile(f"[^{_WS}{SPACE_MARK}][{_WS}{SPACE_MARK}]")


class Pair:
    """The two tokenizers: ids of texts, and the bytes of every id."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.letters = byte_letters()
        byte_of = {c: b for b, c in self.letters.items()}
        self.n_a, self.n_b = self.a.get_vocab_size(), self.b.get_piece_size()
        self.bytes_a = [self._bytes_a(self.a.id_to_token(i), byte_of) for i in range(self.n_a)]
        self.bytes_b = [self._bytes_b(i) for i in range(self.n_b)]
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.type_a, self.type_b = ("<u2" if n <= 1 << 16 else "<u4" for n in (self.n_a, self.n_b))
        self.code_a, self.code_b = ("H" if t == "<u2" else "I" for t in (self.type_a, self.type_b))
        self.finer, self.units = regex.compile(public_tokenizers.PATTERN), BoundedCache(self._unit, CACHE_ENTRIES)
        self.a_parts = BoundedCache(self._part, PART_ENTRIES)
        # B can be encoded unit by unit where no piece goes on from a visible character to white space, nor from a line's end
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        crossing = {m[0][1] for p in pieces for m in CROSSING.finditer(p)}
        self.by_unit = SPACE_MARK not in crossing and not any("\n" in p[:-1] for p in pieces)
        self.odd = re.compile("[" + re.escape("".join(sorted(crossing))) + PLAIN_BELOW + "-\U0010ffff]")
        self.stop = self.b.encode("\n")       # B's blank and the line's end, which stands alone
        self.fresh: dict[str, list[int]] = {}
        #: Decimal ids with what follows them: "," inside, "|" after a group's A ids, ";" after its B ids.
        name_a, name_b = ([b"%d" % i for i in range(n)] for n in (self.n_a, self.n_b))
        parts = ([x + b"," for x in name_a] + [x + b"|" for x in name_a]
                 + [x + b"," for x in name_b] + [x + b";" for x in name_b])
        self.part_size = np.array([len(x) for x in parts], np.int64)
        self.part_bytes = np.array(parts, f"S{self.part_size.max()}").view(np.uint8).reshape(len(parts), -1)

    @staticmethod
    def _bytes_a(token: str, byte_of: dict) -> bytes:
        return bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()

    def _bytes_b(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace(SPACE_MARK, " ").encode()

    def _part(self, part: str) -> bytes | None:
        """A's ids of one match of the pattern; None if A does not give it back."""
        raw = part.encode()
        ids = [t.id for t in self.a.model.tokenize(raw.decode("latin-1").translate(self.letters))]
        return struct.pack(f"<{len(ids)}{self.code_a}", *ids) if b"".join([self.bytes_a[i] for i in ids]) == raw else None

    def _unit(self, text: str) -> tuple[bytes, bytes] | None:
        """Both ids of a unit, which neither vocabulary joins to another; None if either does not give it back."""
        word = text[1:] if text[0] == " " else text
        # plain Latin letters are one match of the pattern, with the blank before them
        parts = [text] if word.isalpha() else self.finer.findall(text)
        a = list(map(self.a_parts.__getitem__, parts))
        b = (self.fresh.get(text) or self.b.encode("\n" + text))[len(self.stop):]
        if None in a or "".join(parts) != text or b"".join([self.bytes_b[i] for i in b]) != text.encode():
            return None
        return b"".join(a), struct.pack(f"<{len(b)}{self.code_b}", *b)

    def _whole(self, text: str) -> tuple[bytes, bytes]:
        """Both ids of a text by the libraries, or nothing where either does not give the text back."""
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        wanted = (" " + text).encode("utf-8", "replace")
        if b"".join([self.bytes_b[i] for i in b]) != wanted or b"".join([self.bytes_a[i] for i in a]) != wanted:
            return b"", b""
        return np.array(a, self.type_a).tobytes(), np.array(b, self.type_b).tobytes()

    def encode(self, texts: list[bytes]) -> list[tuple[bytes, bytes]]:
        """Ids by A and by B of each text, or nothing where either does not give the text back.

        Latin texts are encoded by units between blanks and line ends, each distinct one looked up once and those new to this worker
        in one call of B; others whole.
        """
        plain = [t.decode("utf-8", "replace") for t in texts]
        units = [UNIT.findall(" " + t) if self.by_unit and t and not self.odd.search(t) else [] for t in plain]
        distinct = list(set().union(*units))
        new = [u for u in distinct if u not in self.units and u not in self.units.old]
        self.fresh = dict(zip(new, self.b.encode(["\n" + u for u in new], num_threads=1))) if new else {}
        ids = list(map(self.units.__getitem__, distinct))
        number = dict(zip(distinct, range(len(distinct))))
        size = np.fromiter(map(len, units), np.int64, len(units))
        unit = np.fromiter(map(number.__getitem__, chain.from_iterable(units)), np.int64, size.sum())
        cuts = np.concatenate([[0], np.cumsum(size)])
        # texts with a unit that B does not give back are encoded whole, like those that are not cut
        lost = np.concatenate([[0], np.cumsum(np.array([i is None for i in ids], bool)[unit])])
        by_unit = (size > 0) & (np.diff(lost[cuts]) == 0)
        a, b = (lay_out([i[k] if i else b"" for i in ids], unit, cuts, t) for k, t in enumerate((self.type_a, self.type_b)))
        return [(a[i], b[i]) if by_unit[i] else self._whole(t) if t else (b"", b"") for i, t in enumerate(plain)]


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair_of(paths: tuple[str, str]) -> Pair:
    if paths not in _PAIRS:
        _PAIRS[paths] = Pair(*paths)
    return _PAIRS[paths]


# -- alignment of a block of texts -----------------------------------------------------------------------------

class Aligned:
    """A block of texts laid end to end: both tokenizers cover the same bytes, so ends of texts are shared ends."""

    def __init__(self, pair: Pair, rows: list[tuple[bytes, bytes]]):
        self.pair = pair
        a, b = [np.frombuffer(r[0], pair.type_a) for r in rows], [np.frombuffer(r[1], pair.type_b) for r in rows]
        self.from_a, self.from_b = (np.concatenate([[0], np.cumsum([len(x) for x in t])]).astype(np.int64) for t in (a, b))
        self.a, self.b = np.concatenate(a).astype(np.int64), np.concatenate(b).astype(np.int64)
        len_a = pair.len_a[self.a]
        end_a, end_b = np.cumsum(len_a), np.cumsum(pair.len_b[self.b])
        # how many B tokens end at each byte, and up to it: no search, as both cover the same bytes
        at_byte = np.bincount(end_b, minlength=1)
        up_to = np.cumsum(at_byte)
        self.first, last = up_to[end_a - len_a], up_to[end_a] - at_byte[end_a]
        self.close_a = end_b[last] == end_a if len(end_a) else np.zeros(0, bool)
        self.close_b = np.zeros(len(self.b), bool)
        self.close_b[last[self.close_a]] = True
        self.links_of = last - self.first + 1
        self.from_link = np.concatenate([[0], np.cumsum(self.links_of)])

    def keys(self) -> np.ndarray:
        """One key per link: the A id times the size of B's vocabulary, plus the B id."""
        n = self.links_of
        b = np.arange(self.from_link[-1]) - np.repeat(self.from_link[:-1] - self.first, n)
        return (np.repeat(self.a, n) * self.pair.n_b + self.b[b]).astype(np.uint64)

    def per_text(self, of_link: np.ndarray) -> np.ndarray:
        """Sums over the links of each text."""
        total = np.concatenate([[0], np.cumsum(of_link)])
        return np.diff(total[self.from_link[self.from_a]])

    def counts(self) -> dict[str, np.ndarray]:
        groups = np.concatenate([[0], np.cumsum(self.close_a)])
        return {"n_a": np.diff(self.from_a), "n_b": np.diff(self.from_b), "n_groups": np.diff(groups[self.from_a]),
                "n_links": np.diff(self.from_link[self.from_a])}

    def groups(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        n_a, n_b = self.pair.n_a, self.pair.n_b
        stop_a, stop_b = np.flatnonzero(self.close_a) + 1, np.flatnonzero(self.close_b) + 1
        group_a, group_b = np.cumsum(self.close_a) - self.close_a, np.cumsum(self.close_b) - self.close_b
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + np.concatenate([[0], stop_b])[group_a]] = self.a + n_a * self.close_a
        code[np.arange(len(self.b)) + stop_a[group_b]] = 2 * n_a + self.b + n_b * self.close_b
        size, rows = self.pair.part_size[code], self.pair.part_bytes[code]
        data = rows[np.arange(rows.shape[1]) < size[:, None]].tobytes()
        at = np.concatenate([[0], np.cumsum(size)])[self.from_a + self.from_b].tolist()
        return [data[lo:max(lo, hi - 1)] for lo, hi in zip(at, at[1:])]


def _stretches(batch: pa.RecordBatch):
    """(first row, rows) of about ``BLOCK_BYTES`` of ids."""
    rows, first, held = list(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())), 0, 0
    for i, (a, b) in enumerate(rows):
        held += len(a) + len(b)
        if held >= BLOCK_BYTES or i + 1 == len(rows):
            yield first, rows[first:i + 1]
            first, held = i + 1, 0


def encode_both(paths):
    def run(batches):
        pair = pair_of(paths)
        for batch in batches:
            texts, found = texts_of(batch), []
            lo = held = 0
            for i, t in enumerate(texts):
                held += len(t)
                if held >= STRETCH_BYTES or i + 1 == len(texts):
                    found += pair.encode(texts[lo:i + 1])
                    lo, held = i + 1, 0
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([f[0] for f in found], pa.binary()),
                                              pa.array([f[1] for f in found], pa.binary())], ["doc_id", "a", "b"])
    return run


def align(spark: SparkSession, docs: DataFrame, paths: tuple[str, str] | None = None, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id, a, b``: the ids of every text by both tokenizers, as little-endian integers; stored."""
    paths = paths or default_paths()
    return stored(spark, id_and_text(docs, id_col, text_col).mapInArrow(encode_both(paths), "doc_id long, a binary, b binary"),
                  "aligned-ids")


def default_paths() -> tuple[str, str]:
    return vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")


# -- minimal perfect hash --------------------------------------------------------------------------------------

def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(keys, LEVELS) % np.uint64(shards)).astype(np.int64)


def build_hash(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Bits per level, the levels' bits in 64-bit words, and the keys by number."""
    sizes, words, order, rest = [], [], [], keys
    while len(rest):
        if len(sizes) == LEVELS:
            raise RuntimeError("keys of one shard are not distinct")
        size = 64 * max(1, int(np.ceil(LOAD * len(rest) / 64)))
        slot = (mixed(rest, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(slot, minlength=size) == 1
        settled = alone[slot]
        order.append(rest[settled][np.argsort(slot[settled])])
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        sizes.append(size)
        rest = rest[~settled]
    none = np.empty(0, np.uint64)
    return sizes, np.concatenate(words or [none]), np.concatenate(order or [none])


class PairTable:
    """The minimal perfect hash of some shards: number of a key, -1 for a key that is not in them."""

    def __init__(self, shards: int, parts: list[tuple[int, list[int], bytes, bytes]]):
        self.shards = shards
        self.start = np.full((LEVELS, shards), -1, np.int64)
        self.size = np.ones((LEVELS, shards), np.uint64)
        self.range, at, n = {}, 0, 0
        words, keys = [], []
        for shard, sizes, bits, by_number in sorted(parts):
            for level, size in enumerate(sizes):
                self.start[level, shard], self.size[level, shard] = at, size
                at += size
            words.append(np.frombuffer(expand(bits), "<u8"))
            keys.append(np.frombuffer(expand(by_number), "<u8"))
            self.range[shard] = (n, n + len(keys[-1]))
            n += len(keys[-1])
        self.words = np.concatenate(words) if words else np.empty(0, np.uint64)
        self.keys = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.n = n

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        result, shard = np.full(len(keys), -1, np.int64), shard_of(keys, self.shards)
        open_, level = np.flatnonzero(self.start[0][shard] >= 0), 0
        while len(open_) and level < LEVELS:
            k, s = keys[open_], shard[open_]
            start = self.start[level][s]
            bit = start + (mixed(k, level) % self.size[level][s]).astype(np.int64)
            word, place = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            hit = ((word >> place) & np.uint64(1)).astype(bool) & (start >= 0)
            below = word & ((np.uint64(1) << place) - np.uint64(1))
            number = self.before[bit >> 6] + np.bitwise_count(below)
            result[open_[hit]] = number[hit]
            open_ = open_[~hit & (start >= 0)]
            level += 1
        found = np.flatnonzero(result >= 0)
        result[found[self.keys[result[found]] != keys[found]]] = -1
        return result


def distinct_pairs(paths):
    """The distinct keys of a task's links, handed on whenever ``TASK_KEYS`` are held."""
    def run(batches):
        pair, held = pair_of(paths), np.empty(0, np.uint64)

        def rows(keys):
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64))], ["pair"])
        for batch in batches:
            for _, part in _stretches(batch):
                held = np.union1d(held, Aligned(pair, part).keys())
                if len(held) > TASK_KEYS:
                    yield rows(held)
                    held = np.empty(0, np.uint64)
        if len(held):
            yield rows(held)
    return run


def build_shard(table: pa.Table) -> pa.Table:
    keys = table.column("pair").to_numpy().astype(np.uint64)
    sizes, words, by_number = build_hash(np.unique(keys))
    return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int64()), "n": pa.array([len(by_number)], pa.int64()),
                     "sizes": pa.array([sizes], pa.list_(pa.int64())), "bits": pa.array([squeeze(words.tobytes())], pa.binary()),
                     "pairs": pa.array([squeeze(by_number.tobytes())], pa.binary())})


def perfect_hash(spark: SparkSession, aligned: DataFrame, paths: tuple[str, str], shard_keys: int = SHARD_KEYS
                 ) -> tuple[DataFrame, int]:
    """``shard, n, sizes, bits, pairs`` of every shard, stored, and the number of shards."""
    pairs = stored(spark, aligned.select("a", "b").mapInArrow(distinct_pairs(paths), "pair long").distinct(), "aligned-pairs")
    shards = max(1, -(-pairs.count() // shard_keys))

    def deal(batches):
        for batch in batches:
            keys = batch.column("pair").to_numpy().astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(shard_of(keys, shards)), batch.column("pair")], ["shard", "pair"])

    built = pairs.mapInArrow(deal, "shard long, pair long").groupBy("shard").applyInArrow(
        build_shard, "shard long, n long, sizes array<long>, bits binary, pairs binary")
    return stored(spark, built, "aligned-hash"), shards


def slices(hashes: DataFrame, slice_keys: int = SLICE_KEYS) -> list[list[int]]:
    """Runs of shards of at most ``slice_keys`` pairs (one shard at least)."""
    result, held = [], 0
    for shard, n in sorted(hashes.select("shard", "n").collect()):
        if not result or held + n > slice_keys:
            result.append([])
            held = 0
        result[-1].append(shard)
        held += n
    return result


def read_table(hashes: DataFrame, shards: int, part: list[int]) -> PairTable:
    rows = hashes.filter(F.col("shard").between(part[0], part[-1])).select("shard", "sizes", "bits", "pairs").collect()
    return PairTable(shards, [(r.shard, list(r.sizes), bytes(r.bits), bytes(r.pairs)) for r in rows])


# -- counts ----------------------------------------------------------------------------------------------------

def pack_counts(v: np.ndarray) -> bytes:
    return squeeze(b"4" + v.astype("<u4").tobytes() if v.max(initial=0) < 1 << 32 else b"8" + v.astype("<u8").tobytes())


def unpack_counts(data: bytes) -> np.ndarray:
    raw = expand(data)
    return np.frombuffer(raw, "<u4" if raw[:1] == b"4" else "<u8", offset=1).astype(np.int64)


def count_links(paths, table):
    """One dense vector per task, handed on shard by shard."""
    def run(batches):
        pair, t = pair_of(paths), table.value
        counts = np.zeros(t.n, np.int64)
        for batch in batches:
            for _, part in _stretches(batch):
                keys, n = np.unique(Aligned(pair, part).keys(), return_counts=True)
                number = t.numbers(keys)
                counts[number[number >= 0]] += n[number >= 0]
        task = TaskContext.get().partitionId()
        for shard, (lo, hi) in t.range.items():
            if counts[lo:hi].any():
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([task], pa.int64()),
                                                  pa.array([pack_counts(counts[lo:hi])], pa.binary())], ["shard", "part", "v"])
    return run


def add_vectors(table: pa.Table) -> pa.Table:
    total = sum(unpack_counts(v.as_py()) for v in table.column("v"))
    part = table.column("part")[0].as_py() // FAN
    return pa.table({"shard": table.column("shard").slice(0, 1), "part": pa.array([part], pa.int64()),
                     "v": pa.array([pack_counts(total)], pa.binary())})


def tree_sum(vectors: DataFrame, width: int) -> DataFrame:
    """``shard, part, v``: one vector per shard, by rounds of fan-in :data:`FAN`."""
    while width > 1:
        vectors = vectors.groupBy("shard", F.floor(F.col("part") / FAN).alias("above")).applyInArrow(
            add_vectors, "shard long, part long, v binary")
        width = -(-width // FAN)
    return vectors


def pair_counts(spark: SparkSession, aligned: DataFrame, paths: tuple[str, str], hashes: DataFrame, shards: int,
                parts: list[list[int]]) -> DataFrame:
    """``shard, v``: the links of every pair, by number; stored."""
    sums, width = None, aligned.rdd.getNumPartitions()
    for part in parts:
        table = spark.sparkContext.broadcast(read_table(hashes, shards, part))
        local = aligned.select("a", "b").mapInArrow(count_links(paths, table), "shard long, part long, v binary")
        done = stored(spark, tree_sum(local, width).select("shard", "v"), "aligned-counts")
        sums = done if sums is None else sums.unionByName(done)
        table.destroy()
    return sums


def best_of_b(paths):
    """Per shard: the highest count of each B id."""
    def run(batches):
        n_b = np.uint64(pair_of(paths).n_b)
        for batch in batches:
            for pairs, v in zip(batch.column("pairs").to_pylist(), batch.column("v").to_pylist()):
                b, counts = (np.frombuffer(expand(pairs), "<u8") % n_b).astype(np.int64), unpack_counts(v)
                ids, at = np.unique(b, return_inverse=True)
                best = np.zeros(len(ids), np.int64)
                np.maximum.at(best, at, counts)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(best)], ["b", "best"])
    return run


def look_up(paths, table, first: bool, last: bool):
    """Align again and add what this slice of the table knows of each link."""
    def run(batches):
        pair, (t, counts, best) = pair_of(paths), table.value
        for batch in batches:
            columns = {name: [] for name in ("n_best", "count_sum", "n_a", "n_b", "n_groups", "n_links")}
            digests = []
            for _, part in _stretches(batch):
                block = Aligned(pair, part)
                keys = block.keys()
                number = t.numbers(keys)
                known = number >= 0
                n = np.where(known, counts[number], 0)
                columns["n_best"].append(block.per_text(known & (n == best[(keys % np.uint64(pair.n_b)).astype(np.int64)])))
                columns["count_sum"].append(block.per_text(n))
                for name, value in block.counts().items():
                    columns[name].append(value)
                if last:
                    digests += [hashlib.sha256(g).hexdigest() if g else "" for g in block.groups()]
            arrays = {name: np.concatenate(v) if v else np.empty(0, np.int64) for name, v in columns.items()}
            if not first:
                for name in ("n_best", "count_sum"):
                    arrays[name] = arrays[name] + batch.column(name).to_numpy()
            names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"] if last else ["n_best", "count_sum"]
            out = {"doc_id": batch.column("doc_id")} | {name: pa.array(arrays[name].astype(np.int64)) for name in names}
            out |= {"groups_sha256": pa.array(digests, pa.string())} if last else {c: batch.column(c) for c in ("a", "b")}
            yield pa.RecordBatch.from_pydict(out)
    return run


RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def alignment_digest(spark: SparkSession, docs: DataFrame, paths: tuple[str, str] | None = None,
                     shard_keys: int = SHARD_KEYS, slice_keys: int = SLICE_KEYS) -> DataFrame:
    """Per document: tokens, groups, links, and what the corpus-wide counts of its links say."""
    paths = paths or default_paths()
    aligned = align(spark, docs, paths)
    hashes, shards = perfect_hash(spark, aligned, paths, shard_keys)
    parts = slices(hashes, slice_keys)
    if not parts:
        zeros = [F.lit(0).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
        return aligned.select("doc_id", *zeros, F.lit("").alias("groups_sha256"))
    sums = pair_counts(spark, aligned, paths, hashes, shards, parts)
    best = np.zeros(pair_of(paths).n_b, np.int64)
    for b, n in (hashes.join(sums, "shard").select("pairs", "v").mapInArrow(best_of_b(paths), "b long, best long")
                 .groupBy("b").agg(F.max("best")).collect()):      # one row per id of B's vocabulary at most
        best[b] = n
    rows = aligned
    for i, part in enumerate(parts):
        first, last = i == 0, i + 1 == len(parts)
        held = {r.shard: unpack_counts(r.v) for r in sums.filter(F.col("shard").between(part[0], part[-1])).collect()}
        table = read_table(hashes, shards, part)
        counts = np.concatenate([held[s] for s in sorted(table.range)])
        known = spark.sparkContext.broadcast((table, counts, best))
        if last:
            return rows.mapInArrow(look_up(paths, known, first, True), RESULT)
        rows = stored(spark, rows.mapInArrow(look_up(paths, known, first, False),
                                             "doc_id long, n_best long, count_sum long, a binary, b binary"), "aligned-sums")
        known.destroy()
        release(spark)
