"""Best-fit packing of tokenised documents into sequences of bounded length.

Hierarchical residual packing: every scan partition packs its own pieces best-fit decreasing; bins filled to within
``slack`` tokens are final.  Underfull bins become items of the next round: they meet in fewer, larger groups (at
most ``group_items`` a task) and are packed best-fit again, until one group holds all that are left or a round
merges nothing.  Only bin ids and sizes travel between rounds, never tokens.

Defined results: a null or empty text is one piece that holds the end id alone; repeated rows and null ids are
documents of their own; a text of any length is cut into pieces of exactly ``capacity`` tokens but for the last;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import BoundedCache, byte_letters, id_and_text, lay_out, release, stored, texts_of

CAPACITY = 4096
END_ID = 1
SLACK = 16            # a bin with at most so many tokens free is final
GROUP_ITEMS = 200_000  # underfull bins packed together in one task
CACHE_ENTRIES = 400_000  # words, and parts of words, that a worker remembers
STRETCH_BYTES = 1 << 23  # text whose words are looked up once each

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, bin long, bin_offset long, bin_fill long")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


#: How the vocabulary splits a lower-cased word before it merges.  Fixed values.
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


class WordIds:
    """Little-endian unsigned 32-bit ids of texts, from bounded caches of ids per word and per part of a word.

    The vocabulary drops white space before it merges, so a text's ids are its words' ids in order; a word's ids are
    those of its parts.  Words with letters beyond Latin, or with a special token's string, are encoded whole.
    """

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = byte_letters()
        self.parts = BoundedCache(self._part, CACHE_ENTRIES)
        self.words = BoundedCache(self._word, CACHE_ENTRIES)

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _part(self, part: str) -> bytes:
        # one part is one unit of the merges: no need to run the splitting again
        letters = part.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.tokenizer.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if "<|" in text or max(text, default="") >= "\u0250":
            return self._ids(text)
        return b"".join(map(self.parts.__getitem__, _PARTS.findall(text.lower())))

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text: each distinct word of a stretch of texts is looked up once, and its ids are laid out by numbers."""
        first = held = 0
        for i, text in enumerate(texts):
            held += len(text)
            if held >= STRETCH_BYTES or i + 1 == len(texts):
                yield from self._stretch(texts[first:i + 1])
                first, held = i + 1, 0

    def _stretch(self, texts: list[bytes]) -> list[bytes]:
        # cuts at the same characters as ``bytes.split``; white space at either end leaves an empty word, which has no ids
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).view(pa.large_string()))
        coded = split.values.view(pa.large_binary()).dictionary_encode()
        ids = list(map(self.words.__getitem__, coded.dictionary.to_pylist()))
        return lay_out(ids, coded.indices.to_numpy(), split.offsets.to_numpy(), "<u4")


_WORDS: dict[str, WordIds] = {}


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best-fit decreasing: bin and offset of each item, and the bins' fills.

    Open bins are kept by free space; a bit set of the free spaces in use gives the tightest fit at once.
    """
    order = np.argsort(-sizes, kind="stable")
    bins = np.empty(len(sizes), dtype=np.int64)
    offsets = np.empty(len(sizes), dtype=np.int64)
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    in_use, fills = 0, []
    for i in order.tolist():
        size = int(sizes[i])
        fitting = in_use >> size
        if fitting:
            free = size + ((fitting & -fitting).bit_length() - 1)
            b = by_free[free].pop()
            if not by_free[free]:
                in_use &= ~(1 << free)
        else:
            b, free = len(fills), capacity
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += size
        free -= size
        if free:
            by_free[free].append(b)
            in_use |= 1 << free
    return bins, offsets, fills


def pack_partition(path: str, capacity: int):
    """Tokenise a partition's documents, cut them into pieces and pack the pieces."""
    def run(batches):
        words = _WORDS.get(path) or _WORDS.setdefault(path, WordIds(path))
        end = np.array([END_ID], dtype="<u4").tobytes()
        cols: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "crc": []}
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc, raw in zip(ids, words.encode(texts_of(batch))):
                raw += end
                for piece, start in enumerate(range(0, len(raw) // 4, capacity)):
                    chunk = raw[4 * start:4 * (start + capacity)]
                    cols["doc_id"].append(doc)
                    cols["piece"].append(piece)
                    cols["start"].append(start)
                    cols["length"].append(len(chunk) // 4)
                    cols["crc"].append(zlib.crc32(chunk))
        if not cols["doc_id"]:
            return
        sizes = np.array(cols["length"], dtype=np.int64)
        bins, offsets, fills = best_fit(sizes, capacity)
        first = TaskContext.get().partitionId() << 33
        fill = np.array(fills, dtype=np.int64)[bins]
        for a in range(0, len(sizes), 50_000):
            s = slice(a, a + 50_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols["doc_id"][s], pa.int64()), pa.array(cols["piece"][s], pa.int32()),
                 pa.array(cols["start"][s], pa.int64()), pa.array(sizes[s]), pa.array(cols["crc"][s], pa.int64()),
                 pa.array(bins[s] + first), pa.array(offsets[s]), pa.array(fill[s])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "bin", "bin_offset", "bin_fill"])
    return run


def merge_group(capacity: int, level: int):
    """Pack one group of underfull bins; members keep their way back to the first bins."""
    def run(batches):
        rows = [batch for batch in batches if batch.num_rows]
        if not rows:
            return
        table = pa.Table.from_batches(rows).sort_by([("fill", "descending"), ("bin", "ascending")])
        sizes = table.column("fill").to_numpy()
        bins, offsets, fills = best_fit(sizes, capacity)
        first = ((level << 30) + TaskContext.get().partitionId()) << 24
        yield from pa.table({
            "bin": table.column("bin"), "into": pa.array(-1 - (bins + first)), "shift": pa.array(offsets),
            "into_fill": pa.array(np.array(fills, dtype=np.int64)[bins])}).to_batches(50_000)
    return run


def pack(spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY, path: str | None = None,
         slack: int = SLACK, group_items: int = GROUP_ITEMS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: where it lies in its document and in which sequence, at which offset."""
    path = path or vocabulary_path()
    pieces = stored(spark, id_and_text(docs, id_col, text_col).mapInArrow(pack_partition(path, capacity), PIECES),
                    "pieces")
    # a bin's first piece stands for the bin
    items = pieces.where((F.col("bin_offset") == 0) & (F.col("bin_fill") < capacity - slack)).select(
        "bin", F.col("bin_fill").alias("fill"))
    moves = None   # first bin -> where it is now
    level, left = 0, items.count()
    while left > 1:
        groups = -(-left // group_items)
        # the shuffle by bin id spreads the bins; a group's expected size is group_items at most
        dealt = items.repartition(groups, "bin") if groups > 1 else items.coalesce(1)
        merged = stored(spark, dealt.mapInArrow(merge_group(capacity, level),
                                                "bin long, into long, shift long, into_fill long"), f"merge{level}")
        step = merged.select(F.col("bin").alias("at"), "into", "shift")
        moves = step.withColumnRenamed("at", "bin") if moves is None else (
            moves.withColumnRenamed("into", "at").withColumnRenamed("shift", "before")
            .join(step, "at", "left").select(
                "bin", F.coalesce("into", "at").alias("into"),
                (F.col("before") + F.coalesce("shift", F.lit(0))).alias("shift")))
        items = merged.where((F.col("shift") == 0) & (F.col("into_fill") < capacity - slack)).select(
            F.col("into").alias("bin"), F.col("into_fill").alias("fill"))
        before, left, level = left, items.count(), level + 1
        if groups == 1 or left > 0.98 * before:
            break
    release(spark)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if moves is None:
        return pieces.select(*columns, F.col("bin").alias("sequence_id"), F.col("bin_offset").alias("offset"))
    return pieces.join(moves, "bin", "left").select(
        *columns, F.coalesce("into", "bin").alias("sequence_id"),
        (F.col("bin_offset") + F.coalesce("shift", F.lit(0))).alias("offset"))
