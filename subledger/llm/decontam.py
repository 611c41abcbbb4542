"""Benchmark decontamination: BM25 over an inverted index of test items, block-max WAND, then overlap checks.

The index holds the items' questions (items marked "Question: ... Answer: ..." are split there; other items are all question);
every training passage is a query, and all items above the threshold are retrieved.

* A part (question or answer) is *in* a document if a window of at most ``REACH`` times its words holds ``SIMILARITY`` of its distinct
  5-word shingles.  A document leaks an item if it holds every part of it, wherever they stand.
* A passage is two neighbouring segments of a document; a segment is as long as the longest window of the shard, and documents are
  covered without gaps, so every window lies within one passage.
* The threshold of an item is exact, not tuned: a window that holds its question lacks at most a known number of its
  words, so the question's score without its heaviest such words is the least score a leak can have.  Impacts are
  divided by it, so the threshold is 1 for every item.
* A question with so few distinct words that this bound is empty is found by its shingles instead: of any
  ``1 + (1 - SIMILARITY) * shingles`` of them a leak holds at least one, so documents with the words of one are candidates.
* Block-max: items are cut into blocks; a passage whose summed block maxima stay under 1 cannot reach any item of the block.
  The sums of all passages and blocks of a batch are one array operation.  WAND then walks the posting lists of
  the surviving passages within the surviving blocks only, with pivots by term maxima.
* Verification: the question within the passage, then the answer in the whole document.

Items are cut into shards of about ``SHARD_WORDS`` words, whose indexes are built in tasks and stored; what a document is compared with
does not depend on the shards.  Each shard is one pass over the documents, without any shuffle of them, with its own index as the only
broadcast; the driver holds one index at a time.

Defined results: null and empty texts hold no item; null or empty items match nothing; repeated item ids are items of their
own; repeated rows and null ids are judged row by row; an empty table on either side gives no rows; extra columns are
ignored (and kept by ``decontaminate``).
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import id_and_text, stored, texts_of

K1, B = 1.2, 0.75
SHINGLE = 5
SIMILARITY = 0.8
REACH = 2.5
BLOCK_ITEMS = 2      # small blocks have tight maxima; the matrix of maxima (terms x blocks) is what bounds a shard
SHARD_WORDS = 40_000
_WORD = re.compile(r"\w+")
_PARTS = re.compile(r"(?is)^\s*(?:question|q)\s*:\s*(.*?)\s*\b(?:answer|a)\s*:\s*(.*)$")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def split_item(text: str) -> tuple[list[str], list[str]]:
    """The words of the question and of the answer."""
    m = _PARTS.match(text)
    return (words_of(m.group(1)), words_of(m.group(2))) if m else (words_of(text), [])


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    """5-word shingles; a shorter part is one shingle."""
    if not words:
        return set()
    if len(words) < SHINGLE:
        return {tuple(words)}
    return set(zip(*(words[i:] for i in range(SHINGLE))))


def spare_words(n: int) -> int:
    """Word positions a part of n words may lack while ``SIMILARITY`` of its shingles remain."""
    return int((1 - SIMILARITY) * max(0, n - SHINGLE + 1) + 1e-9)


def needed(part: set) -> int:
    """Distinct shingles of a part that a window must hold."""
    return max(1, math.ceil(SIMILARITY * len(part) - 1e-9))


def reach_of(n_words: int) -> int:
    """Words of the longest window in which a part of ``n_words`` may stand."""
    return max(n_words, math.ceil(REACH * n_words))


class Index:
    """An inverted index of one shard of items with normalised impacts and block maxima."""

    def __init__(self, items: list[tuple], idf: dict[str, float], average: float):
        self.ids = [i for i, _ in items]
        parts = [split_item(t) for _, t in items]
        parts = [(q, a) if q else (a, []) for q, a in parts]
        self.questions, self.answers = ([Part(words) for words in side] for side in zip(*parts)) if parts else ([], [])
        self.longest = max((q.reach for q in self.questions), default=0)
        self.terms: dict[str, int] = {}
        self.bare: list[tuple[int, list[set[str]]]] = []     # items found by the words of a shingle
        postings: list[list[tuple[int, float]]] = []
        for i, (q, _) in enumerate(parts):
            weight = {t: idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(q) / average)) for t, tf in Counter(q).items()}
            heaviest = sorted(weight.values(), reverse=True)
            least = sum(heaviest[spare_words(len(q)):])
            if not q:
                continue
            if least <= 0:
                probes = sorted(self.questions[i].shingles)[:len(self.questions[i].shingles) - needed(self.questions[i].shingles) + 1]
                self.bare.append((i, [set(p) for p in probes]))
                continue
            for t, w in weight.items():
                if t not in self.terms:
                    self.terms[t] = len(postings)
                    postings.append([])
                postings[self.terms[t]].append((i, w / least * (1 + 1e-9)))
        self.postings = postings
        n_blocks = -(-len(items) // BLOCK_ITEMS) or 1
        self.block_max = np.zeros((len(postings) + 1, n_blocks), dtype=np.float32)   # last row: unknown words
        for t, entries in enumerate(postings):
            for i, w in entries:
                self.block_max[t, i // BLOCK_ITEMS] = max(self.block_max[t, i // BLOCK_ITEMS], np.float32(w) * np.float32(1.000001))

    def wand(self, terms: list[int], blocks: set[int]) -> list[tuple[int, float]]:
        """All items of the blocks with a score of 1 or more, document at a time."""
        lists = []
        for t in terms:
            entries = [e for e in self.postings[t] if e[0] // BLOCK_ITEMS in blocks]
            if entries:
                lists.append([0, entries, max(w for _, w in entries)])
        found = []
        while lists:
            lists.sort(key=lambda c: c[1][c[0]][0])
            bound, pivot = 0.0, -1
            for k, (at, entries, most) in enumerate(lists):
                bound += most
                if bound >= 1:
                    pivot = entries[at][0]
                    break
            if pivot < 0:
                return found
            if lists[0][1][lists[0][0]][0] == pivot:
                score = 0.0
                for c in lists:
                    if c[1][c[0]][0] != pivot:
                        break
                    score += c[1][c[0]][1]
                    c[0] += 1
                if score >= 1:
                    found.append((pivot, score))
            else:
                for c in lists[:k]:   # no item before the pivot can reach the threshold
                    while c[0] < len(c[1]) and c[1][c[0]][0] < pivot:
                        c[0] += 1
            lists = [c for c in lists if c[0] < len(c[1])]
        return found

    def search(self, texts: list[str]) -> list[dict[int, tuple[float, float, float, int]]]:
        """Per text: item that it leaks -> (score, question overlap, answer overlap, first word of the question's window)."""
        split = [words_of(t) for t in texts]
        out: list[dict] = [{} for _ in texts]
        for d, item, score, lo, hi in (*self._retrieved(split), *self._by_shingle(split)):
            share, at = self.questions[item].best_window(split[d], lo, hi)
            if share < SIMILARITY:
                continue
            best = out[d].get(item)
            if best is None or (score, share, -at) > (best[0], best[1], -best[3]):
                out[d][item] = (score, share, best[2] if best else None, at)
        for words, found in zip(split, out):
            for item, (score, share, _, at) in list(found.items()):
                if self.answers[item].shingles:
                    answer, _ = self.answers[item].best_window(words, 0, len(words))
                    if answer < SIMILARITY:
                        del found[item]
                    else:
                        found[item] = (score, share, answer, at)
        return out

    def _by_shingle(self, split: list[list[str]]):
        """(document, item, score 1, its words) where the words of a probe shingle stand."""
        for d, words in enumerate(split if self.bare else ()):
            own = set(words)
            for item, probes in self.bare:
                if any(p <= own for p in probes):
                    yield d, item, 1.0, 0, len(words)

    def _retrieved(self, split: list[list[str]]):
        """(document, item, score, first and last word of the passage) of every passage that reaches an item's threshold."""
        if not self.terms:
            return
        segment = max(SHINGLE, self.longest)
        unknown, get = len(self.postings), self.terms.get
        lengths = np.array([len(w) for w in split])
        total = int(lengths.sum())
        if not total:
            return
        terms = np.fromiter((get(w, unknown) for words in split for w in words), dtype=np.int64, count=total)
        n_segments = -(-lengths // segment)
        first_segment = np.r_[0, np.cumsum(n_segments)]
        doc = np.repeat(np.arange(len(split)), lengths)
        place = np.arange(total) - np.repeat(np.r_[0, np.cumsum(lengths)[:-1]], lengths)
        where = first_segment[doc] + place // segment
        # distinct known words of each segment, and the sums of their block maxima
        pairs = np.unique(where * (unknown + 1) + terms)
        seg, term = pairs // (unknown + 1), pairs % (unknown + 1)
        begin = np.searchsorted(seg, np.arange(first_segment[-1]))
        bounds = np.add.reduceat(self.block_max[term], begin, axis=0)
        owner = np.repeat(np.arange(len(split)), n_segments)
        both = bounds.copy()   # a passage: a segment and the next one of its document
        follows = np.flatnonzero(owner[1:] == owner[:-1]) if len(owner) > 1 else np.zeros(0, dtype=np.int64)
        both[follows] += bounds[follows + 1]
        ends = np.r_[begin, len(seg)]
        for s in np.flatnonzero((both >= 1).any(axis=1)).tolist():
            d = int(owner[s])
            pair = s + 1 < len(owner) and owner[s + 1] == d
            own = set(term[ends[s]:ends[s + 2 if pair else s + 1]].tolist())
            own.discard(unknown)
            at = (s - int(first_segment[d])) * segment
            for item, score in self.wand(sorted(own), set(np.flatnonzero(both[s] >= 1).tolist())):
                yield d, item, score, at, at + 2 * segment


class Part:
    """The question or the answer of an item."""

    def __init__(self, words: list[str]):
        self.shingles = shingles(words)
        self.size = min(SHINGLE, len(words))
        self.reach = reach_of(len(words))

    def best_window(self, words: list[str], lo: int, hi: int) -> tuple[float, int]:
        """The greatest share of the distinct shingles in a window of at most ``reach`` words within ``words[lo:hi]``, and its start."""
        if not self.shingles:
            return 0.0, lo
        around, n = words[lo:hi], self.size
        hits = [(i, s) for i, s in enumerate(zip(*(around[k:] for k in range(n)))) if s in self.shingles]
        held, left, best, at = Counter(), 0, 0, 0
        for i, s in hits:
            held[s] += 1
            while i + n - hits[left][0] > self.reach:
                gone = hits[left][1]
                held[gone] -= 1
                if not held[gone]:
                    del held[gone]
                left += 1
            if len(held) > best:
                best, at = len(held), hits[left][0]
        return best / len(self.shingles), lo + at


def stored_shards(spark: SparkSession, items: DataFrame, item_id: str = "item_id", text_col: str = "text",
                  shard_words: int = SHARD_WORDS) -> tuple[DataFrame | None, int]:
    """``shard, index`` of every shard, built in tasks and stored, and the number of shards.  Statistics are over all items."""
    texts = items.select(F.col(item_id).cast("long").alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def terms(batches):
        for batch in batches:
            seen, n, words = Counter(), 0, 0
            for raw in texts_of(batch):
                q, a = split_item(raw.decode("utf-8", "replace"))
                if q or a:
                    seen.update(set(q + a))
                    n, words = n + 1, words + len(q) + len(a)
            seen_terms = [("", n), (" ", words), *seen.items()]   # two totals beside the terms
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in seen_terms]), pa.array([c for _, c in seen_terms], pa.int64())],
                                             ["term", "n"])
    frequency = stored(spark, texts.select("text").mapInArrow(terms, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")),
                       "item-terms")
    totals = {r["term"]: r["n"] for r in frequency.where("term IN ('', ' ')").collect()}
    n, words = totals.get("", 0), totals.get(" ", 0)
    if not n or not words:
        return None, 0
    shards, average = -(-words // shard_words), words / n
    dealt = texts.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)))

    def own_terms(batches):
        for batch in batches:
            own = {(shard, t) for shard, raw in zip(batch.column("shard").to_pylist(), texts_of(batch))
                   for part in split_item(raw.decode("utf-8", "replace")) for t in part}
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in own], pa.int64()), pa.array([t for _, t in own], pa.string())],
                                             ["shard", "term"])
    known = dealt.select("shard", "text").mapInArrow(own_terms, "shard long, term string").distinct().join(frequency, "term")

    def build(shard_items: pa.Table, shard_terms: pa.Table) -> pa.Table:
        counts = zip(shard_terms.column("term").to_pylist(), shard_terms.column("n").to_pylist())
        idf = {t: math.log(1 + (n - c + 0.5) / (c + 0.5)) for t, c in counts}
        rows = list(zip(shard_items.column("item_id").to_pylist(), shard_items.column("text").to_pylist()))
        rows.sort(key=lambda r: (len(r[1]), r[1], -1 if r[0] is None else r[0]))   # like lengths share a block
        return pa.table({"shard": shard_items.column("shard").slice(0, 1),
                         "index": pa.array([pickle.dumps(Index(rows, idf, average))], pa.binary())})

    built = dealt.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(build, "shard long, index binary")
    return stored(spark, built, "item-index"), shards


def each_shard(spark: SparkSession, items: DataFrame, shard_words: int = SHARD_WORDS):
    """(broadcast index, whether it is the last) of one shard after the other; the one before is dropped when the next is asked for.
    What reads an index must be stored by then, but for the last one's."""
    indexes, shards = stored_shards(spark, items, shard_words=shard_words)
    held = sorted(r["shard"] for r in indexes.select("shard").collect()) if shards else []
    for shard in held:
        row = indexes.where(F.col("shard") == shard).select("index").first()
        index, last = spark.sparkContext.broadcast(pickle.loads(row["index"])), shard == held[-1]
        yield index, last
        if not last:
            index.destroy()


LEAK = ("doc_id long, item_id long, score double, question_overlap double, answer_overlap double, passage_start long")


def leaks(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document and test item that it leaks, with the question's best window."""
    texts = id_and_text(docs, id_col, text_col)
    found = None
    for index, last in each_shard(spark, items, shard_words):
        def run(batches, index=index):
            for batch in batches:
                rows = []
                ids = batch.column("doc_id").to_pylist()
                texts = [t.decode("utf-8", "replace") for t in texts_of(batch)]
                for a, b in pieces(texts):
                    for doc, hits in zip(ids[a:b], index.value.search(texts[a:b])):
                        rows += [(doc, index.value.ids[i], *hit) for i, hit in hits.items()]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()))],
                        ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "passage_start"])
        part = texts.mapInArrow(run, LEAK)
        part = part if last else stored(spark, part, "leaks")
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], LEAK)


def pieces(texts: list[str], size: int = 1 << 20):
    """Runs of texts of about ``size`` characters, searched together."""
    begin = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= size:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def decontaminate(spark: SparkSession, docs: DataFrame, items: DataFrame, text_col: str = "text",
                  shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` without the rows that leak a test item; all columns kept, no shuffle.  What a shard leaves is stored for the next."""
    place = [c.lower() for c in docs.columns].index(text_col.lower())
    out, schema = docs, docs.schema
    for index, last in each_shard(spark, items, shard_words):
        def run(batches, index=index):
            for batch in batches:
                texts = [(t or b"").decode("utf-8", "replace") for t in batch.column(place).cast(pa.binary()).to_pylist()]
                clean = [not hits for a, b in pieces(texts) for hits in index.value.search(texts[a:b])]
                yield batch.filter(pa.array(clean, pa.bool_()))
        out = out.mapInArrow(run, schema)
        out = out if last else stored(spark, out, "decontaminated")
    return out
