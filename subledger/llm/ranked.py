"""Ranked lexical search: every document scored for every item by dense blocked matrix products.

1. A shard of items (at most about ``SHARD_TERMS`` term entries, so its vocabulary is bounded whatever the item table) is
   read; its vocabulary is broadcast.  One pass over the documents keeps, for each block of them, the occurrences of that
   vocabulary, and the sums N and L.
2. Document frequencies are summed from the stored blocks by an ordinary group-by on the vocabulary's numbers.
3. For each block, tiles of the item matrix (items x terms, 0 or 1) are multiplied with tiles of the impact matrix (terms x
   documents) by BLAS in float64.  A tile holds only the terms that its items and its documents share ("compact"), and at
   most so many that a partial sum stays below 2**53: every float in it is an exact integer.  Partial sums meet as int64.
4. A task keeps k documents per item.  A tile hands over all scores at or above the item's k-th so far, ties included,
   so the smallest id wins a tie wherever it stands; a window over k rows per task and item gives the result.

An item's long list of terms, a long text or a term that every document holds are only wider or denser tiles.  Nothing of
the documents passes through the driver; of the items, one shard at a time.

Defined results: null and empty texts have no terms; a document without any takes no part in N and L and is never found.
Repeated document rows rank one by one; repeated item rows are ranked each on its own.  Null ids sort first among ties.
Extra columns are ignored.  Without items or documents there are no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subledger.llm.common import id_and_text, release, stored, texts_of
from subledger.llm.exchange import blocks

TOP = 10
SHARD_TERMS = 1 << 16
ITEM_TILE, TERM_TILE, DOC_TILE = 256, 2048, 512
IMPACT_SCALE = 1_000_000_000
EXACT = 1 << 53
NO_ID = -(1 << 63)

#: Terms are runs of ASCII digits and letters and of all bytes beyond ASCII; A-Z are lower-cased.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def item_terms(batches):
    """The distinct terms of each item, joined by a blank."""
    for batch in batches:
        found = [sorted(set(terms_of(t))) for t in texts_of(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([b" ".join(f) for f in found], pa.binary()),
             pa.array([len(f) for f in found], pa.int64())], ["item_id", "terms", "n_terms"])


def occurrences(vocabulary):
    """Blocks of documents as sparse rows over the vocabulary: ids, term counts, and (document, term, tf) triples."""
    def run(batches):
        number = vocabulary.value
        get, width = number.get, max(len(number), 1)
        for ids, texts in blocks(batches):
            length, rows = np.zeros(len(texts), np.int64), []
            for i, text in enumerate(texts):
                words = terms_of(text)
                length[i] = len(words)
                hit = np.array([v for v in map(get, words) if v is not None], np.int64)
                v, tf = np.unique(hit, return_counts=True)
                rows.append((np.full(len(v), i, np.int32), v.astype(np.int32), tf.astype(np.int64)))
            doc, term, tf = (np.concatenate(c) for c in zip(*rows))
            known, df = np.unique(term, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int((length > 0).sum())], pa.int64()), pa.array([int(length.sum())], pa.int64()),
                 pa.array([known.tolist()], pa.list_(pa.int32())), pa.array([df.tolist()], pa.list_(pa.int64())),
                 *(pa.array([a.tobytes()], pa.binary()) for a in
                   (np.array([NO_ID if d is None else d for d in ids], np.int64), length, doc, term, tf))],
                ["n_docs", "n_terms", "known", "df", "ids", "length", "doc", "term", "tf"])
    return run


BLOCK_SCHEMA = ("n_docs long, n_terms long, known array<int>, df array<long>, ids binary, length binary, doc binary, "
                "term binary, tf binary")


class Best:
    """The k best documents of each item so far, ties by id."""

    def __init__(self, items: int, k: int):
        self.k, self.bar = k, np.ones(items, np.int64)
        self.item, self.score, self.doc = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def offer(self, first_item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores``: items x documents.  What reaches an item's k-th score, its ties included, is kept until the cut."""
        bar = self.bar[first_item:first_item + len(scores)]
        if scores.shape[1] > self.k:
            kth = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k]
            bar = np.maximum(bar, kth)
        item, doc = np.nonzero(scores >= bar[:, None])
        if not len(item):
            return
        item_no = np.concatenate([self.item, item + first_item])
        score = np.concatenate([self.score, scores[item, doc]])
        ids = np.concatenate([self.doc, ids[doc]])
        order = np.lexsort((ids, -score, item_no))
        item_no, score, ids = item_no[order], score[order], ids[order]
        start = np.searchsorted(item_no, item_no, side="left")
        place = np.arange(len(item_no)) - start
        keep = place < self.k
        full = place == self.k - 1
        self.bar[item_no[full]] = score[full]
        self.item, self.score, self.doc = item_no[keep], score[keep], ids[keep]


def length_terms(length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of each document: 10 + (90 * n * N) div L, in integers of any size."""
    if len(length) and int(length.max()) * 90 * n_docs < 1 << 62:
        return 10 + (90 * n_docs * length) // n_terms
    return np.array([10 + (90 * int(n) * n_docs) // n_terms for n in length], np.int64)


def impacts(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weights * ((IMPACT_SCALE * tf) // (1000 * tf + 8 * m))


def tiles_of(item_of: np.ndarray, term_of: np.ndarray, n_items: int):
    """Item tiles: (first item, items, the tile's distinct terms, 0/1 matrix items x terms)."""
    for first in range(0, n_items, ITEM_TILE):
        inside = (item_of >= first) & (item_of < first + ITEM_TILE)
        terms, column = np.unique(term_of[inside], return_inverse=True)
        yield first, min(ITEM_TILE, n_items - first), terms, item_of[inside] - first, column


def best_documents(shard, k: int):
    """Per task: the k best documents of each item, through tile products."""
    def run(batches):
        item_of, term_of, n_items, weights, n_docs, n_terms = shard.value
        tiles, best = list(tiles_of(item_of, term_of, n_items)), Best(n_items, k)
        top = int(weights.max(initial=1)) * (IMPACT_SCALE // 1000)
        width = max(1, min(TERM_TILE, (EXACT - 1) // max(top, 1)))
        for batch in batches:
            for row in batch.to_pylist():
                ids, length = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["length"], np.int64)
                doc, term = np.frombuffer(row["doc"], np.int32), np.frombuffer(row["term"], np.int32)
                m = length_terms(length, n_docs, n_terms)
                value = impacts(weights[term], np.frombuffer(row["tf"], np.int64), m[doc])
                for lo in range(0, len(ids), DOC_TILE):
                    a, b = np.searchsorted(doc, [lo, lo + DOC_TILE])
                    if a < b:
                        _tile(tiles, best, width, ids[lo:lo + DOC_TILE], doc[a:b] - lo, term[a:b], value[a:b], len(weights))
        if len(best.item):
            yield pa.RecordBatch.from_arrays([pa.array(best.item), pa.array(best.doc), pa.array(best.score)],
                                             ["item", "doc_id", "score"])
    return run


def _tile(tiles, best: Best, width: int, ids, doc, term, value, n_vocabulary: int) -> None:
    present = np.zeros(n_vocabulary, bool)
    present[term] = True
    for first, n_items, terms, item, column in tiles:
        shared = np.flatnonzero(present[terms])
        if not len(shared):
            continue
        scores = np.zeros((n_items, len(ids)), np.int64)
        place = np.full(n_vocabulary, -1, np.int64)
        place[terms[shared]] = np.arange(len(shared))
        at, item_at = place[term], place[terms][column]
        for lo in range(0, len(shared), width):
            size = min(width, len(shared) - lo)
            query, impact = np.zeros((n_items, size)), np.zeros((size, len(ids)))
            q = (item_at >= lo) & (item_at < lo + size)
            query[item[q], item_at[q] - lo] = 1.0
            d = (at >= lo) & (at < lo + size)
            impact[at[d] - lo, doc[d]] = value[d]
            scores += (query @ impact).astype(np.int64)
        best.offer(first, scores, ids)


def _shard_top(spark: SparkSession, texts: DataFrame, rows: list, k: int) -> DataFrame:
    """``item, doc_id, score`` of one shard's items, at most k per item."""
    sc = spark.sparkContext
    lists = [r["terms"].split(b" ") if r["terms"] else [] for r in rows]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*lists)))}
    number = sc.broadcast(vocabulary)
    found = stored(spark, texts.mapInArrow(occurrences(number), BLOCK_SCHEMA), "ranked-blocks")
    totals = found.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = totals["n"] or 0, totals["l"] or 0
    weights = np.zeros(len(vocabulary), np.int64)
    pairs = found.select(F.explode(F.arrays_zip("known", "df")).alias("p")).groupBy("p.known").agg(F.sum("p.df").alias("df"))
    for term, df in pairs.collect():     # one row per word of the shard's vocabulary
        weights[term] = weight(n_docs, df)
    shard = sc.broadcast((np.repeat(np.arange(len(lists)), [len(x) for x in lists]),
                          np.array([vocabulary[t] for x in lists for t in x], np.int64), len(lists), weights, n_docs, n_terms))
    columns = ["ids", "length", "doc", "term", "tf"]
    local = found.select(*columns).mapInArrow(best_documents(shard, k), "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    top = stored(spark, local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "ranked-top")
    number.destroy()
    shard.destroy()
    return top


def ranked_search(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  shard_terms: int = SHARD_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item."""
    texts = id_and_text(docs, id_col, text_col)
    queries = stored(spark, id_and_text(items, item_col, item_text_col)
                     .mapInArrow(item_terms, "item_id long, terms binary, n_terms long"), "ranked-items")
    shards = max(1, math.ceil((queries.agg(F.sum("n_terms")).first()[0] or 0) / shard_terms))
    dealt = queries.withColumn("shard", F.pmod(F.xxhash64("terms", "item_id"), F.lit(shards)))
    result = None
    for shard in range(shards):
        rows = dealt.filter((F.col("shard") == shard) & (F.col("n_terms") > 0)).collect()
        if not rows:
            continue
        ids = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item long, item_id long")
        part = stored(spark, _shard_top(spark, texts, rows, k).join(F.broadcast(ids), "item"), "ranked-shard")
        result = part if result is None else result.unionByName(part)
        release(spark)
    if result is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return result.select("item_id", F.col("rank").cast("int").alias("rank"),
                         F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score")
