"""Katz backoff language model: Good-Turing discounts, exactly normalised backoff weights, partitioned tables.

The model
    p(w | h) = d(c(h,w)) * c(h,w) / c(h)      if the pair was seen in training
             = alpha(h) * p(w)                otherwise; alpha(h) = 1 for a history never seen
    p(w)     = d(c(w)) * c(w) / N             if the token was seen
             = what the discounts free        for the one class of unseen tokens
``d`` is the Good-Turing discount for counts up to ``GT_LIMIT`` (1 above, and 1 where the counts of counts give no
proper discount).  ``alpha(h)`` is what the pairs seen after h free, over what p(w) leaves to the tokens not seen
there: the probabilities after any history add up to 1.

How it is computed
1. Blocks of documents are tokenised once and stored: distinct word hashes (sorted) and the text as positions in them.
2. ``exchange`` over word hashes gives the table of token counts and, to every block, the counts of its tokens.
3. ``exchange`` over pair hashes gives the table of pair counts likewise.  One block that holds a pair in its training
   documents also owns it: it adds the pair to the sums that alpha needs.
4. alpha(h) is a group-by of those sums; documents with unseen pairs join it by history.

Both tables are written under the checkpoint folder, partitioned by order.  Tokens are told apart by 64-bit XXH64.

Defined results: a null or empty text is the end token alone; repeated rows are documents of their own and count as often
as they stand there; rows with a null id are scored, never learned from; an empty table gives no rows; with no training
document p is 1 for the one class of unseen tokens; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm import exchange as ex
from subledger.llm.common import id_and_text, id_remainder_py, release, stored

FOLDS, HELD_OUT = 7, 2
GT_LIMIT = 5
END = xxhash.xxh64_intdigest(b"\n", 7)     # no word holds a line feed
START = xxhash.xxh64_intdigest(b"\n\n", 7)
MIX = np.uint64(0x9E3779B97F4A7C15)


def _word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def pair_hash(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    x = (history ^ (history >> np.uint64(31))) * MIX + word
    x ^= x >> np.uint64(29)
    return x * np.uint64(0xBF58476D1CE4E5B9) ^ (x >> np.uint64(32))


# --- 1. blocks -------------------------------------------------------------------------------------------------------

BLOCK = "block long, ids binary, trained binary, ends binary, words binary, tokens binary, n_words long, n_tokens long"


def tokenise(folds: int, held_out: int, block_bytes: int):
    """Blocks of documents as arrays: per document its id, fold and end; per token its position in ``words``."""
    def run(batches):
        task = TaskContext.get().partitionId() << 24
        for number, (ids, texts) in enumerate(ex.blocks(batches, block_bytes)):
            index: dict[bytes, int] = {}
            split, ends, at = [], [], 0
            for t in texts:
                words = t.lower().split()
                words.append(b"\n")
                for w in words:
                    if w not in index:
                        index[w] = len(index)
                split.append(np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words)))
                at += len(words)
                ends.append(at)
            hashes = np.fromiter((END if w == b"\n" else _word_hash(w) for w in index), dtype=np.uint64,
                                 count=len(index))
            words, place = np.unique(hashes, return_inverse=True)
            tokens = place[np.concatenate(split)].astype(np.uint32)
            trained = np.array([i is not None and id_remainder_py(i, folds) != held_out for i in ids])
            missing = np.array([i is None for i in ids])
            yield pa.RecordBatch.from_pylist([{
                "block": task + number,
                "ids": ex.pack_array(np.array([i or 0 for i in ids], dtype=np.int64)),
                "trained": ex.pack_array((trained + 2 * missing).astype(np.uint8)),
                "ends": ex.pack_array(np.array(ends, dtype=np.int64)), "words": ex.pack_sorted(words),
                "tokens": ex.pack_array(ex._bytewise(tokens)), "n_words": len(words), "n_tokens": len(tokens)}],
                schema=_ARROW_BLOCK)
    return run


_ARROW_BLOCK = pa.schema([("block", pa.int64()), *((c, pa.binary()) for c in ("ids", "trained", "ends", "words", "tokens")),
                          ("n_words", pa.int64()), ("n_tokens", pa.int64())])


class Block:
    """A stored block, unpacked."""

    def __init__(self, row):
        self.block = int(row.block)
        self.ids = ex.unpack_array(row.ids, np.int64)
        flags = ex.unpack_array(row.trained, np.uint8)
        self.trained, self.missing = (flags & 1).astype(bool), flags >= 2
        self.ends = ex.unpack_array(row.ends, np.int64)
        self.words = ex.unpack_sorted(row.words)
        planes = ex.unpack_array(row.tokens, np.uint8).reshape(4, -1)
        self.tokens = np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.int64)
        self.lengths = np.diff(self.ends, prepend=0)
        self.token_trained = np.repeat(self.trained, self.lengths)
        self.begins = np.r_[0, self.ends[:-1]]

    def histories(self) -> np.ndarray:
        """Per token, the hash of the token before it; START at a document's begin."""
        before = np.empty(len(self.tokens), dtype=np.uint64)
        before[1:] = self.words[self.tokens[:-1]]
        before[self.begins] = START
        return before

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pair hashes (sorted), the place of each token's pair in them, and a token that shows each."""
        keys, shown, place = np.unique(pair_hash(self.histories(), self.words[self.tokens]),
                                       return_index=True, return_inverse=True)
        return keys, place, shown


# --- 2. and 3. counting ------------------------------------------------------------------------------------------------

PART = "bucket int, block long, keys binary, counts binary"
ANSWER = "order int, bucket int, block long, keys binary, counts binary"


def _frames(batches):
    for batch in batches:
        for row in batch.to_pandas().itertuples(index=False):
            yield row


def ask(order: int, buckets: int):
    """Each block's distinct tokens (order 1) or pairs (order 2) with their counts in its training documents."""
    def run(batches):
        for row in _frames(batches):
            b = Block(row)
            if order == 1:
                keys, place = b.words, b.tokens
            else:
                keys, place, _ = b.pairs()
            counts = np.bincount(place[b.token_trained], minlength=len(keys)).astype(np.uint32)
            if order == 1:   # only what a document outside training holds can need an alpha
                outside = np.zeros(len(keys), dtype=bool)
                outside[place[~b.token_trained]] = True
                counts |= outside.astype(np.uint32) << np.uint32(31)
            out = [{"bucket": bucket, "block": b.block, "keys": ex.pack_sorted(keys[lo:hi]),
                    "counts": ex.pack_array(counts[lo:hi])} for bucket, lo, hi in ex.cuts(keys, buckets)]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]))
    return run


def combine(order: int):
    """A bucket's table (block -1: sorted keys and counts) and its answers: per block the corpus counts of its keys.  The top
    bit marks the one block that owns the key, the next one a token of documents outside training."""
    def run(parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("block", kind="stable")
        keys = [ex.unpack_sorted(k) for k in parts["keys"]]
        counts = [ex.unpack_array(c, np.uint32) for c in parts["counts"]]
        lengths = [len(k) for k in keys]
        every = np.concatenate(keys)
        own = np.concatenate(counts)
        outside, own = own >> np.uint32(31), own & np.uint32(0x7FFFFFFF)
        distinct, place = np.unique(every, return_inverse=True)
        total = np.bincount(place, weights=own, minlength=len(distinct)).astype(np.int64)
        anywhere = np.bincount(place, weights=outside, minlength=len(distinct)) > 0
        answer = (total.astype(np.uint64) | (anywhere.astype(np.uint64) << np.uint64(62)))[place]
        held = np.flatnonzero(own > 0)
        _, first = np.unique(place[held], return_index=True)
        answer[held[first]] |= np.uint64(1 << 63)
        at = np.r_[0, np.cumsum(lengths)]
        seen = total > 0
        bucket = int(parts["bucket"].iloc[0])
        rows = [(order, bucket, -1, ex.pack_sorted(distinct[seen]), ex.pack_array(total[seen]))]
        rows += [(order, bucket, int(block), b"", ex.pack_array(ex._bytewise(answer[a:b])))
                 for block, a, b in zip(parts["block"], at, at[1:])]
        return pd.DataFrame(rows, columns=["order", "bucket", "block", "keys", "counts"])
    return run


def counted(spark: SparkSession, blocks: DataFrame, order: int, entries: int) -> DataFrame:
    buckets = ex.buckets_for(entries)
    parts = blocks.mapInArrow(ask(order, buckets), PART)
    return stored(spark, parts.groupBy("bucket").applyInPandas(combine(order), ANSWER), f"katz-{order}", "order")


def _answers(frame: pd.DataFrame) -> np.ndarray:
    """A block's answers, bucket after bucket: the order of its own sorted keys."""
    parts = []
    for data in frame.sort_values("bucket")["counts"]:
        planes = ex.unpack_array(data, np.uint8).reshape(8, -1)
        parts.append(np.ascontiguousarray(planes.T).view(np.uint64).ravel())
    return np.concatenate(parts)


def count_histogram(tables: DataFrame, limit: int = GT_LIMIT) -> dict[str, float]:
    """From a count table: its total, its number of entries, and how many entries have count 1, 2, ... limit + 1."""
    names = [f"n{r}" for r in range(1, limit + 2)]

    def run(batches):
        for batch in batches:
            for data in batch.column("counts").to_pylist():
                counts = ex.unpack_array(data, np.int64)
                low = np.bincount(counts[counts <= limit + 1], minlength=limit + 2)
                yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in (counts.sum(), len(counts), *low[1:])],
                                                 ["total", "entries", *names])
    schema = ", ".join(f"{n} long" for n in ("total", "entries", *names))
    row = tables.where("block = -1").select("counts").mapInArrow(run, schema).agg(
        *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("total", "entries", *names))).first()
    return row.asDict()


def good_turing(histogram: dict[str, float], limit: int = GT_LIMIT) -> np.ndarray:
    """Katz's discounts d(0..limit); 1 where the counts of counts don't allow one in (0, 1)."""
    n = [0.0] + [float(histogram[f"n{r}"]) for r in range(1, limit + 2)]
    out = np.ones(limit + 1)
    if n[1] <= 0:
        return out
    tail = (limit + 1) * n[limit + 1] / n[1]
    for r in range(1, limit + 1):
        if n[r] > 0 and tail < 1:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail)
            if 0 < d < 1:
                out[r] = d
    return out


def _discount(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    factor = np.ones(len(counts))
    low = counts < len(d)
    factor[low] = d[counts[low]]
    return counts * factor


# --- 4. scoring ---------------------------------------------------------------------------------------------------------

SCORED = ("kind int, doc_id long, known_id boolean, held_out boolean, n_tokens long, n_known long, "
          "base_score double, score double, history long, amount double, amount2 double")
_ARROW_SCORED = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("known_id", pa.bool_()), ("held_out", pa.bool_()),
                           ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()),
                           ("score", pa.float64()), ("history", pa.int64()), ("amount", pa.float64()), ("amount2", pa.float64())])


def score_block(total: int, vocabulary: int, starts: int, d1: np.ndarray, d2: np.ndarray, p_unseen: float, mass: float):
    """Score a block's documents but for alpha.  Kinds of rows: 0 a document; 1 what an owned pair adds to its history's
    sums; 2 how often a document (by its place) needs log10 alpha of a history."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        b = Block(next(left.itertuples(index=False)))
        top, plain = np.uint64(1 << 63), np.uint64((1 << 62) - 1)
        answer1 = _answers(right[right["order"] == 1])
        c1 = (answer1 & plain).astype(np.int64)
        wanted = (answer1 >> np.uint64(62) & np.uint64(1)) != 0
        answer2 = _answers(right[right["order"] == 2])
        owned = (answer2 & top) != 0
        c2 = (answer2 & plain).astype(np.int64)
        del answer1, answer2
        _, place, shown = b.pairs()
        # per distinct word
        p1 = _discount(c1, d1) / mass
        p1[c1 == 0] = p_unseen
        base = np.log10((c1 + 1) / (total + 1 * (vocabulary + 1)))
        # per distinct pair: the count of its history and its token's own probability
        first = np.zeros(len(b.tokens), dtype=bool)
        first[b.begins] = True
        before = np.r_[0, b.tokens[:-1]]
        h_count = np.where(first, starts, c1[before])[shown]
        pair_p1 = p1[b.tokens[shown]]
        seen = c2 > 0
        p2 = np.zeros(len(c2))
        p2[seen] = _discount(c2[seen], d2) / h_count[seen]
        log_p = np.log10(np.where(seen, p2, pair_p1))
        per_token = log_p[place]
        add = lambda x: np.add.reduceat(x, b.begins)  # noqa: E731  (a document has one token at least)
        docs = pd.DataFrame({"kind": 0, "doc_id": b.ids, "known_id": ~b.missing, "held_out": ~b.trained & ~b.missing,
                             "n_tokens": b.lengths, "n_known": add((c1[b.tokens] > 0).astype(np.int64)),
                             "base_score": add(base[b.tokens]), "score": add(per_token)})
        docs["history"] = b.block * (1 << 24) + np.arange(len(docs))      # names the row: ids may repeat
        hist = b.histories().view(np.int64)
        owned &= (first | wanted[before])[shown]
        mine = pd.DataFrame({"history": hist[shown][owned], "amount": p2[owned], "amount2": pair_p1[owned]})
        mine = mine.groupby("history", as_index=False).sum()
        mine["kind"] = 1
        need = ~seen[place] & np.where(first, starts > 0, c1[before] > 0)
        which = np.repeat(np.arange(len(docs)), b.lengths)[need]
        asks = pd.DataFrame({"doc_id": b.block * (1 << 24) + which, "history": hist[need], "amount": 1.0})
        asks = asks.groupby(["doc_id", "history"], as_index=False).sum()
        asks["kind"] = 2
        out = pd.concat([docs, mine, asks], ignore_index=True)
        for c in ("known_id", "held_out"):
            out[c] = out[c].astype("boolean")
        for c in ("doc_id", "n_tokens", "n_known"):
            out[c] = out[c].astype("Int64")
        return out[[f.name for f in _ARROW_SCORED]]
    return run


def katz_scores(spark: SparkSession, docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT,
                block_bytes: int = ex.BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row of ``docs``."""
    blocks = stored(spark, id_and_text(docs, id_col, text_col).mapInArrow(tokenise(folds, held_out, block_bytes), BLOCK), "katz-blocks")
    sizes = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    ones = counted(spark, blocks, 1, sizes[0])
    release(spark)
    twos = counted(spark, blocks, 2, sizes[1])
    release(spark)
    h1, h2 = count_histogram(ones), count_histogram(twos)
    total, vocabulary = h1["total"], h1["entries"]
    d1, d2 = good_turing(h1), good_turing(h2)
    starts = blocks.select("trained").mapInArrow(_trained_documents, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # p(w) of seen tokens adds up to 1 less what the discounts free; with nothing freed, unseen tokens share one count
    freed = sum((1 - d1[r]) * r * h1[f"n{r}"] for r in range(1, len(d1)))
    mass = max(total, 1) if freed > 0 else total + 1
    p_unseen = (freed if freed > 0 else 1.0) / mass
    answers = ones.where("block >= 0").unionByName(twos.where("block >= 0"))
    scored = stored(spark, blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        score_block(total, vocabulary, starts, d1, d2, p_unseen, mass), SCORED), "katz-scored", "kind")
    release(spark)
    alphas = scored.where("kind = 1").groupBy("history").agg(F.sum("amount").alias("kept"), F.sum("amount2").alias("lower"))
    alphas = alphas.select("history", F.log10(
        F.greatest(F.lit(1) - F.col("kept"), F.lit(1e-12)) / F.greatest(F.lit(1) - F.col("lower"), F.lit(1e-12))).alias("log_alpha"))
    extra = (scored.where("kind = 2").select(F.col("doc_id").alias("row"), "history", "amount").join(alphas, "history", "left")
             .groupBy("row").agg(F.sum(F.col("amount") * F.coalesce("log_alpha", F.lit(0.0))).alias("extra")))
    return (scored.where("kind = 0").withColumnRenamed("history", "row").join(extra, "row", "left").select(
        F.when(F.col("known_id"), F.col("doc_id")).alias("doc_id"), "held_out", "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), "base_score",
        (F.col("score") + F.coalesce("extra", F.lit(0.0))).alias("score")))


def _trained_documents(batches):
    for batch in batches:
        n = sum(int((ex.unpack_array(t, np.uint8) & 1).sum()) for t in batch.column("trained").to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])
