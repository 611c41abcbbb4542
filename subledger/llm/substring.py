"""Substring deduplication with suffix automata over reference shards.

A window is 13 consecutive words of one document.  Every word covered by a window whose words also start in a document
with a smaller id is removed; windows are judged on the input.

1. Documents are stored in blocks (see ``exchange``).  Each window has an *anchor*: the least hash of its 6-word parts.
   Equal windows have equal anchors, and neighbouring windows mostly share one.
2. Blocks ask which anchors other documents hold too.  Only runs of windows with such an anchor can be repeated.
3. Reference shards: the shared runs are dealt to shards by anchor, each distinct run of a block once, with its least id.  A
   shard holds all runs that could share a window.  Where an anchor has runs of different words, the shard streams them
   in id order through a word-level suffix automaton: the matching statistic tells which windows an earlier run holds
   and since which document; a run that holds anything new then joins the automaton.
4. Blocks receive the first holder of each window, mark the covered words and hash what is left.

The automata are built where their shard's documents stream, and are not broadcast to all tasks: the reference is the
corpus itself and grows with it, so broadcasting it would send everything everywhere.  A run of words that very many
windows share an anchor with (a common phrase) is dealt by the windows' own hashes instead, so that no shard grows with it.

Defined results: null and empty texts have no words; texts under 13 words lose nothing; repeated rows with one id don't
remove each other; rows with a null id neither lose words nor count as a reference; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm import exchange as ex
from subledger.llm.common import id_and_text, release, stored

WINDOW = 13
PART = 6
HOT_WINDOWS = 50_000     # an anchor with more windows is dealt by window
SHARD_RUNS = 150_000     # runs of one shard, about
AUTOMATON_WORDS = 50_000  # references of several anchors share an automaton up to so many words
_MUL = np.uint64(0x9E3779B97F4A7C15)
_NEVER = np.iinfo(np.int64).max

BLOCK_FIELDS = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("missing", pa.binary()), ("text", pa.binary()),
                          ("n_anchors", pa.int64())])
BLOCK = "block long, ids binary, missing binary, text binary, n_anchors long"


def rolling(h: np.ndarray, span: int) -> np.ndarray:
    """Hash of ``span`` consecutive values from each place on."""
    n = len(h) - span + 1
    r = np.zeros(max(n, 0), dtype=np.uint64)
    for i in range(span if n > 0 else 0):
        r = (r ^ (r >> np.uint64(29))) * _MUL + h[i:n + i]
    return r ^ (r >> np.uint64(32))


class Block:
    """Words of a run of documents, and the anchors of their windows."""

    def __init__(self, ids: np.ndarray, missing: np.ndarray, lines: list[bytes], window: int, part: int):
        self.ids, self.missing = ids, missing
        index: dict[bytes, int] = {}
        split = [line.split() for line in lines]
        self.lengths = np.array([len(w) for w in split], dtype=np.int64)
        words = [w for s in split for w in s]
        del split
        for w in words:
            if w not in index:
                index[w] = len(index)
        place = np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, index), dtype=np.uint64, count=len(index))
        size = np.fromiter(map(len, index), dtype=np.int64, count=len(index))
        self.text = b" ".join(words)
        self.offsets = np.r_[0, np.cumsum(size[place] + 1)] if len(words) else np.zeros(1, dtype=np.int64)
        self.begins = np.r_[0, np.cumsum(self.lengths)[:-1]] if len(ids) else np.zeros(0, dtype=np.int64)
        self.window = window
        h = hashes[place] if len(words) else np.zeros(0, dtype=np.uint64)
        doc = np.repeat(np.arange(len(ids)), self.lengths)
        n = len(words) - window + 1
        if n <= 0:
            self.starts = self.doc = np.zeros(0, dtype=np.int64)
            self.anchors = self.whole = np.zeros(0, dtype=np.uint64)
            return
        inside = (doc[:n] == doc[window - 1:]) & ~missing[doc[:n]]
        self.starts = np.flatnonzero(inside)       # windows, by the place of their first word
        parts = rolling(h, part)
        least = parts[:n]
        for i in range(1, window - part + 1):
            least = np.minimum(least, parts[i:n + i])
        self.anchors = least[self.starts]
        self.whole = rolling(h, window)[self.starts]
        self.doc = doc[self.starts]

    @staticmethod
    def stored(row, window: int, part: int) -> "Block":
        lines = ex.expand(row.text).split(b"\n")
        return Block(ex.unpack_array(row.ids, np.int64), ex.unpack_array(row.missing, np.uint8).astype(bool), lines,
                     window, part)

    def asked(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors; for each its windows here, with the lowest bit set if documents with different ids hold it."""
        order = np.argsort(self.anchors, kind="stable")
        keys, first, count = np.unique(self.anchors[order], return_index=True, return_counts=True)
        if not len(keys):
            return keys, np.zeros(0, dtype=np.uint32)
        ids = self.ids[self.doc][order]
        several = np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)
        return keys, (np.minimum(count, 1 << 30) * 2 + several).astype(np.uint32)

    def runs(self, shared: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Runs of windows to look up: first window (index), number of windows, key, document.  ``shared`` and ``hot``
        tell it per window."""
        at = np.flatnonzero(shared)
        if not len(at):
            none = np.zeros(0, dtype=np.int64)
            return none, none, np.zeros(0, dtype=np.uint64), none
        key = np.where(hot[at], self.whole[at], self.anchors[at])
        fresh = np.r_[True, (np.diff(self.starts[at]) != 1) | (self.doc[at][1:] != self.doc[at][:-1])
                      | (key[1:] != key[:-1]) | hot[at][1:]]
        first = np.flatnonzero(fresh)
        return at[first], np.diff(np.r_[first, len(at)]), key[first], self.doc[at[first]]


def build_blocks(block_bytes: int):
    def run(batches):
        task = TaskContext.get().partitionId() << 24
        for number, (ids, texts) in enumerate(ex.blocks(batches, block_bytes)):
            lines = [b" ".join(t.split()) for t in texts]
            yield pa.RecordBatch.from_pylist([{
                "block": task + number, "ids": ex.pack_array(np.array([i or 0 for i in ids], dtype=np.int64)),
                "missing": ex.pack_array(np.array([i is None for i in ids], dtype=np.uint8)),
                "text": ex.squeeze(b"\n".join(lines)), "n_anchors": sum(x.count(b" ") + 1 for x in lines) // 4}],
                schema=BLOCK_FIELDS)
    return run


# --- 2. which anchors are shared -----------------------------------------------------------------------------------------

def ask_anchors(buckets: int, window: int, part: int):
    fields = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        for batch in batches:
            for row in batch.to_pandas().itertuples(index=False):
                keys, counts = Block.stored(row, window, part).asked()
                yield pa.RecordBatch.from_pylist([
                    {"bucket": b, "block": row.block, "keys": ex.pack_sorted(keys[lo:hi]),
                     "counts": ex.pack_array(ex._bytewise(counts[lo:hi]))} for b, lo, hi in ex.cuts(keys, buckets)],
                    schema=fields)
    return run


def shared_anchors(hot_windows: int):
    """Per block and key: 0 held by one document only, 1 shared, 2 shared and hot; block -1 counts the shared windows."""
    def run(parts: pd.DataFrame) -> pd.DataFrame:
        keys = [ex.unpack_sorted(k) for k in parts["keys"]]
        counts = [_planes(c, np.uint32) for c in parts["counts"]]
        lengths = [len(k) for k in keys]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        every = np.concatenate(counts).astype(np.int64)
        blocks = np.bincount(place, minlength=len(distinct))
        several = np.bincount(place, weights=every & 1, minlength=len(distinct)) > 0
        windows = np.bincount(place, weights=every >> 1, minlength=len(distinct))
        shared = (blocks > 1) | several
        state = (shared.astype(np.uint8) + (shared & (windows > hot_windows)))[place].astype(np.uint8)
        at = np.r_[0, np.cumsum(lengths)]
        bucket = int(parts["bucket"].iloc[0])
        rows = [(bucket, -1, b"", int(windows[shared].sum()))]
        rows += [(bucket, int(k), ex.pack_array(state[a:b]), 0) for k, a, b in zip(parts["block"], at, at[1:])]
        return pd.DataFrame(rows, columns=["bucket", "block", "answer", "n"])
    return run


def _planes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = ex.unpack_array(data, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


# --- 3. reference shards -------------------------------------------------------------------------------------------------

RUNS = "kind int, bucket int, block long, keys binary, numbers binary, contents binary"


def emit_runs(buckets: int, window: int, part: int):
    """Kind 0: a block's distinct shared runs per shard (key, least id, words).  Kind 1: its runs, for step 4."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        b = Block.stored(next(left.itertuples(index=False)), window, part)
        block = int(left["block"].iloc[0])
        keys, _ = b.asked()
        state = np.concatenate([ex.unpack_array(a, np.uint8) for a in right.sort_values("bucket")["answer"]]) \
            if len(right) else np.zeros(0, dtype=np.uint8)
        per_window = state[np.searchsorted(keys, b.anchors)] if len(keys) else np.zeros(0, dtype=np.uint8)
        first, number, key, doc = b.runs(per_window > 0, per_window > 1)
        begin = b.offsets[b.starts[first]].tolist()
        end = (b.offsets[b.starts[first] + number - 1 + window] - 1).tolist()
        text, seen = b.text, {}
        place = np.fromiter((seen.setdefault(text[x:y], len(seen)) for x, y in zip(begin, end)), dtype=np.int64,
                            count=len(first))
        contents = list(seen)
        least = np.full(len(contents), _NEVER, dtype=np.int64)
        np.minimum.at(least, place, b.ids[doc])
        content_key = np.zeros(len(contents), dtype=np.uint64)
        content_key[place] = key
        windows = np.zeros(len(contents), dtype=np.int64)
        windows[place] = number
        order = np.argsort(content_key, kind="stable")
        rows = []
        for bucket, lo, hi in ex.cuts(content_key[order], buckets):
            part_order = order[lo:hi]
            rows.append((0, bucket, block, ex.pack_sorted(content_key[part_order]),
                         ex.pack_array(ex._bytewise(least[part_order])),
                         ex.squeeze(b"\n".join([contents[i] for i in part_order.tolist()]))))
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        rows.append((1, 0, block, ex.pack_array(ex._bytewise(np.stack([first, number, rank[place]]).ravel().astype(np.int32))),
                     ex.pack_array(windows[order].astype(np.int32)), b""))
        return pd.DataFrame(rows, columns=["kind", "bucket", "block", "keys", "numbers", "contents"])
    return run


class SuffixAutomaton:
    """A generalised suffix automaton over words, grown document by document in id order.

    ``since[s]`` is the first document that holds the strings of state s.
    """

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.since = [-1], [0], [_NEVER]
        self.words = 0

    def _state(self, length: int, link: int, arcs: dict, since: int) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        self.since.append(since)
        return len(self.link) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """Separate from state q the strings that end with p's and ``word``."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]), self.since[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list[int], doc: int) -> None:
        last = 0
        self.words += len(words)
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                last = self._split(last, word, q)
                continue
            new = self._state(self.length[last] + 1, 0, {}, doc)
            p = last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, word, self.next[p][word])
            last = new

    def holders(self, words: list[int], window: int) -> list[int]:
        """Matching statistics, cut off at ``window``: per window of ``words`` the first document that holds it."""
        out = []
        state = matched = 0
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                matched += 1
            while self.length[self.link[state]] >= window if state else False:
                state = self.link[state]
            matched = min(matched, window) if state else 0
            if i >= window - 1:
                out.append(self.since[state] if matched >= window else _NEVER)
        return out


def shard(window: int, automaton_words: int):
    """One reference shard: first holder of every window of every run that came in."""
    def run(parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("block", kind="stable")
        index: dict[bytes, int] = {}
        places, key_of, ids = [], [], []
        for keys, numbers, contents in zip(parts["keys"], parts["numbers"], parts["contents"]):
            lines = ex.expand(contents).split(b"\n")
            place = np.fromiter((index.setdefault(x, len(index)) for x in lines), dtype=np.int64, count=len(lines))
            places.append(place)
            key_of.append(ex.unpack_sorted(keys))
            ids.append(_planes(numbers, np.int64))
        place, every_key, every_id = map(np.concatenate, (places, key_of, ids))
        n = len(index)
        least = np.full(n, _NEVER, dtype=np.int64)
        np.minimum.at(least, place, every_id)
        key = np.zeros(n, dtype=np.uint64)
        key[place] = every_key
        contents = list(index)
        del index
        windows = np.fromiter((c.count(b" ") for c in contents), dtype=np.int64, count=n) + 2 - window
        at = np.r_[0, np.cumsum(windows)]
        first = np.repeat(least, windows)             # an anchor's only run: its first document holds all its windows
        order = np.lexsort((least, key))
        automaton, vocabulary = SuffixAutomaton(), {}
        edges = np.r_[np.flatnonzero(np.r_[True, np.diff(key[order]) != 0]), n] if n else np.zeros(1, dtype=np.int64)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if b - a == 1:
                continue
            if automaton.words > automaton_words:   # runs of other anchors share no window with these
                automaton, vocabulary = SuffixAutomaton(), {}
            for c in order[a:b].tolist():
                words = [vocabulary.setdefault(w, len(vocabulary)) for w in contents[c].split(b" ")]
                doc = int(least[c])
                held = np.array(automaton.holders(words, window), dtype=np.int64)
                first[at[c]:at[c + 1]] = np.minimum(held, doc)
                if (held == _NEVER).any():
                    automaton.add(words, doc)
        bucket, rows = int(parts["bucket"].iloc[0]), []
        for block, mine in zip(parts["block"], places):
            sizes = windows[mine]
            spread = np.repeat(at[:-1][mine] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(int(sizes.sum()))
            rows.append((bucket, int(block), ex.pack_array(ex._bytewise(first[spread]))))
        return pd.DataFrame(rows, columns=["bucket", "block", "answer"])
    return run


# --- 4. removal ------------------------------------------------------------------------------------------------------------

def remove(window: int, part: int, with_text: bool):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        b = Block.stored(next(left.itertuples(index=False)), window, part)
        plan = right[right["bucket"] < 0].iloc[0]
        first, number, rank = _planes(plan["keys"], np.int32).reshape(3, -1).astype(np.int64)
        sizes = ex.unpack_array(plan["numbers"], np.int32).astype(np.int64)
        answers = right[right["bucket"] >= 0].sort_values("bucket")["answer"]
        holder = np.concatenate([_planes(a, np.int64) for a in answers]) if len(answers) else np.zeros(0, dtype=np.int64)
        at = np.r_[0, np.cumsum(sizes)]
        total = int(number.sum())
        steps = np.arange(total) - np.repeat(np.r_[0, np.cumsum(number)[:-1]], number) if total else np.zeros(0, dtype=np.int64)
        which = np.repeat(first, number) + steps
        held = holder[np.repeat(at[rank], number) + steps] if total else holder
        gone = which[held < b.ids[b.doc[which]]] if total else which
        change = np.zeros(len(b.offsets) + window, dtype=np.int64)
        np.add.at(change, b.starts[gone], 1)
        np.add.at(change, b.starts[gone] + window, -1)
        covered = np.cumsum(change) > 0
        text, rows = b.text, []
        for i, (begin, n) in enumerate(zip(b.begins.tolist(), b.lengths.tolist())):
            mine = covered[begin:begin + n]
            removed = int(mine.sum())
            if removed == n:
                kept = b""
            elif not removed:
                kept = text[b.offsets[begin]:b.offsets[begin + n] - 1]
            else:   # maximal spans of kept words
                change_at = np.flatnonzero(np.diff(np.r_[True, mine, True].astype(np.int8)))
                kept = b" ".join(text[b.offsets[begin + x]:b.offsets[begin + y] - 1]
                                 for x, y in zip(change_at[::2].tolist(), change_at[1::2].tolist()))
            row = (None if b.missing[i] else int(b.ids[i]), n, removed, hashlib.sha256(kept).hexdigest())
            rows.append(row + (kept.decode("utf-8", "replace"),) if with_text else row)
        out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text)
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out
    return run


def substring_dedup(spark: SparkSession, docs: DataFrame, window: int = WINDOW, part: int = PART, with_text: bool = False,
                    hot_windows: int = HOT_WINDOWS, shard_runs: int = SHARD_RUNS, automaton_words: int = AUTOMATON_WORDS,
                    block_bytes: int = ex.BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (and ``kept_text``) per row of ``docs``."""
    blocks = stored(spark, id_and_text(docs, id_col, text_col).mapInArrow(build_blocks(block_bytes), BLOCK), "substring-blocks")
    buckets = ex.buckets_for(blocks.agg(F.coalesce(F.sum("n_anchors"), F.lit(0))).first()[0])
    asked = blocks.mapInArrow(ask_anchors(buckets, window, part), "bucket int, block long, keys binary, counts binary")
    anchors = stored(spark, asked.groupBy("bucket").applyInPandas(
        shared_anchors(hot_windows), "bucket int, block long, answer binary, n long"), "substring-anchors")
    release(spark)
    windows = anchors.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = 1
    while shards * shard_runs < windows // 4:
        shards *= 2
    runs = stored(spark, blocks.groupBy("block").cogroup(anchors.where("block >= 0").groupBy("block")).applyInPandas(
        emit_runs(shards, window, part), RUNS), "substring-runs", "kind")
    release(spark)
    answers = stored(spark, runs.where("kind = 0").groupBy("bucket").applyInPandas(
        shard(window, automaton_words), "bucket int, block long, answer binary"), "substring-holders")
    release(spark)
    plans = runs.where("kind = 1").select(F.lit(-1).alias("bucket"), "block", F.lit(None).cast("binary").alias("answer"),
                                          "keys", "numbers")
    given = answers.select("bucket", "block", "answer", F.lit(None).cast("binary").alias("keys"),
                           F.lit(None).cast("binary").alias("numbers")).unionByName(plans)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return blocks.groupBy("block").cogroup(given.groupBy("block")).applyInPandas(remove(window, part, with_text), schema)
