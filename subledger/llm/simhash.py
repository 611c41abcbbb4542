"""SimHash near-duplicates: 64-bit fingerprints linked at a small Hamming distance, grouped into components.

1. Fingerprints: one pass over the texts; equal fingerprints are one node from then on, so thousands of copies
   cost one row.
2. Candidates: the 64 bits are cut into five blocks; two fingerprints within distance 3 agree on at least two of them.  So
   each node goes into ten tables keyed by a pair of blocks, and only nodes that share a key are compared.
3. Comparison, bit-sliced: a key's nodes are stored vertically, one big integer per bit plane.  A query is compared with a
   whole block of nodes at once: per plane one XOR, added into carry-save counters; a block is left as soon as all
   its nodes exceed the radius.  Keys with many nodes are cut into chunks, and every pair of chunks is one bounded
   unit of work: no group is collected whole, and no link is lost.
4. Units report which nodes they link as stars around the smallest node, never all pairs.
5. Components: alternating star contraction of the links, each round stored under the checkpoint folder.

Defined results: a text without words has fingerprint zero and links like any other; a text of fewer words than a shingle is
one shingle; null texts count as empty.  Rows with a null doc_id get a fingerprint and a null component of their own.
Repeated ids are one document per row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import id_and_text, release, stored, texts_of

SHINGLE = 3
RADIUS = 3
SEED = 42
CHUNK = 2048       # nodes of one key compared in one unit of work, at most twice so many
PLANE_BLOCK = 2048  # nodes in one bit-sliced block
MAX_ROUNDS = 64    # rounds grow with the logarithm of the longest path of links
_U64 = (1 << 64) - 1


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority of the bits of the shingles' XXH64 hashes."""
    words = text.lower().split()   # bytes: A-Z only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = len(words) - shingle + 1
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), grams), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for a in range(0, n, 255):   # at most 255 rows add up in one byte
        part = np.unpackbits(hashes[a:a + 255].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += np.add.reduce(part, axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as signed 64-bit) for rows of ``id_and_text``."""
    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in texts_of(batch)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps)], ["doc_id", "fp"])
    return docs.mapInArrow(run, "doc_id long, fp long")


def blocks_of(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of the ``radius + 2`` blocks; at least two of them hold no differing bit."""
    n = radius + 2
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def candidate_units(nodes: DataFrame, radius: int, chunk: int = CHUNK) -> DataFrame:
    """``unit, fp, node, side``: nodes that share a key, dealt into units of at most ``2 * chunk`` nodes on average.

    ``side`` 0: compared within the unit; sides 1 and 2: the two chunks of a crossed pair.
    """
    cuts = blocks_of(radius)
    keys = []
    for t, ((s1, w1), (s2, w2)) in enumerate(combinations(cuts, 2)):
        low = F.shiftrightunsigned("fp", s1).bitwiseAND((1 << w1) - 1)
        high = F.shiftrightunsigned("fp", s2).bitwiseAND((1 << w2) - 1)
        keys.append(F.struct(F.lit(t).cast("short").alias("t"), (low * (1 << w2) + high).alias("k")))
    keyed = nodes.select("fp", "node", F.inline(F.array(*keys)))
    counts = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1")
    dealt = keyed.join(counts, ["t", "k"]).withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int")) \
        .withColumn("mine", F.pmod(F.xxhash64("fp"), "chunks").cast("int"))
    pair = F.struct(F.least("other", "mine").alias("a"), F.greatest("other", "mine").alias("b"))
    units = (dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select(F.struct("t", "k", pair.alias("p")).alias("u"), "fp", "node",
                     F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1)
                     .otherwise(2).cast("byte").alias("side")))
    return units.select(F.xxhash64("u").alias("unit"), F.col("u.k").alias("key"), "fp", "node", "side")


class BitPlanes:
    """A block of fingerprints stored vertically: plane b holds bit b of every fingerprint, as one big integer."""

    def __init__(self, fps: np.ndarray):
        n = len(fps)
        bits = np.unpackbits(fps.astype(">u8").view(np.uint8).reshape(n, 8), axis=1)          # n x 64
        packed = np.packbits(bits.T, axis=1, bitorder="little")                               # 64 x n/8
        self.planes = [int.from_bytes(row.tobytes(), "little") for row in packed]
        self.full = (1 << n) - 1
        #: planes whose bits are most evenly split tell fingerprints apart soonest
        self.order = sorted(range(64), key=lambda b: abs(int(bits[:, b].sum()) * 2 - n))

    def within(self, fp: int, radius: int, among: int) -> int:
        """The members of ``among`` within ``radius`` of ``fp``, as a bit set.

        A counter per member runs in carry-save form: ``count[j]`` holds bit j of all counters.  Counters start so high
        that the (radius + 1)-th difference overflows, which marks the member as exceeded.
        """
        width = radius.bit_length()
        start = (1 << width) - 1 - radius
        count = [among if start >> j & 1 else 0 for j in range(width)]
        alive = among
        for b in self.order:
            carry = (self.planes[b] ^ (self.full if fp >> (63 - b) & 1 else 0)) & alive
            for j in range(width):
                if not carry:
                    break
                count[j], carry = count[j] ^ carry, count[j] & carry
            if carry:
                alive &= ~carry
                if not alive:
                    return 0
        return alive


class Forest:
    """Union-find over node ids; the root of a tree is its smallest node."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    def link(self, x: int, y: int) -> None:
        a, b = self.root(x), self.root(y)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def stars(self) -> list[tuple[int, int]]:
        """Every other node of a tree with its root: no large node is a hub of links to smaller ones."""
        return [(x, top) for x in list(self.parent) if (top := self.root(x)) != x]


def _members(bits: int):
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def compare_rows(unit: np.ndarray, fps: np.ndarray, nodes: np.ndarray, side: np.ndarray, radius: int, forest: Forest):
    """Compare the rows of whole units, sorted by unit and side, block by block."""
    n = len(unit)
    first = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
    last = np.r_[first[1:], n]
    length = last - first
    begin = np.repeat(first, length)
    end = np.repeat(last, length)
    alone = np.repeat(length == 1, length)
    values = fps.tolist()
    ids = nodes.tolist()
    sides = side.tolist()
    seconds = np.repeat(np.add.reduceat(side == 2, first) if n else first, length)
    for a in range(0, n, PLANE_BLOCK):
        b = min(n, a + PLANE_BLOCK)
        if alone[a:b].all():
            continue
        planes = BitPlanes(fps[a:b])
        # queries: rows whose unit reaches into this block, before the row compared with
        for q in range(int(begin[a]), b):
            lo, hi = max(q + 1, a), min(int(end[q]), b)
            if lo >= hi:
                continue
            if sides[q]:   # crossed chunks: side 1 meets side 2 only
                if sides[q] == 2:
                    continue
                lo = max(lo, int(end[q]) - int(seconds[q]))
                if lo >= hi:
                    continue
            among = ((1 << (hi - lo)) - 1) << (lo - a)
            for j in _members(planes.within(values[q], radius, among)):
                forest.link(ids[q], ids[a + j])


def linked(units: DataFrame, radius: int) -> DataFrame:
    """``u, v``: what the units link, as stars around the smallest node."""
    def run(batches):
        held: list[pa.Table] = []
        rows = 0

        def flush(table: pa.Table):
            forest = Forest()
            compare_rows(*(table.column(c).to_numpy() if c != "fp" else table.column(c).to_numpy().view(np.uint64)
                           for c in ("unit", "fp", "node", "side")), radius, forest)
            if stars := forest.stars():
                u, v = zip(*stars)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            rows += batch.num_rows
            if rows < 16 * PLANE_BLOCK:
                continue
            table = pa.concat_tables(held).combine_chunks()
            unit = table.column("unit").to_numpy()
            whole = int(np.searchsorted(unit, unit[-1], side="left"))   # the last unit may go on
            if whole:
                yield from flush(table.slice(0, whole).combine_chunks())
            held, rows = [table.slice(whole)], len(unit) - whole
        if rows:
            yield from flush(pa.concat_tables(held).combine_chunks())

    ordered = units.select("unit", "fp", "node", "side").repartition("unit").sortWithinPartitions("unit", "side", "fp")
    return ordered.mapInArrow(run, "u long, v long")


def components(spark: SparkSession, links: DataFrame, name: str = "star") -> DataFrame:
    """``node, component``: the smallest node reachable, for every node that has a link.

    Alternating large-star and small-star rounds; partial minima keep hub nodes cheap, and every round is stored.
    """
    edges = stored(spark, links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .where("u > v").distinct(), f"{name}0")
    state = None
    for i in range(1, MAX_ROUNDS + 1):
        both = edges.union(edges.select("v", "u"))
        # stored, so that the join below has exchanges of its own, which a hub's rows can be split in
        low = stored(spark, both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")),
                     f"{name}low{i}")
        # large star: larger neighbours of u move to u's minimum
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(low, "u").select("w", "m")
        # small star: u and its smaller neighbours move to u's minimum
        small_low = large.groupBy("w").agg(F.min("m").alias("n"))
        small = large.join(small_low, "w")
        moved = small.select(F.col("m").alias("u"), F.col("n").alias("v")).union(small.select(F.col("w").alias("u"), F.col("n").alias("v")))
        edges = stored(spark, moved.where("u > v").distinct(), f"{name}{i}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"the components have not settled within {MAX_ROUNDS} rounds")
    # the smallest node of a component is on the right of its links only
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)


def grouped(spark: SparkSession, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fp, component, component_id`` of every fingerprint of rows with an id: the smallest fingerprint and the smallest doc_id
    reachable.  Nodes are fingerprints, so rows that repeat an id with unlike texts join nothing."""
    nodes = stored(spark, prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("first"))
                   .withColumn("node", F.col("fp")), "nodes")
    parts = components(spark, linked(candidate_units(nodes, radius), radius))
    named = nodes.join(parts, "node", "left")
    smallest = named.where("component IS NOT NULL").groupBy("component").agg(F.min("first").alias("smallest"))
    release(spark)
    return named.join(smallest, "component", "left").select(
        "fp", F.coalesce("component", "node").alias("component"), F.coalesce("smallest", "first").alias("component_id"))


def near_duplicates(spark: SparkSession, docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs``."""
    prints = stored(spark, fingerprints(id_and_text(docs, id_col, text_col), shingle), "fingerprints")
    return prints.join(grouped(spark, prints, radius), "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one(spark: SparkSession, docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their component: the one with its smallest id.  Of rows that repeat that id in
    one component one is kept; rows of one id in several components stand for each; rows with a null id are kept."""
    prints = stored(spark, fingerprints(id_and_text(docs, id_col, text_col), shingle), "fingerprints")
    found = prints.where("doc_id IS NOT NULL").join(grouped(spark, prints, radius), "fp")
    first = stored(spark, found.where("doc_id = component_id").select(F.col("doc_id").alias("__kept"), "fp", "component").distinct(), "kept")
    names = docs.columns
    key = docs[id_col].cast("long")
    rows = docs.select(F.struct(*(docs[c] for c in names)).alias("row"), F.coalesce(docs[text_col], F.lit("")).alias("text"),
                       key.alias("__key"))
    # the kept ids grow with the input: one plan at every size, never a broadcast
    mine = rows.join(first.select("__kept").distinct().hint("merge"), F.col("__key") == F.col("__kept"), "left_semi")
    repeated = rows.groupBy("__key").agg(F.count("*").alias("__n")).where("__n > 1 AND __key IS NOT NULL").select("__key")
    if repeated.take(1):   # rows of one id: those of each component are told apart by their fingerprints
        several = mine.join(repeated, "__key", "left_semi").withColumn("doc_id", F.xxhash64("__key", "text"))
        again = fingerprints(several.select("doc_id", "text"), shingle).distinct().withColumnRenamed("fp", "__fp")
        several = several.join(again, "doc_id").join(
            first, (F.col("__key") == F.col("__kept")) & (F.col("__fp") == F.col("fp"))).groupBy("component").agg(
            F.min_by("row", F.struct("__fp", F.xxhash64(F.to_json("row")))).alias("row")).select("row")
        mine = mine.join(repeated, "__key", "left_anti").select("row").unionByName(several)
    return mine.select("row").unionByName(rows.where("__key IS NULL").select("row")).select("row.*")
