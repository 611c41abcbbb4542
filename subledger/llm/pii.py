"""Personal data: patterns, and terms that give a protected value away.

1. Patterns: e-mail addresses, IP addresses, card numbers (Luhn), phone numbers; each match is a protected value.
2. Corpus co-occurrence: every term of a document that holds a value stands beside that value.  Over all documents
       disclosure(t, e) = log2(P(e | t) / P(e)) / -log2 P(e),      P(e) = n(e) / N,
       P(e | t) = (n(t, e) + PRIOR P(e)) / (n(t) + PRIOR)
   is the share of a value's information that a term reveals: 1 if the term implies the value.  n(t) counts the documents with
   the term, n(e) those with the value, n(t, e) those with both.  ``PRIOR`` documents in which the term says nothing of the
   value are added, so that values and terms of a single text are measured too, and by how little is known of them.
   A rare term beside a value in one text proves nothing, however rare: the two must meet in two different texts at least, or
   the term must be a part of the value itself (a name in an address).
3. A term above ``DISCLOSURE`` for any value is masked wherever it stands, in every document: from ``REMOVAL`` on it is removed
   ("term"), below it is generalised to its first letter ("general").

A term is a run of letters and digits of any length; in scripts written without spaces, each two neighbouring characters.

Only hashes of values and terms are shuffled, never the values.  Every step is an aggregate with partial sums or a join with
one row per key on one side; a document's spans meet at the document only.

Defined results: null and empty texts have no spans; repeated rows and null ids are documents of their own; an empty table
gives no rows; extra columns are ignored (and kept by ``sanitise``).
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from subledger.llm.common import BoundedCache, id_and_text, release, stored, texts_of

KINDS = ("email", "ip", "card", "phone")
PRIOR = 0.5            # documents of no evidence added to those with a term
DISCLOSURE = 0.9
REMOVAL = 0.95         # a term of this disclosure is removed; below it, its first letter stays
COUNTER_ENTRIES = 200_000
FILTER_BITS = (28, 30)  # the filter of revealing terms has 1024 bits a term, 2^28 (32 MB) at least and 2^30 (128 MB) at most
CACHE_ENTRIES = 200_000
MARKS = 50_000         # rows of a batch of marks

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a run of digits is entered at its begin only: a start inside it fails or succeeds with the run's begin
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\W_]+")
# Kana and Han characters
_UNSPACED = re.compile("([\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+)")
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards, so that long runs without one cost nothing."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            out.append((begin, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return out


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def _value(kind: str, text: str) -> int:
    """A value's identity: case and separators don't count."""
    return _hash(kind + ":" + (text.lower() if kind in ("email", "ip") else re.sub(r"[^0-9]", "", text)))


def _pieces(run: str) -> list[tuple[int, int]]:
    """(start, end) of the terms of a run of letters and digits."""
    out, at = [], 0
    for i, part in enumerate(_UNSPACED.split(run)):
        end = at + len(part)
        if i % 2 and len(part) > 1:
            out += [(x, x + 2) for x in range(at, end - 1)]
        elif part:
            out.append((at, end))
        at = end
    return out


def runs_of(text: str) -> set[str]:
    """The different terms of a text, as written."""
    runs = set(_TERM.findall(text))
    if not text.isascii() and _UNSPACED.search(text):
        runs = {run[a:b] for run in runs for a, b in _pieces(run)}
    return runs


def places(text: str, terms, spans) -> list[tuple[str, int, int]]:
    """(term, start, end) of ``terms``, given as written, where they stand outside all ``spans``."""
    merged: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    out, i = [], 0
    cut = not text.isascii() and _UNSPACED.search(text)
    for m in _TERM.finditer(text):
        at = m.start()
        for x, y in (_pieces(m.group()) if cut else ((0, m.end() - at),)):
            while i < len(merged) and merged[i][1] <= at + x:
                i += 1
            if (i == len(merged) or at + y <= merged[i][0]) and text[at + x:at + y] in terms:
                out.append((text[at + x:at + y], at + x, at + y))
    return out


FOUND = ("row long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
         "text_hash long, terms array<long>, protected array<long>, own array<long>")
_FOUND = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()),
                    ("base", pa.string()), ("text_hash", pa.int64()),
                    ("terms", pa.list_(pa.int64())), ("protected", pa.list_(pa.int64())), ("own", pa.list_(pa.int64()))])


def find(batches):
    task, n = TaskContext.get().partitionId() << 40, 0
    for batch in batches:
        rows = []
        for doc, raw in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
            text = raw.decode("utf-8", "replace")
            spans = base_spans(text)
            count = Counter(k for k, _, _ in spans)
            base = joined(spans)
            rows.append({"row": task + n, "doc_id": doc, **{f"n_{k}": count[k] for k in KINDS},
                         "base_sha256": hashlib.sha256(base.encode()).hexdigest(), "base": base,
                         "text_hash": xxhash.xxh64_intdigest(raw) - (1 << 63),
                         "terms": sorted({_hash(t.lower()) for t in runs_of(text)}) if spans else [],
                         "protected": sorted({_value(k, text[a:b]) for k, a, b in spans}),
                         "own": sorted({_hash(t.lower()) for _, a, b in spans for t in runs_of(text[a:b])})})
            n += 1
        yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)


def term_documents(batches):
    """Documents with each term: counted within the task, sent on when the counter is full."""
    seen: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array([_hash(t) for t in seen], pa.int64()), pa.array(list(seen.values()), pa.int64())],
                                          ["term", "n"])
    for batch in batches:
        for raw in texts_of(batch):
            seen.update({t.lower() for t in runs_of(raw.decode("utf-8", "replace"))})
            if len(seen) > COUNTER_ENTRIES:
                yield out()
                seen.clear()
    if seen:
        yield out()


def disclosing_terms(found: DataFrame, texts: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """``term, disclosure``: terms that reveal a value beyond the threshold, with the most that they reveal of one.

    Values of the same documents have the same counts with every term and are measured once: a document with any number of
    values of its own has one such group.
    """
    documents = max(found.count(), 1)
    held = found.select("row", F.explode("protected").alias("value"))
    share = F.col("n_value") / F.lit(documents)
    values = held.groupBy("value").agg(F.count("*").alias("n_value"), F.bit_xor(F.xxhash64("row")).alias("rows")).where(share < 1)
    # n(t, e) is at most n(e), so that a term with more documents than this can reveal nothing
    values = values.withColumn("most", (F.col("n_value") + PRIOR * share) / F.pow(share, F.lit(1 - disclosure)) - PRIOR + 1e-6)
    most = values.agg(F.max("most")).first()[0] or 0.0
    groups = held.join(values, "value").select("row", F.xxhash64("rows", "n_value").alias("group"), "n_value", "most").distinct()
    terms = texts.select("text").mapInArrow(term_documents, "term long, n long").groupBy("term").agg(F.sum("n").alias("n_term"))
    rare = found.where(F.size("protected") > 0).select("row", "text_hash", "own", F.explode("terms").alias("term")) \
        .withColumn("own", F.array_contains("own", F.col("term"))) \
        .join(terms.where(F.col("n_term") <= most), "term")
    pairs = rare.join(groups, "row").where(F.col("n_term") <= F.col("most")).groupBy("group", "term").agg(
        F.count("*").alias("n_both"), F.first("n_term").alias("n_term"), F.first("n_value").alias("n_value"),
        F.max("own").alias("own"), F.min("text_hash").alias("least"), F.max("text_hash").alias("greatest")) \
        .where(F.col("own") | (F.col("least") < F.col("greatest")))
    known = (F.col("n_both") + PRIOR * share) / (F.col("n_term") + PRIOR)
    measured = pairs.withColumn("disclosure", (F.log2(known) - F.log2(share)) / -F.log2(share))
    return measured.where(F.col("disclosure") >= disclosure).groupBy("term").agg(F.max("disclosure").alias("disclosure"))


def filter_bits(terms: int) -> int:
    """The filter has two to this power bits."""
    return min(max(FILTER_BITS[0], (1024 * terms).bit_length()), FILTER_BITS[1])


def term_filter(revealing: DataFrame, bits: int) -> bytes:
    """One bit per hash prefix of the terms: of a bounded size, and of no effect on the result, as the marks are joined to the terms."""
    bit = F.shiftrightunsigned("term", 64 - bits)
    slots = revealing.select(F.shiftrightunsigned(bit, 6).alias("slot"), F.expr(
        f"shiftleft(1L, cast(shiftrightunsigned(term, {64 - bits}) & 63 as int))").alias("bits")) \
        .groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << (bits - 6), "<i8")
    words[slots.column("slot").to_numpy()] = slots.column("bits").to_numpy()
    return words.tobytes()


def _marks(filter_, n_bits: int):
    """The places of the terms that pass the filter, of every text."""
    def run(batches):
        bits = filter_.value

        def passes(run_: str) -> bool:
            bit = (_hash(run_.lower()) & ((1 << 64) - 1)) >> (64 - n_bits)
            return bool(bits[bit >> 3] >> (bit & 7) & 1)
        maybe, rows = BoundedCache(passes, CACHE_ENTRIES), []
        for batch in batches:
            for raw in texts_of(batch):
                text = raw.decode("utf-8", "replace")
                terms = {t for t in runs_of(text) if maybe[t]}
                if not terms:
                    continue
                text_hash, hashes = xxhash.xxh64_intdigest(raw) - (1 << 63), {t: _hash(t.lower()) for t in terms}
                for t, a, b in places(text, terms, base_spans(text)):
                    rows.append((text_hash, hashes[t], a, b))
                    if len(rows) >= MARKS:
                        yield _mark_batch(rows)
                        rows = []
        if rows:
            yield _mark_batch(rows)
    return run


def _mark_batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                                      ["text_hash", "term", "a", "b"])


SPANS = "array<struct<a:int,b:int,kind:string>>"


def all_spans(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The stored findings of every row; and by ``text_hash`` the sorted (start, end, kind) ``terms`` of the disclosing terms of every
    text that holds one, beside a value or not."""
    texts = id_and_text(docs, id_col, text_col)
    found = stored(spark, texts.mapInArrow(find, FOUND), "personal-data")
    revealing = stored(spark, disclosing_terms(found, texts), "disclosing-terms")
    release(spark)
    bits = filter_bits(revealing.count())
    if not revealing.take(1):
        return found, spark.createDataFrame([], f"text_hash long, terms {SPANS}")
    filter_ = spark.sparkContext.broadcast(term_filter(revealing, bits))
    marks = texts.select("text").mapInArrow(_marks(filter_, bits), "text_hash long, term long, a int, b int")
    kind = F.when(F.col("disclosure") >= REMOVAL, "term").otherwise("general").alias("kind")
    marked = stored(spark, marks.join(revealing.select("term", kind), "term").groupBy("text_hash").agg(
        F.sort_array(F.collect_set(F.struct("a", "b", "kind"))).alias("terms")), "term-spans")
    filter_.unpersist()
    return found, marked


def personal_data(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The contract columns of the query."""
    found, marked = all_spans(spark, docs)
    terms = F.transform(F.coalesce(marked["terms"], F.array().cast(SPANS)), lambda s: F.concat_ws(":", s["kind"], s["a"], s["b"]))
    return found.join(marked, "text_hash", "left").select(
        "doc_id", *(f"n_{k}" for k in KINDS), "base_sha256",
        F.array_join(F.concat(F.when(F.col("base") == "", F.array().cast("array<string>")).otherwise(F.array("base")), terms), ",")
        .alias("spans"))


def mask(text: str, spans) -> str:
    """The text with every span replaced; overlapping spans are replaced as one, by the first one's kind."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], text[a] + "." if kind == "general" else MASKS[kind]]
        at = max(at, b)
    return "".join(out) + text[at:]


def sanitise(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span masked in its text, all columns kept (``n_chars``, where present, follows the text).

    Patterns are masked where they are found, in one pass over the rows.  Disclosing terms come by a hash of the text:
    equal texts hold equal spans, and only texts that hold one take part in that join.
    """
    spans = all_spans(spark, docs, id_col, text_col)[1].toDF("__hash", "__terms")
    names, schema = docs.columns, docs.schema
    place = [c.lower() for c in names].index(text_col.lower())
    sizes = [i for i, c in enumerate(names) if c.lower() == "n_chars"]

    # seed and input as in ``find``: XXH64 of the UTF-8 text, seed 0, shifted into the signed range
    def patterns(batches):
        for batch in batches:
            yield _masked(batch, names, place, sizes, lambda text, _: base_spans(text))

    def both(batches):
        for batch in batches:
            yield _masked(batch, names, place, sizes,
                          lambda text, terms: base_spans(text) + [(t["kind"], t["a"], t["b"]) for t in terms or ()])

    if not spans.take(1):
        return docs.mapInArrow(patterns, schema)
    # columns travel under numbers, so that no name of theirs can clash
    numbered = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields)] + [StructField("__hash", LongType())])
    keyed = docs.mapInArrow(_with_hash(place), numbered)
    return keyed.join(spans, "__hash", "left").drop("__hash").mapInArrow(both, schema)


def _with_hash(place):
    def run(batches):
        for batch in batches:
            hashes = [xxhash.xxh64_intdigest(t or b"") - (1 << 63) for t in batch.column(place).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes, pa.int64())],
                                              [*(f"c{i}" for i in range(batch.num_columns)), "__hash"])
    return run


def _masked(batch: pa.RecordBatch, names, place, sizes, spans_of) -> pa.RecordBatch:
    columns = list(batch.columns)
    given = columns[len(names)].to_pylist() if len(columns) > len(names) else [None] * batch.num_rows
    columns = columns[:len(names)]
    texts = []
    for raw, terms in zip(columns[place].cast(pa.binary()).to_pylist(), given):
        text = None if raw is None else raw.decode("utf-8", "replace")
        spans = spans_of(text, terms) if text else ()
        while spans:   # what a mask leaves of overlapping digits may match anew
            text = mask(text, spans)
            spans = base_spans(text)
        texts.append(text)
    columns[place] = pa.array(texts, columns[place].type)
    for i in sizes:
        if pa.types.is_integer(columns[i].type):
            columns[i] = pa.array([None if t is None else len(t) for t in texts], columns[i].type)
    return pa.RecordBatch.from_arrays(columns, names)
