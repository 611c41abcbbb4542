"""Quality scores learned from preference pairs (Bradley-Terry), cut at a score quantile.

1. Features of every whole text, in one pass; they are stored, so the texts are read once.
2. Every labelled training row is learned from.  Each row of the larger class is paired with several rows of the other one, and
   each row of the smaller class is used about equally often; the loss of a pair is
   -log sigmoid(w . (x_preferred - x_rejected)), solved by Newton steps with a ridge.  Only feature differences enter, so there
   is no intercept.  Pairs meet by a shuffle and are stored; a step is one pass over them, whose tasks send one gradient and
   one Hessian each (420 numbers) to the driver.
3. The cut is the exact quantile of all training scores at the share of rejected rows, found by counting scores in ever finer
   ranges; the score is sigmoid(raw - cut + logit(0.7)), so 0.7 is the cut.

Labels, language, source and id never enter a score.

Defined results: null and empty texts have all features 0; null ids are scored, never learned from; rows without a label are
scored; with labels of one class only, or none, every score is 0.5; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math
import zlib
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import id_and_text, id_remainder, stored, texts_of

FOLDS, HELD_OUT = 4, 2
PAIRS_PER_ROW = 8
STEPS = 30             # Newton steps at most; they settle after about ten
RANGES = 1000          # ranges that scores are counted in at once
RIDGE = 1e-3
CUT = 0.7

_NOT_UPPER = bytes(set(range(256)) - set(range(ord("A"), ord("Z") + 1)))
_NOT_LOWER = bytes(set(range(256)) - set(range(ord("a"), ord("z") + 1)))
_NOT_DIGIT = bytes(set(range(256)) - set(range(ord("0"), ord("9") + 1)))
_NOT_SYMBOL = bytes(set(range(256)) - set(b"#*$%&|<>{}[]=_~^\\/@"))
_NOT_MARK = bytes(set(range(256)) - set(b"!?"))
_NOT_POINT = bytes(set(range(256)) - set(b".,;:"))

FEATURES = ("few_words", "log_words", "word_length", "upper", "digits", "symbols", "marks", "points", "line_length",
            "same_lines", "distinct", "stutter", "ratio", "ratio_low", "top_word", "stutter_any", "upper_high", "symbols_high",
            "same_lines_high", "distinct_low")


def features(text: bytes) -> list[float]:
    """Shares and lengths that describe a text's form; every value is finite and about 0 to 5."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = len(text)
    upper = len(text.translate(None, _NOT_UPPER))
    lower = len(text.translate(None, _NOT_LOWER))
    symbols = len(text.translate(None, _NOT_SYMBOL)) / n
    lines = [line for line in text.split(b"\n") if line.strip()]
    same = 1 - len(set(lines)) / max(len(lines), 1)
    distinct = len(set(words)) / n ** 0.9
    stutter = sum(map(eq, words, words[1:])) / n
    ratio = len(zlib.compress(text, 1)) / (size + 64)
    capital = upper / (upper + lower + 1)
    return [max(0.0, 1 - n / 40), math.log1p(n) / 5, (size - n) / n / 6, capital, 10 * len(text.translate(None, _NOT_DIGIT)) / size,
            min(symbols, 3), min(10 * len(text.translate(None, _NOT_MARK)) / n, 5), 5 * len(text.translate(None, _NOT_POINT)) / n,
            math.log1p(n / max(len(lines), 1)) / 3, same, distinct, 3 * stutter, 2 * ratio, max(0.0, 1 - 4 * ratio),
            0.0 if n < 20 else max(0.0, 1 - 2 * distinct), float(stutter > 0.1), float(capital > 0.3), float(symbols > 0.08),
            float(same > 0.4), float(distinct < 0.35 and n >= 20)]


def feature_table(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            rows = [features(t) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "x"])
    return docs.mapInArrow(run, "doc_id long, x array<double>")


def labelled_pairs(spark: SparkSession, train: DataFrame, n_good: int, n_bad: int, per_row: int = PAIRS_PER_ROW) -> DataFrame:
    """``d``, the feature differences preferred - rejected: each row of the larger class with ``per_row`` rows of the smaller.

    Rows are numbered by hash order (``ranked``); row i of the larger class meets rows ``i * per_row + j`` of the smaller, counted
    round, so that every row of both classes is in some pair and no row of the smaller is in many more than another.
    """
    few_class, few_rows = (1, n_good) if n_good <= n_bad else (0, n_bad)
    many = ranked(spark, train.where(F.col("y") == 1 - few_class), "many")
    few = ranked(spark, train.where(F.col("y") == few_class), "few").select(F.col("number").alias("slot"), F.col("x").alias("other"))
    slots = F.transform(F.sequence(F.lit(0), F.lit(per_row - 1)),
                        lambda j: F.pmod(F.col("number") * per_row + j, F.lit(few_rows)))
    met = many.select("x", F.explode(slots).alias("slot")).join(few, "slot")
    good, bad = ("other", "x") if few_class else ("x", "other")
    return met.select(F.zip_with(good, bad, lambda g, r: g - r).alias("d"))


def ranked(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """``x`` and a gapless ``number`` from 0 by hash order; rows are sorted and counted range by range, never in one task."""
    ordered = rows.select("x", F.xxhash64("doc_id", "x").alias("h")).repartitionByRange("h").sortWithinPartitions("h")
    placed = stored(spark, ordered.select("x", F.spark_partition_id().alias("part"),
                                          F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")), name)
    counts = placed.groupBy("part").count().orderBy("part").collect()   # a row per task
    before, starts = 0, []
    for r in counts:
        starts.append((r["part"], before))
        before += r["count"]
    first = spark.createDataFrame(starts, "part int, first long")
    return placed.join(F.broadcast(first), "part").select("x", (F.col("first") + F.col("at")).alias("number"))


def fit_pairs(pairs: DataFrame, size: int, ridge: float = RIDGE, steps: int = STEPS) -> np.ndarray:
    """Bradley-Terry weights: logistic loss on the feature differences ``d`` of (preferred, rejected) pairs."""
    w = np.zeros(size)
    for _ in range(steps):
        parts = [np.array(r["sums"]) for r in pairs.mapInArrow(_newton_sums(w), "sums array<double>").collect()]
        if not parts:
            return w
        total = np.sum(parts, axis=0)
        n = total[0]
        gradient = total[1:1 + size] / n - ridge * w
        hessian = total[1 + size:].reshape(size, size) / n + ridge * np.eye(size)
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-7:
            break
    return w


def _newton_sums(w: np.ndarray):
    """Of a task's pairs: their number, the gradient's sum, the Hessian's."""
    def run(batches):
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            d = batch.column("d").flatten().to_numpy().reshape(batch.num_rows, len(w))
            p = 1 / (1 + np.exp(np.clip(d @ w, -35, 35)))        # chance given to the wrong order
            sums = np.concatenate([[len(d)], d.T @ p, ((d * (p * (1 - p))[:, None]).T @ d).ravel()])
            total = sums if total is None else total + sums
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])
    return run


def value_at(scores: DataFrame, rank: int) -> float:
    """The value of column ``raw`` at ``rank`` (from 1) in rising order: the range that holds it is cut into ever finer ones."""
    low, high = scores.agg(F.min("raw"), F.max("raw")).first()
    below = 0        # rows under `low`
    while low < high:
        width = (high - low) / RANGES
        inside = scores.where((F.col("raw") >= low) & (F.col("raw") <= high))
        place = F.least(F.floor((F.col("raw") - low) / width), F.lit(RANGES - 1)) if width > 0 else (F.col("raw") > low).cast("long")
        counts = inside.groupBy(place.alias("range")).agg(
            F.count("*").alias("n"), F.min("raw").alias("low"), F.max("raw").alias("high")).orderBy("range").collect()
        for r in counts:
            if below + r["n"] >= rank:
                low, high = r["low"], r["high"]
                break
            below += r["n"]
    return low


def _dot(x: Column, weights: np.ndarray) -> Column:
    return sum((x[i] * float(w) for i, w in enumerate(weights)), F.lit(0.0))


def quality_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame, label_col: str = "quality",
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``."""
    table = stored(spark, feature_table(id_and_text(docs, id_col, text_col)), "features")
    held_out = F.coalesce(id_remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    known = labels.select(labels[id_col].cast("long").alias("label_id"), labels[label_col].cast("int").alias("y")) \
        .where("label_id IS NOT NULL AND y IN (0, 1)").where(id_remainder(F.col("label_id"), FOLDS) != HELD_OUT)
    train = stored(spark, table.join(known, F.col("doc_id") == F.col("label_id")).select("doc_id", "x", "y"), "labelled")
    n, n_good = train.agg(F.count("*"), F.count_if(F.col("y") == 1)).first()
    n_bad = n - n_good
    score = F.lit(0.5)
    if n_good and n_bad:
        weights = fit_pairs(stored(spark, labelled_pairs(spark, train, n_good, n_bad), "pairs"), len(FEATURES))
        if weights.any():
            raws = stored(spark, train.select(_dot(F.col("x"), weights).alias("raw")), "raws")
            cut = (value_at(raws, n_bad) + value_at(raws, n_bad + 1)) / 2   # as many training rows above it as are preferred
            shift = math.log(CUT / (1 - CUT)) - cut
            score = F.lit(1.0) / (F.lit(1.0) + F.exp(-(_dot(F.col("x"), weights) + F.lit(shift))))
    return table.select("doc_id", held_out.alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int"))
