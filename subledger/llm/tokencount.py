"""Token counts through a two-tier lookup inside the map tasks; no pre-token is shuffled.

Tier 1 is a broadcast table of the most frequent pre-tokens and their token counts, at most ``TABLE_ENTRIES`` entries
whatever the corpus.  Tier 2 is a bounded cache in each Python worker for the rest; what neither holds is encoded
by the tokenizer library.

The frequent pre-tokens come from a first pass over all texts: each task counts its own and reports its commonest
``TASK_ENTRIES``; only these summaries meet.  A summary decides speed alone, never a count.

Texts are cut where the vocabulary's own splitting cuts as well: before the last white-space character of a run and around
every run of visible characters, so the parts' token counts add up to the text's.  A text that holds a special
token's string goes to the library whole.

Defined results: null and empty texts count 0 bytes and 0 tokens; repeated rows, null ids and extra columns pass through;
an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import BoundedCache, byte_letters, id_and_text, texts_of

TABLE_ENTRIES = 1 << 16
TASK_ENTRIES = 1 << 14
COUNTER_ENTRIES = 1 << 18
CACHE_ENTRIES = 1 << 18
LIMIT = 1024

#: Unicode White_Space, as the tokenizer's pattern reads it.
_WS = r"\t-\r \x85\xa0  -     　"
PRE_TOKEN = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """Token counts by the library named by the file's ending: of texts, and of pre-tokens."""

    def __init__(self, path: str):
        if path.endswith(".json"):
            import os
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            import public_tokenizers
            from tokenizers import Tokenizer
            self.tokenizer = Tokenizer.from_file(path)
            self.specials = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
            self.finer, self.letters = regex.compile(public_tokenizers.PATTERN), byte_letters()
            self.count = lambda text: len(self.tokenizer.encode(text, add_special_tokens=False).ids)
            self.split, self.cache = PRE_TOKEN.findall, BoundedCache(self._pre_token, CACHE_ENTRIES)
        else:
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.specials = ()
            self.count = lambda text: len(sp.encode(text, num_threads=1))
            self.split = lambda text: [text]   # merges may cross blanks, so a text is one unit
            self.cache = BoundedCache(self.count, 1000)

    def _pre_token(self, text: str) -> int:
        if max(text) >= "\u0250":
            return self.count(text)
        return sum(len(self.tokenizer.model.tokenize(part.encode().decode("latin-1").translate(self.letters)))
                   for part in self.finer.findall(text))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def summarise(path: str):
    """Per task: its commonest pre-tokens.  The counter is trimmed when it grows, so memory stays bounded."""
    def run(batches):
        enc, seen = encoder(path), Counter()
        for batch in batches:
            for text in texts_of(batch):
                seen.update(enc.split(text.decode("utf-8", "replace")))
                if len(seen) > COUNTER_ENTRIES:
                    seen = Counter(dict(seen.most_common(COUNTER_ENTRIES // 2)))
        top = [(t, n) for t, n in seen.most_common(TASK_ENTRIES) if len(t) <= 64]
        if top:
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in top], pa.string()),
                                              pa.array([n for _, n in top], pa.int64())], ["pre_token", "n"])
    return run


def frequent_lengths(texts: DataFrame, path: str) -> dict[str, int]:
    """Token counts of the corpus's commonest pre-tokens, at most :data:`TABLE_ENTRIES`."""
    top = (texts.select("text").mapInArrow(summarise(path), "pre_token string, n long")
           .groupBy("pre_token").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "pre_token").limit(TABLE_ENTRIES).select("pre_token"))
    keys = [r[0] for r in top.collect()]
    return {k: encoder(path).cache.compute(k) for k in keys}


def token_counts(spark: SparkSession, docs: DataFrame, path: str | None = None, limit: int = LIMIT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row of ``docs``."""
    path = path or vocabulary_path()
    texts = id_and_text(docs, id_col, text_col)
    table = spark.sparkContext.broadcast(frequent_lengths(texts, path))

    def run(batches):
        enc, frequent = encoder(path), table.value
        rest = enc.cache
        for batch in batches:
            raw, totals = texts_of(batch), []
            for b in raw:
                text = b.decode("utf-8", "replace")
                if any(special in text for special in enc.specials):
                    totals.append(enc.count(text))
                    continue
                units = enc.split(text)
                found = list(map(frequent.get, units))
                missed = [u for u, n in zip(units, found) if n is None]
                totals.append(sum(filter(None, found)) + sum(map(rest.__getitem__, missed)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(b) for b in raw], pa.int64()), pa.array(totals, pa.int64()),
                 pa.array([n > limit for n in totals], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return texts.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
