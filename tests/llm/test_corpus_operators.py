"""Operators against brute-force versions on small tables: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from subledger.llm import decontam, katz, packing, ranking, rules, simhash, substring, tokencount
from subledger.llm import exchange as ex
from subledger.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, component_id string, bin string, Words int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = ["", None, "  a  b\n\n c ", "a\x1cb \x85 x　y  <|endoftext|> z", "foo  <|endoftext|>", "é İ ΑΣ Σ̈x <|endoftext|>", "\n\n",
       "don't 12345 it's  !!!\t\tq", "a​ b﻿c    d", "😀 é ü 漢字 <|startoftext|>A",
       "wörd x " * 3000, "The The the", "!'s 's'S ²½ ª_x"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def rows(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    out = [(r.doc_id, r.text) for r in docs] + [(10**7 + i, t) for i, t in enumerate(ODD)]
    return out + [(10**7 + 50, docs[0].text), (docs[1].doc_id, docs[1].text), (10**7 + 51, docs[2].text[7:])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_token_counts(spark, docs, rows, none):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokencount.vocabulary_path())
    want = sorted((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    got = tokencount.token_counts(spark, docs).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
    assert tokencount.token_counts(spark, none).count() == 0
    import public_tokenizers
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    few = docs.where("doc_id >= 10000000")
    assert {r.doc_id: r.n_tokens for r in tokencount.token_counts(spark, few, path).collect()} == \
        {i: len(sp.encode(t or "")) for i, t in rows if i >= 10**7}


@pytest.mark.parametrize("group_items", [200_000, 5])
def test_packing(spark, docs, rows, none, group_items):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.vocabulary_path())
    want = []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for p in range(0, len(ids), 512):
            part = ids[p:p + 512]
            want.append((i, p // 512, p, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    got = packing.pack(spark, docs, capacity=512, group_items=group_items).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
    if group_items > 5:
        assert len(sequences) <= 1.02 * sum(w[3] for w in want) / 512 + 1
    assert packing.pack(spark, none).count() == 0


def test_packing_looks_each_distinct_word_up_once():
    """Words of a stretch of texts are looked up once each, and cut where ``bytes.split`` cuts them."""
    words = packing.WordIds(packing.vocabulary_path())
    seen, known = [], words.words.__class__.__getitem__

    class Watched(words.words.__class__):
        def __getitem__(self, key):
            seen.append(key)
            return known(self, key)
    words.words = Watched(words._word, 100)
    texts = [b"the cat the cat " * 50, b"", b"  the\x0bdog\x0c\r\n", b"\x1c\xc2\xa0 \xff\xfe the", b"caf\xc3\xa9 <|end|> \xe4\xb8\xad"] * 3
    ids = list(words.encode(texts))
    assert ids == [words._ids(" ".join(w.decode("utf-8", "replace") for w in t.split())) for t in texts]
    assert len(seen) == len(set(seen)) and {b"the", b"cat", b"dog"} <= set(seen)


def plain_fingerprint(text):
    w = WORD.findall(lower(text))
    if not w:
        return 0
    grams = [" ".join(w)] if len(w) < 3 else [" ".join(w[i:i + 3]) for i in range(len(w) - 2)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    ids = sorted(prints)
    v = np.array([prints[i] for i in ids], dtype=np.uint64)
    up = list(range(len(ids)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(v[i + 1:] ^ v[i]) <= 3) + i + 1:
            a, b = root(i), root(int(j))
            up[max(a, b)] = min(a, b)
    return {ids[i]: ids[root(i)] for i in range(len(ids))}


def test_simhash(spark, docs, rows, none):
    prints = {i: plain_fingerprint(t) for i, t in rows}
    want = plain_components(prints)
    got = simhash.near_duplicates(spark, docs).collect()
    assert len(got) == len(rows)
    assert all(r.fingerprint == f"{prints[r.doc_id]:016x}" and r.component_id == want[r.doc_id] for r in got)
    kept = simhash.keep_one(spark, docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert simhash.near_duplicates(spark, none).count() == 0


def test_simhash_repeated_ids(spark):
    """Unlike texts that repeat an id are documents of their own; each component keeps one row."""
    a, b, c = (" ".join(f"{w}{i}" for i in range(60)) for w in "abc")
    made = [(1, a, 0), (1, b, 0), (2, b, 0), (3, a, 0), (4, c, 0), (4, c, 0), (4, c, 1), (None, a, 0), (5, b, 0)]
    frame = spark.createDataFrame(made, "doc_id long, text string, extra int")
    got = sorted((r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash.near_duplicates(spark, frame).collect())
    prints = {t: f"{plain_fingerprint(t):016x}" for t in (a, b, c)}
    assert got == sorted((i or 0, prints[t], None if i is None else 4 if t == c else 1) for i, t, _ in made)
    kept = sorted((r.doc_id or 0, r.text) for r in simhash.keep_one(spark, frame).collect())
    assert kept == sorted([(1, a), (1, b), (4, c), (0, a)])


def test_simhash_smallest_id_may_lie_anywhere(spark):
    """The component's smallest id counts, whether the smallest fingerprint holds it or another one."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(500)}" for _ in range(400)]
    made = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            words[rng.randrange(400)] = f"w{rng.randrange(500)}"
        made.append((1000 - i, " ".join(words)))
    prints = {i: plain_fingerprint(t) for i, t in made}
    want = plain_components(prints)
    linked = {c for i, c in want.items() if i != c and prints[i] != prints[c]}
    assert linked
    docs = spark.createDataFrame(made, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(spark, docs).collect()} == want
    assert sorted(r.doc_id for r in simhash.keep_one(spark, docs).collect()) == sorted(set(want.values()))


def test_components_that_do_not_settle_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(simhash, "MAX_ROUNDS", 1)
    path = spark.createDataFrame([(i, i + 1) for i in range(20)], "u long, v long")
    with pytest.raises(RuntimeError):
        simhash.components(spark, path)


@pytest.mark.parametrize("chunk", [40, 2048])
def test_simhash_dense_cluster(spark, chunk):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(20)]
    prints = {}
    for i in range(1200):
        x = rng.choice(centres[:2] if i % 3 == 0 else centres)
        for b in rng.sample(range(64), rng.randrange(9)):
            x ^= 1 << b
        prints[i] = x
    want = plain_components(prints)
    signed = [(x - (1 << 64) if x >> 63 else x, i) for i, x in prints.items()]
    nodes = spark.createDataFrame(signed, "fp long, d long").groupBy("fp").agg(F.min("d").alias("node"))
    units = simhash.candidate_units(nodes, 3, chunk)
    got = {r.node: r.component for r in simhash.components(spark, simhash.linked(units, 3)).collect()}
    first = {}
    for i, x in prints.items():
        first.setdefault(x, i)
    assert all(got.get(first[x], first[x]) == want[i] for i, x in prints.items())


def plain_measures(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    where = collections.defaultdict(list)
    for i in range(len(w) - 7):
        where[tuple(w[i:i + 8])].append(i)
    covered = {j for at in where.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_quality_rules(spark, docs, rows, none):
    got = rules.quality_digest(docs).collect()
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == \
        sorted((i, *plain_measures(t)) for i, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (r.failed_bits & (rules.policy_mask(rules.PRODUCTION)) == 0) and not (r.kept and r.base_failed)
    kept = rules.filter_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    ledger = rules.stored_ledger(docs)
    for policy in rules.POLICIES:      # policies and ablations over one stored ledger, later rules included
        mask = rules.policy_mask(policy) | rules.policy_mask("base/1")
        verdicts = rules.apply_policy(ledger, policy).collect()
        assert all(r.kept == (not r.failed_bits & mask) and r.policy == policy for r in verdicts)
        assert sorted(map(str, rules.filter_documents(docs, policy).select("doc_id").collect())) == \
            sorted(str(r) for r in rules.apply_policy(ledger, policy).where("kept").select("doc_id").collect())
        table_ = {r.rule: r for r in rules.ablations(ledger, policy).collect()}
        own = rules.policy_mask(policy)
        for name in rules.POLICIES[policy]:
            bit = rules.BIT[name]
            assert table_[name].n_failed == sum(bool(r.failed_bits & bit) for r in verdicts)
            assert table_[name].n_failed_alone == sum(r.failed_bits & own == bit for r in verdicts)
            assert table_[name].n_kept == sum(not r.failed_bits & own for r in verdicts)
    assert rules.quality_digest(none).count() == 0
    plan = rules.rule_ledger(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan.replace("Exchange RoundRobin", "")


def test_long_clean_texts_are_kept(spark):
    """A large vocabulary falls under 20 % distinct words by length alone; a small one does in every run."""
    rng = random.Random(3)
    clean = " ".join(f"word{rng.randrange(80_000)}" for _ in range(500_000))
    junk = " ".join(f"word{rng.randrange(100)}" for _ in range(20_000))
    short = " ".join(f"word{rng.randrange(100)}" for _ in range(900))
    made = spark.createDataFrame([(1, clean), (2, junk), (3, short)], "doc_id long, text string")
    assert [r.doc_id for r in rules.filter_documents(made).select("doc_id").collect()] == [1]
    got = {r.doc_id: r for r in rules.quality_digest(made).collect()}
    assert {i for i, r in got.items() if r.kept} == {1}
    assert {i for i, r in got.items() if r.failed_bits & rules.BIT["run_on_stretches"]} == {2, 3}
    assert all(r.failed_bits & rules.BIT["run_on_words"] for r in got.values())


def test_quality_classifier(spark):
    base = "/root/testdata/sf0.01"
    labels = table(spark, base, "labels")
    got = ranking.quality_scores(spark, table(spark, base, "documents"), labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    odd = spark.createDataFrame([(1, None, "a"), (None, "x", "b")], "doc_id long, text string, quality string")
    flat = ranking.quality_scores(spark, odd, labels.limit(0)).collect()
    assert [(r.score, r.predicted) for r in flat] == [(0.5, 0)] * 2
    assert ranking.quality_scores(spark, odd.limit(0), labels).count() == 0


def test_every_label_is_learned_from(spark, monkeypatch):
    """All training rows meet in pairs, the fit is where the gradient over all pairs is 0, and the cut is the exact quantile."""
    rng = np.random.default_rng(4)
    made = [(i, rng.normal(0.5 * y, 1, 20).tolist(), y) for i, y in enumerate([1] * 70 + [0] * 500)]
    train = spark.createDataFrame(made, "doc_id long, x array<double>, y int").repartition(5)
    pairs = ranking.labelled_pairs(spark, train, 70, 500).cache()
    found = {tuple(np.round(r.d, 9)) for r in pairs.collect()}
    good, bad = (np.array([x for _, x, y in made if y == k]) for k in (1, 0))
    diffs = np.round(good[:, None, :] - bad[None, :, :], 9)
    used = np.array([[tuple(d) in found for d in row] for row in diffs])
    assert pairs.count() == len(found) == used.sum() == 500 * 8
    assert (used.sum(axis=0) == 8).all() and used.sum(axis=1).min() >= 57 and used.sum(axis=1).max() <= 58
    w = ranking.fit_pairs(pairs, 20)
    d = np.array([r.d for r in pairs.collect()])
    assert np.abs(d.T @ (1 / (1 + np.exp(d @ w))) / len(d) - ranking.RIDGE * w).max() < 1e-6
    raws = rng.normal(0, 1, 3000).round(2).tolist() + [5.0] * 50 + [1e-300, 1e300]
    monkeypatch.setattr(ranking, "RANGES", 7)
    scores = spark.createDataFrame([(v,) for v in raws], "raw double").cache()
    assert [ranking.value_at(scores, k) for k in (1, 777, 3040, 3052)] == [sorted(raws)[k - 1] for k in (1, 777, 3040, 3052)]


def plain_dedup(rows, window=13):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for p in range(len(w) - window + 1 if i is not None else 0):
            key = tuple(w[p:p + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[p:p + window])] < i:
                gone[p:p + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [5, 10**9])
def test_substring_dedup(spark, docs, rows, none, monkeypatch, hot):
    monkeypatch.setattr(ex, "BUCKET_KEYS", 300)
    rng = random.Random(2)
    tiny = [(i, " ".join(f"w{rng.randrange(4)}" for _ in range(rng.randrange(120)))) for i in range(100)]
    tiny += [(1000 + i, " ".join(tiny[i % 7][1].split()[3:60]) + f" x{i} " + tiny[(i * 3) % 50][1]) for i in range(60)]
    tiny += [(3, "a b"), (5, None), (None, tiny[0][1]), (2000, "q " * 60), (2001, "q " * 30), (2001, "q\n\tq " * 30)]
    frame = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in tiny], SCHEMA).repartition(3)
    got = substring.substring_dedup(spark, frame, hot_windows=hot, shard_runs=50, automaton_words=200, block_bytes=3000)
    assert sorted(map(tuple, got.collect()), key=str) == plain_dedup(tiny)
    if hot > 5:
        assert sorted(map(tuple, substring.substring_dedup(spark, docs, block_bytes=50_000).collect()), key=str) == plain_dedup(rows)
        assert substring.substring_dedup(spark, none).count() == 0


def plain_katz(rows):
    tokens = [(i, WORD.findall(lower(t)) + ["\n"], i is not None and zlib.crc32(str(i).encode()) % 7 != 2) for i, t in rows]
    c1, c2, ch = collections.Counter(), collections.Counter(), collections.Counter()
    for _, w, train in tokens:
        if train:
            c1.update(w)
            for h, x in zip(["\n\n"] + w, w):
                c2[h, x] += 1
                ch[h] += 1
    n, v = sum(c1.values()), len(c1)

    def discounts(counts):
        r_n, d = collections.Counter(counts.values()), dict.fromkeys(range(1, 6), 1.0)
        tail = 6 * r_n[6] / r_n[1] if r_n[1] else 1
        for r in d:
            if r_n[r] and tail < 1:
                x = ((r + 1) * r_n[r + 1] / (r * r_n[r]) - tail) / (1 - tail)
                d[r] = x if 0 < x < 1 else 1.0
        return d
    d1, d2 = discounts(c1), discounts(c2)
    freed = sum((1 - d1[c]) * c for c in c1.values() if c <= 5)
    mass = max(n, 1) if freed > 0 else n + 1
    p1 = lambda w: d1.get(c1[w], 1) * c1[w] / mass if c1[w] else (freed if freed > 0 else 1) / mass
    p2 = lambda h, w: d2.get(c2[h, w], 1) * c2[h, w] / ch[h]
    after = collections.defaultdict(list)
    for h, w in c2:
        after[h].append(w)
    alpha = {h: max(1 - sum(p2(h, w) for w in ws), 1e-12) / max(1 - sum(map(p1, ws)), 1e-12) for h, ws in after.items()}
    for h in list(after)[:20]:   # the probabilities after a history add up to 1
        rest = sum(p1(w) for w in c1 if (h, w) not in c2) + p1("\0 unseen")
        assert abs(sum(p2(h, w) for w in after[h]) + alpha[h] * rest - 1) < 1e-9 or alpha[h] < 1e-9
    return sorted(((-1 if i is None else i), len(w), sum(c1[x] > 0 for x in w), n, sum(math.log10((c1[x] + 1) / (n + v + 1)) for x in w),
                   sum(math.log10(p2(h, x) if c2[h, x] else alpha.get(h, 1) * p1(x)) for h, x in zip(["\n\n"] + w, w)))
                  for i, w, _ in tokens)


def test_katz(spark, rows, none, monkeypatch):
    monkeypatch.setattr(ex, "BUCKET_KEYS", 20_000)
    more = rows + [(None, "of the unseenword"), (5, "zzz the qqqq")]
    frame = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in more], SCHEMA).repartition(3)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                 for r in katz.katz_scores(spark, frame, block_bytes=100_000).collect())
    want = plain_katz(more)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    np.testing.assert_allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-6, atol=1e-9)
    assert katz.katz_scores(spark, none).count() == 0


def plain_leaks(rows, items):
    """Every part in some window of at most ``REACH`` times its words."""
    def holds(words, part):
        wanted, n = decontam.shingles(part), min(decontam.SHINGLE, len(part))
        seen = list(zip(*(words[k:] for k in range(n))))
        if len(wanted & set(seen)) < decontam.SIMILARITY * len(wanted) - 1e-9:
            return False
        width = max(len(part), math.ceil(decontam.REACH * len(part))) - n + 1
        return any(len(wanted & set(seen[i:i + width])) >= decontam.SIMILARITY * len(wanted) - 1e-9 for i in range(max(1, len(seen))))

    out = set()
    for i, t in rows:
        words = decontam.words_of(t or "")
        for item, text in items:
            parts = [p for p in decontam.split_item(text or "") if p]
            if parts and all(holds(words, p) for p in parts):
                out.add((i, item))
    return out


def test_decontamination(spark, docs, rows, none):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    items += [(900, None), (901, ""), (902, "Question: which stone turns wine into sweet vinegar overnight? Answer: the blue one"), (903, "don't 12345")]
    extra = [(10**7 + 80, "so which stone turns wine into sweet vinegar overnight? it is the blue one of course"),
             (10**7 + 81, "so which stone turns wine into sweet vinegar overnight? nobody knows"), (10**7 + 82, ("pad " * 400) + items[0][1])]
    # few distinct words; question and answer far apart; an answer alone; shingles spread beyond the reach
    bits = " ".join(random.Random(2).choices("01", k=40))
    items += [(904, bits), (905, "Question: how many moons has the ninth blue planet of that sun Answer: it has seventeen small moons"),
              (906, "Question: Answer: no question stands before this lone answer"), (907, "0 0 0 0 0 0 0 0 0 0 0 0 0 0 0 0")]
    far = "how many moons has the ninth blue planet of that sun " + "filler words here " * 90 + "it has seventeen small moons"
    question = "how many moons has the ninth blue planet of that sun".split()
    spread = " ".join(" ".join(question[i:i + 5]) + " gap" * 40 for i in range(7)) + " it has seventeen small moons"
    extra += [(10**7 + 83, "so " + bits + " end"), (10**7 + 84, far), (10**7 + 85, "it has seventeen small moons"), (10**7 + 86, spread),
              (10**7 + 87, "no question stands before this lone answer"), (10**7 + 88, "x 0 0 0 0 0 0 y"), (10**7 + 89, bits[:30])]
    frame = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows + extra], SCHEMA).repartition(3)
    tests = spark.createDataFrame(items, "item_id long, text string")
    want = plain_leaks(rows + extra, items)
    got = decontam.leaks(spark, frame, tests).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and (10**7 + 80, 902) in want and (10**7 + 81, 902) not in want
    assert {(10**7 + 83, 904), (10**7 + 84, 905), (10**7 + 87, 906), (10**7 + 88, 907)} <= want
    assert not {(10**7 + 85, 905), (10**7 + 86, 905), (10**7 + 89, 904)} & want
    clean = decontam.decontaminate(spark, frame, tests)
    assert clean.columns == frame.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _ in rows + extra if i not in {d for d, _ in want})
    assert decontam.leaks(spark, none, tests).count() == 0 and decontam.leaks(spark, frame, tests.limit(0)).count() == 0


def test_shards_find_the_same(spark, docs):
    items = table(spark, SF, "benchmark")
    whole = {(r.doc_id, r.item_id) for r in decontam.leaks(spark, docs, items).collect()}
    shards = [index.value for index, _ in decontam.each_shard(spark, items, shard_words=200)]
    assert len(shards) > 1
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(spark, docs, items, shard_words=200).collect()}
    assert got == whole
    left = {r.doc_id for r in decontam.decontaminate(spark, docs, items, shard_words=200).collect()}
    assert left == {r.doc_id for r in docs.collect()} - {d for d, _ in whole}
