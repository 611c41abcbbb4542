"""Ranked search, tree BPE and tokenizer alignment against brute force."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest

from subledger.llm import alignment, bytetree, ranked
from subledger.llm.common import BoundedCache, table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, item_id string, ids string, Shard int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ODD = ["", None, " ", "a\x1cb \x85 x　y  <|endoftext|> z", "é İ ΑΣ Σ̈x <s>", "\n\n", "don't 12345 it's  !!!\t\tq", "a​ b﻿c    d",
       "😀 é ü 漢字A", "wörd x " * 9000, "The The the", "!'s 's'S ²½ ª_x", "▁x", "<0x41>", "ﬁ"]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows(spark):
    found = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    return found + [(10**7 + i, t) for i, t in enumerate(ODD)] + [found[0], (None, found[3][1])]


# -- ranked search ---------------------------------------------------------------------------------------------

def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain_ranking(docs, items, k=10):
    bags = [(d, collections.Counter(plain_terms(t))) for d, t in docs]
    held = [(d, b) for d, b in bags if b]
    n_docs, n_terms = len(held), sum(sum(b.values()) for _, b in held)
    df = collections.Counter(t for _, b in held for t in b)
    result = []
    for item, text in items:
        scores = []
        for d, b in held:
            m = 10 + 90 * sum(b.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m))
                    for t in set(plain_terms(text)) if t in b)
            if s > 0:
                scores.append((-s, d is not None, d or 0))
        result += [(item, i + 1, d if known else None, -s) for i, (s, known, d) in enumerate(sorted(scores)[:k])]
    return result


def in_order(found):
    return sorted(found, key=repr)


@pytest.mark.parametrize("shard_terms", [1 << 16, 300])
def test_ranked_search(spark, rows, shard_terms):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()[:15]]
    items += [(900, None), (901, ""), (902, "the the THE of"), (902, "the the THE of"), (None, "漢字A é"), (903, "zzzz9")]
    query = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int")
    got = ranked.ranked_search(spark, documents(spark, rows), query, shard_terms=shard_terms)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert in_order(map(tuple, got.collect())) == in_order(plain_ranking(rows, items))


def test_ranked_search_ties_and_small_tiles(spark, monkeypatch):
    """Copies with one score over many tiles and tasks: the smallest ids win."""
    monkeypatch.setattr(ranked, "DOC_TILE", 16)
    monkeypatch.setattr(ranked, "ITEM_TILE", 2)
    monkeypatch.setattr(ranked, "TERM_TILE", 3)
    rng = random.Random(4)
    docs = [(i, "alpha beta gamma") for i in range(400)] + [(1000 + i, " ".join(rng.choices("abcdefgh", k=12))) for i in range(300)]
    rng.shuffle(docs)
    items = [(1, "alpha beta"), (2, "gamma"), (3, "a b c d e f g h"), (4, "h"), (5, "alpha a")]
    best = ranked.Best(len(items), 10)
    vocabulary = sorted({t for _, x in items for t in plain_terms(x)})
    number = {t.encode(): i for i, t in enumerate(vocabulary)}
    frame = documents(spark, docs).repartition(5)
    got = ranked.ranked_search(spark, frame, spark.createDataFrame(items, "item_id long, text string"))
    assert in_order(map(tuple, got.collect())) == in_order(plain_ranking(docs, items))
    # the tile code itself, in this process, under the small tiles
    bags = [collections.Counter(plain_terms(t)) for _, t in docs]
    df = collections.Counter(t for b in bags for t in b)
    n_terms = sum(sum(b.values()) for b in bags)
    weights = np.array([ranked.weight(len(docs), df[t]) for t in vocabulary], np.int64)
    lists = [sorted(set(plain_terms(x))) for _, x in items]
    item_of = np.repeat(np.arange(len(items)), [len(x) for x in lists])
    tiles = list(ranked.tiles_of(item_of, np.array([number[t.encode()] for x in lists for t in x]), len(items)))
    m = ranked.length_terms(np.array([sum(b.values()) for b in bags]), len(docs), n_terms)
    for lo in range(0, len(docs), 16):
        entries = [(j, number[t.encode()], n) for j, b in enumerate(bags[lo:lo + 16]) for t, n in b.items() if t.encode() in number]
        doc, term, tf = (np.array(c) for c in zip(*entries))
        value = ranked.impacts(weights[term], tf, m[lo + doc])
        ranked._tile(tiles, best, 3, np.array([d for d, _ in docs[lo:lo + 16]]), doc, term, value, len(vocabulary))
    mine = {(items[i][0], int(d), int(s)) for i, d, s in zip(best.item, best.doc, best.score)}
    assert mine == {(i, d, s) for i, _, d, s in plain_ranking(docs, items)}


def test_ranked_search_without_rows(spark, rows):
    items = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert ranked.ranked_search(spark, documents(spark, []), items).count() == 0
    assert ranked.ranked_search(spark, documents(spark, [(1, None), (2, "..")]), items).count() == 0
    assert ranked.ranked_search(spark, documents(spark, rows[:5]), items.limit(0)).count() == 0


def test_length_terms_beyond_64_bits():
    big = ranked.length_terms(np.array([10**9, 5]), 10**12, 10**13)
    assert big.tolist() == [10 + 90 * 10**9 * 10**12 // 10**13, 10 + 90 * 5 * 10**12 // 10**13]


# -- tree BPE --------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken
    ranks = bytetree.read_ranks(bytetree.ranks_path())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_token_digest(spark, rows, library):
    want = []
    for d, t in rows:
        ids = np.array(library.encode_ordinary(t or ""), "<u4").tobytes()
        want.append((d, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert in_order(map(tuple, bytetree.token_digest(spark, documents(spark, rows)).collect())) == in_order(want)
    assert bytetree.token_digest(spark, documents(spark, [])).count() == 0


def test_tree_of_small_leaves(library):
    """Leaves of one to eight characters and bytes: every join is used."""
    codec = bytetree.codec(bytetree.ranks_path())
    rng = random.Random(11)
    alphabet = ["a", "b", "the", " ", "  ", "\n", "\t", "'", "'s", "'ll", "re", "l", "23", "é", "日本", "😀", "!", "\xa0", "\r\n", "　",
                "aaaa", "=", "\x00", "<|endoftext|>"]
    for _ in range(1500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50)))
        tree = bytetree.TreeCodec.__new__(bytetree.TreeCodec)
        tree.__dict__.update(codec.__dict__)
        tree.leaf_chars, tree.leaf_bytes, tree.leaf_ids = (rng.choice([1, 2, 3, 5, 8]) for _ in range(3))
        tree.units = BoundedCache(tree._unit, 100)
        ids = np.frombuffer(tree.encode(text), "<u4")
        assert ids.tolist() == library.encode_ordinary(text), (text, tree.leaf_chars, tree.leaf_bytes)
        assert tree.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 70001, " " * 50000 + "x", "日本語" * 9000, "=-" * 20000, "b" + "ab" * 30000])
def test_tree_of_long_runs(library, text):
    codec = bytetree.codec(bytetree.ranks_path())
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_coarse_cut_agrees_with_every_character(library):
    codec = bytetree.codec(bytetree.ranks_path())
    marks = [c for c in map(chr, [*range(0x3100), *range(0x3100, 0x110000, 331), 0xFEFF, 0xFF10]) if not 0xD800 <= ord(c) < 0xE000]
    for c in marks:
        text = f"a{c}b {c}{c} 1{c}2"
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode_ordinary(text), hex(ord(c))


# -- alignment -------------------------------------------------------------------------------------------------

def plain_alignment(docs):
    import public_tokenizers as public
    import sentencepiece
    from tokenizers import Tokenizer
    first = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    pair = alignment.pair_of(alignment.default_paths())

    def ends(ids, tokens):
        return np.cumsum([len(tokens[i]) for i in ids]).tolist()

    found, counts = [], collections.Counter()
    for d, t in docs:
        a = first.encode(" " + t, add_special_tokens=False).ids if t else []
        b = second.encode(t) if t else []
        whole = (" " + (t or "")).encode()
        if any(b"".join(tokens[i] for i in ids) != whole for ids, tokens in ((a, pair.bytes_a), (b, pair.bytes_b))):
            found.append((d, [], [], [], []))
            continue
        end_a, end_b = ends(a, pair.bytes_a), ends(b, pair.bytes_b)
        links, j = [], 0
        for i, (lo, hi) in enumerate(zip([0, *end_a], end_a)):
            while end_b[j] <= lo:
                j += 1
            k = j
            while k < len(b) and ([0] + end_b)[k] < hi if k == j else k < len(b) and end_b[k - 1] < hi:
                links.append((a[i], b[k]))
                k += 1
        groups, i, j = [], 0, 0
        for cut in sorted(set(end_a) & set(end_b)):
            x, y = end_a.index(cut) + 1, end_b.index(cut) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        counts.update(links)
        found.append((d, a, b, groups, links))
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(d, len(a), len(b), len(g), len(x), sum(counts[y] == best[y[1]] for y in x), sum(counts[y] for y in x),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for d, a, b, g, x in found]


@pytest.mark.parametrize("sizes", [{}, {"shard_keys": 700, "slice_keys": 2000}])
def test_alignment(spark, rows, sizes):
    cut = [(d, t and t[:700]) for d, t in rows]
    got = alignment.alignment_digest(spark, documents(spark, cut), **sizes)
    assert in_order(map(tuple, got.collect())) == in_order(plain_alignment(cut))


def test_alignment_looks_each_distinct_unit_up_once():
    """Units of a stretch of texts, and A's parts of them, are looked up once each; ids are those of the libraries."""
    pair = alignment.Pair(*alignment.default_paths())
    seen, cache = [], type(pair.units)

    class Watched(cache):
        def __getitem__(self, key):
            seen.append(key)
            return cache.__getitem__(self, key)
    pair.units = Watched(pair._unit, 100)
    texts = ["the cat, the cat. " * 30, "", "caf\u00e9\n\nthe  dog", "\u2581odd", "\u4e2d\u6587 the", "tab\tthe\x85end "] * 2
    got = pair.encode([t.encode() for t in texts])
    assert got == [pair._whole(t) if t else (b"", b"") for t in texts]
    assert seen and len(seen) == len(set(seen))


def test_alignment_of_nothing(spark):
    assert alignment.alignment_digest(spark, documents(spark, [])).count() == 0
    got = alignment.alignment_digest(spark, documents(spark, [(1, None), (2, ""), (3, "▁")])).collect()
    assert sorted(map(tuple, got)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]


def test_perfect_hash():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 40, 20000).astype(np.uint64))
    dealt, parts = alignment.shard_of(keys, 4), []
    for shard in range(4):
        sizes, words, by_number = alignment.build_hash(keys[dealt == shard])
        parts.append((shard, sizes, alignment.squeeze(words.tobytes()), alignment.squeeze(by_number.tobytes())))
    whole = alignment.PairTable(4, parts)
    assert sorted(whole.numbers(keys).tolist()) == list(range(len(keys)))
    foreign = np.setdiff1d(rng.integers(0, 1 << 40, 5000).astype(np.uint64), keys)
    assert (whole.numbers(foreign) == -1).all()
    half = alignment.PairTable(4, parts[:2])
    assert (half.numbers(keys[dealt >= 2]) == -1).all() and sorted(half.numbers(keys[dealt < 2]).tolist()) == list(range(half.n))
    bits = sum(sum(p[1]) for p in parts) / len(keys)
    assert bits < 5


def test_tree_sum(spark):
    vectors = [(s, p, alignment.pack_counts(np.array([s, p, 1 << 33 if p == 3 else 1]))) for s in (0, 5) for p in range(40)]
    frame = spark.createDataFrame(vectors, "shard long, part long, v binary")
    got = {r.shard: alignment.unpack_counts(r.v).tolist() for r in alignment.tree_sum(frame, 40).collect()}
    assert got == {s: [40 * s, 780, 39 + (1 << 33)] for s in (0, 5)}
