"""Quotation linking and personal data on hand-made rows."""

import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from subledger.llm import chat, pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= len(digits(m)) <= 15]


def test_base_spans_agree_with_the_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        t = "".join(rng.choice("a1.@-+ 0255()é") for _ in range(rng.randrange(30)))
        assert pii.base_spans(t) == plain_spans(t), t
    assert pii.base_spans("4111 1111 1111 1111")[0][0] == "card"


def test_disclosing_terms_are_found_and_masked(spark):
    rows = [(i, f"filler{i} words{i} here zanzibarine contact bob@example.org please number{i}", "x", 1) for i in range(6)]
    rows += [(10 + i, f"plain text without any value, please read line {i} of contact", "x", 1) for i in range(40)]
    rows += [(60, None, "x", None), (61, "", "x", 0), (62, rows[0][1], "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __Terms string, n_chars long")
    got = {r.doc_id: r for r in pii.personal_data(spark, docs).collect()}
    assert got[0].n_email == 1 and got[20].spans == "" and got[60].spans == ""
    text = rows[0][1]
    at = text.index("zanzibarine")
    assert f"term:{at}:{at + 11}" in got[0].spans.split(",")
    assert not any(f"term:{text.index('contact')}:" in r.spans for r in got.values())
    assert got[62].spans == got[0].spans
    clean = {r.doc_id: r for r in pii.sanitise(spark, docs).collect()}
    assert set(clean) == set(got) and docs.columns == ["doc_id", "text", "__Terms", "n_chars"]
    assert "[EMAIL]" in clean[0].text and "[TERM]" in clean[0].text and "zanzibarine" not in clean[0].text
    assert clean[0].n_chars == len(clean[0].text) and clean[10].text == rows[6][1] and clean[60].text is None
    assert pii.personal_data(spark, docs.limit(0)).count() == 0


def test_terms_are_masked_in_every_document(spark):
    """Far from the value, in documents without it, and however short."""
    far = " ".join(["and"] * 30)
    rows = [(i, f"Kim 林檎 {far} write to kim@example.org" + " and" * i) for i in range(9)] + [(9, "we met Kim today, 林檎"), (10, "Kim " + far)]
    rows += [(20 + i, f"and we met today {far}, write to") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans.split(",") for r in pii.personal_data(spark, docs).collect()}
    assert got[0][1:] == ["general:0:3", "term:4:6"] and got[9] == ["general:7:10", "term:18:20"] and got[10] == ["general:0:3"]
    assert got[20] == [""]
    clean = {r.doc_id: r.text for r in pii.sanitise(spark, docs).collect()}
    assert clean[9] == "we met K. today, [TERM]" and clean[20] == rows[-200][1]
    assert "Kim" not in clean[0] and "write to [EMAIL]" in clean[0]


def test_disclosure_against_the_formula(spark):
    """Values in one text and in several; a term must meet its value in two texts or be a part of it."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)] + [f"rare{i}" for i in range(120)] + [f"kin{i}" for i in range(8)]
    rows = []
    for i in range(300):
        text = " ".join(rng.choices(words, [50] * 40 + [0.02] * 128, k=25))
        if i < 30:
            text += f" rare{i // 6} kin{i // 6} a{i // 3}.name{i}@example.org +49 30 {1000000 + i // 6}"
        elif i < 34:
            text += f" kin{i % 8} name{i - 28}"
        rows.append((i, text))
    rows += [(1000 + i, rows[i][1]) for i in (3, 7)]       # copies are no second witness
    values = {i: {pii._value(k, t[a:b]) for k, a, b in pii.base_spans(t)} for i, t in rows}
    own = {i: {x for _, a, b in pii.base_spans(t) for x in re.findall(r"[a-z0-9]+", t[a:b])} for i, t in rows}
    terms = {i: set(re.findall(r"[a-z0-9]+", t)) for i, t in rows}
    text_of, want = dict(rows), {}
    for e in set().union(*values.values()):
        with_e = {i for i, v in values.items() if e in v}
        p = len(with_e) / len(rows)
        for t in set().union(*(terms[i] for i in with_e)):
            n = {i for i in terms if t in terms[i]}
            if len({text_of[i] for i in with_e & n}) < 2 and not any(t in own[i] for i in with_e & n):
                continue
            known = (len(with_e & n) + pii.PRIOR * p) / (len(n) + pii.PRIOR)
            disclosure = (math.log2(known) - math.log2(p)) / -math.log2(p)
            if disclosure >= pii.DISCLOSURE:
                want[t] = max(want.get(t, 0), disclosure)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kinds = set()
    for r in pii.personal_data(spark, docs).collect():
        base, t = pii.base_spans(text_of[r.doc_id]), text_of[r.doc_id]
        plain = [("general" if want[m.group()] < pii.REMOVAL else "term", *m.span()) for m in re.finditer(r"[a-z0-9]+", t)
                 if m.group() in want and not any(a < m.end() and m.start() < b for _, a, b in base)]
        assert r.spans == pii.joined(base + plain)
        kinds |= {k for k, *_ in plain}
    assert kinds == {"term", "general"} and not any(t.startswith("w") for t in want)
    clean = {r.doc_id: r.text for r in pii.sanitise(spark, docs).collect()}
    general, holder = next((t, i) for t, d in want.items() if d < pii.REMOVAL for i, _ in rows if i >= 30 and t in terms[i])
    assert general[0] + "." in clean[holder].split() and general not in clean[holder].split()


def test_planted_names_and_rare_words(spark):
    """Names planted beside and away from their addresses are found; words of one text are left alone."""
    rng = random.Random(8)
    names = [f"zor{chr(97 + i)}lin" for i in range(20)]
    rows = [(i, " ".join(rng.choices([f"w{j}" for j in range(60)], k=20)) + f" only{i}") for i in range(2000)]
    for i, name in enumerate(names):
        for k in range(2):
            d = 40 * i + k
            rows[d] = (d, f"{rows[d][1]} {name} writes from {name}@mail.example and more{d}")
        rows[1000 + i] = (1000 + i, f"{rows[1000 + i][1]} and {name} was there")
    text_of = dict(rows)
    found = collections.Counter()
    for r in pii.personal_data(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect():
        for span in filter(None, r.spans.split(",")):
            kind, a, b = span.split(":")
            if kind in ("term", "general"):
                found[text_of[r.doc_id][int(a):int(b)]] += 1
    assert all(found[n] == 3 for n in names)                       # recall 1
    assert set(found) <= set(names)                                # precision 1


def test_filter_size_follows_the_terms():
    assert [pii.filter_bits(n) for n in (0, 10, 10**6, 10**9)] == [28, 28, 30, 30]


def test_quotations(spark, monkeypatch):
    rows = [(1, 0, "user", "Hello there\n\nHow do I sort a list in Python?"),
            (1, 1, "assistant", "Use sorted().\nIt returns a new list."),
            (1, 2, "user", "> How do I sort  a list in python?\nAnd in reverse?"),
            (1, 3, "assistant", ">> How do I sort a list in Python?\n> And in reverse?\nUse reverse=True."),
            (1, 4, "user", "thanks"),
            (1, 5, "user", "> Use sorted().\n> It returns a new list.\n> extra\nok"),
            (1, 6, "user", "> never said\nhm"),
            (2, 0, "user", None), (2, 1, "user", ">"), (2, 1, "user", ">"), (None, 1, "user", "x")]
    for stretch in (2, 1024):
        monkeypatch.setattr(chat, "STRETCH", stretch)
        got = {}
        talk = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv", F.lit("clash"))
        for r in chat.link_quotations(spark, talk).collect():
            got.setdefault((r.conv_id, r.turn), []).append(r)
        brief = {k: [(r.parent_turn, r.n_quotes, r.n_linked, r.branch_turn, r.position) for r in v] for k, v in got.items()}
        assert brief[1, 0] == [(None, 0, 0, 0, 0)] and brief[1, 1] == [(0, 0, 0, 0, 1)]
        assert brief[1, 2] == [(0, 1, 1, 2, 0)] and brief[1, 3] == [(2, 2, 2, 2, 1)] and brief[1, 4] == [(3, 0, 0, 2, 2)]
        assert brief[1, 5] == [(1, 1, 1, 5, 0)] and brief[1, 6] == [(5, 1, 0, 5, 1)]
        assert sorted(x[-1] for x in brief[2, 1]) == [1, 2] and got[2, 0][0].text == "" and brief[None, 1] == [(None, 0, 0, 1, 0)]
        assert got[1, 3][0].text == "Use reverse=True." and got[1, 0][0].text == rows[0][3]
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.link_quotations(spark, empty).count() == 0


def test_partial_quotations(spark):
    """Repeated lines, a sentence out of a line, a re-wrapped part of a paragraph; and random ones against brute force."""
    rows = [(1, 0, "Dear all\nthe build fails on the second node\nsince the update of last night\nBest regards, Ann"),
            (1, 1, "Dear all\nI will look at it. Which version is it now? Tell me more\nabout the node and its disks please.\nBest regards, Ann"),
            (1, 2, "> Dear all\n> the build fails on the second node\n> Best regards, Ann\nsame here"),
            (1, 3, "> Which version is it now?\nthree"), (1, 4, "> tell me more about\n> the node and its disks\nnothing to tell"),
            (1, 5, "> tell me more about the weather in spring\nno")]
    rng = random.Random(2)
    for turn in range(60):
        own = "\n".join(" ".join(rng.choices("abcdefgh", k=rng.randrange(3, 9))) for _ in range(4))
        past = [x for c, t, x in rows if c == 2]
        quote = rng.choice(past).split("\n") if past and turn % 2 else []
        quote = [x for x in quote if not x.startswith(">")][1:]
        if quote and turn % 3:
            quote[0] = "z " + quote[0]
        rows.append((2, turn, "\n".join(["> " + x for x in quote] + [own])))
    talk = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    messages = talk.select(F.col("conv_id").alias("conv"), "turn", "role", "text", (F.col("conv_id") * 1000 + F.col("turn")).alias("row_no"))
    got = {r.row_no: r.origin for r in chat.link_passages(messages).collect()}

    def parts(lines):
        words, at, out = " ".join(lines).split(), 0, []
        for x in lines:
            out.append((at, x.split()))
            at += len(x.split())
        return words, out + [(i, words[i:i + chat.SHINGLE]) for i in range(len(words) - chat.SHINGLE + 1)]

    def plain(conv, turn, lines):
        words, asked = parts(lines)
        whole, good = [], []
        for c, t, x in rows:
            if c == conv and t < turn:
                own = [y.lower() for y in x.split("\n") if not y.startswith(">")]
                flat, held = parts(own)
                held = {" ".join(w) for _, w in held} | {" ".join(flat)} | set(re.split(r"(?<=[.!?])\s+", " ".join(flat)))
                weight = len({at + i for at, w in asked if " ".join(w) in held for i in range(len(w))})
                whole += [t] * (" ".join(words) in held)
                good += [(weight, t)] * (10 * weight >= 8 * len(words))
        return max(whole) if whole else max(good)[1] if good else None

    want = {}
    for c, t, x in rows:
        lines = [y[2:].lower() for y in x.split("\n") if y.startswith(">")]
        if lines:
            want[1000 * c + t] = plain(c, t, lines)
    assert got == want and [got[1000 + i] for i in (2, 3, 4, 5)] == [0, 1, 1, None]
    assert sum(v is not None for k, v in got.items() if k >= 2000) > 10
    linked = {r.turn: r.parent_turn for r in chat.link_quotations(spark, talk.where("conv_id = 1")).collect()}
    assert linked[2] == 0 and linked[3] == 1 and linked[4] == 1 and linked[5] == 4


@pytest.mark.parametrize("text", ["a" * 50_000, "1" * 50_000, "+" * 5_000 + "1"])
def test_long_runs_take_linear_time(text):
    assert pii.base_spans(text) == []
