"""Edge cases and brute force for the numbered operators, on small tables made here."""

from __future__ import annotations

import base64
import hashlib
import itertools
import pickle
import random
import re
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chatloom.llm import decontamination as DC
from chatloom.llm import jaccard_join as J
from chatloom.llm import langid, lmscore, pii, quality, toxicity, warc
from chatloom.llm import sentencepieces as SP
from chatloom.llm import token_counts as TC
from chatloom.llm.common import scratch, words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " ", "\n\n", "a", "é" * 3, "word " * 12, "x" * 30_000, "😀 ▁ \u0000 \x0b"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, blanks, ties, a repeated row, a very long word, and columns whose names an operator uses itself."""
    rows = [(i, t, "en" if i % 2 else None, None, None) for i, t in enumerate(ODD)] + [(6, "word " * 12, None, None, None), (50, "word " * 12, "en", "s", 1)]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit("clash") for c in ("words", "kept", "class_id", "node", "score", "item_ids", "token_ids", "copy_key", "lang_key", "pii_all")})


def texts(n=120, seed=1):
    rnd = random.Random(seed)
    lexicon = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    base = [" ".join(rnd.choice(lexicon) for _ in range(rnd.randint(30, 90))) for _ in range(n // 4)]
    out = []
    for _ in range(n):
        w = rnd.choice(base).split()
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(len(w))] = rnd.choice(lexicon)
        out.append(" ".join(w))
    return out


# 1


def brute_classes(docs):
    sets = {}
    for i, t in docs:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (t or "").lower()) if x]
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    links = {i: set() for i in sets}
    for i, j in itertools.combinations(sets, 2):
        a, b = sets[i], sets[j]
        if a and b and 5 * len(a & b) >= 4 * len(a | b):
            links[i].add(j), links[j].add(i)
    label = {}
    for i in sorted(sets):
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in label:
                label[x] = i
                todo += links[x]
    return {i: (label[i], len(links[i])) for i in sets}


def test_jaccard_join_is_brute_force(spark):
    docs = list(enumerate(texts(240)))
    got = {r.doc_id: (r.class_id, r.n_links) for r in J.jaccard_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_classes(docs)


def test_jaccard_join_of_a_large_group(spark):
    """More near copies than a small node and a block hold; numbers of links stay exact."""
    rnd, base = random.Random(3), [f"w{i}" for i in range(200)]
    docs = []
    for i in range(300):
        w = list(base)
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(200)] = f"z{rnd.randrange(50)}"
        docs.append((i, " ".join(w)))
    got = {r.doc_id: (r.class_id, r.n_links) for r in J.jaccard_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_classes(docs)


def test_jaccard_join_inside_a_crowd(spark):
    """Pairs at 0.82 among texts that share a passage and have similarities of 0.4 to 0.6 with each other."""
    rnd, passage, docs = random.Random(7), [f"p{i}" for i in range(64)], []
    for i in range(2500):
        own = rnd.randint(25, 43)
        docs.append((i, " ".join(passage + [f"u{i}x{k}" for k in range(own)])))
        if i % 50 == 0:
            keep = own - (60 + own) // 10
            docs.append((10_000 + i, " ".join(passage + [f"u{i}x{k}" for k in range(keep)] + [f"v{i}x{k}" for k in range(own - keep)])))
    number, sets = {}, []
    for _, text in docs:
        w = text.split()
        sets.append({number.setdefault(tuple(w[k : k + 5]), len(number)) for k in range(len(w) - 4)})
    links = {i: [] for i, _ in docs}
    for (a, x), (b, y) in itertools.combinations(zip(links, sets, strict=True), 2):
        if 9 * len(x & y) >= 4 * (len(x) + len(y)):
            links[a].append(b), links[b].append(a)
    assert sum(map(len, links.values())) == 100
    got = {r.doc_id: (r.class_id, r.n_links) for r in J.jaccard_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: (min([i, *near]), len(near)) for i, near in links.items()}


def test_jaccard_join_odd(odd):
    got = {r.doc_id: (r.class_id, r.n_links) for r in J.jaccard_classes(odd).collect()}
    assert got == {**{i: (i, 0) for i in range(9)}, 6: (6, 1), 50: (6, 1)}
    assert J.jaccard_classes(odd.limit(0)).count() == 0


def test_runs_reach_the_target():
    for depth in (1, J.DEEP):
        assert 1 - (1 - J.level_recall(depth)) ** J.runs_for(depth) >= J.RECALL


def crowd(n, seed):
    """n texts around one passage, with similarities of about 0.6 to each other, and a near copy at 0.8 to 0.86 of every 20th."""
    rnd, passage, docs, pairs = random.Random(seed), [f"p{i}" for i in range(90)], [], []
    for i in range(n):
        own = [f"u{i}x{k}" for k in range(rnd.randint(26, 34))]
        docs.append((i, " ".join(passage + own)))
        if i % 20 == 0:
            keep = len(own) - rnd.randint(8, 12)
            docs.append((n + i, " ".join(passage + own[:keep] + [f"v{i}x{k}" for k in range(len(own) - keep)])))
            pairs.append((i, n + i))
    return docs, pairs


def test_rows_grow_with_the_sets_of_a_crowd(spark, monkeypatch):
    seen, inner = [], J.links_in_groups

    def counted(docs, groups, *rest):
        sizes = [r.n for r in groups.groupBy("component").agg(F.count("*").alias("n")).collect()]
        seen.append((sum(sizes), sum(n * -(-n // J.BLOCK) for n in sizes), max(sizes)))
        return inner(docs, groups, *rest)

    monkeypatch.setattr(J, "links_in_groups", counted)
    for n in (2000, 8000):
        docs, pairs = crowd(n, n)
        got = {r.doc_id: r.class_id for r in J.jaccard_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
        assert sum(got[a] == got[b] for a, b in pairs) >= 0.95 * len(pairs)
        assert sum(got[i] != i for i, _ in docs) == sum(got[b] == a for a, b in pairs)
    assert seen[1][1] <= 6 * seen[0][1] and seen[1][2] < 200


def test_spanning_forests_have_the_greatest_agreements():
    rnd = np.random.default_rng(2)
    for _ in range(30):
        n = int(rnd.integers(2, 20))
        agree = np.triu(rnd.integers(0, 100, (n, n)), 1)
        agree = agree + agree.T
        got, label, want = J.spanning(agree, 80), list(range(n)), 0
        for w, i, j in sorted(((agree[i, j], i, j) for i in range(n) for j in range(i)), reverse=True):
            if w >= 80 and label[i] != label[j]:
                want, label = want + w, [label[i] if x == label[j] else x for x in label]
        assert sum(w for *_, w in got) == want and all(agree[i, j] == w for i, j, w in got)


def test_cross_pairs_are_brute_force():
    """All pairs over the threshold of a node are found over the runs, none inside a label."""
    rnd = np.random.default_rng(4)
    rows = rnd.integers(0, 2**32, (400, J.T), dtype=np.uint32)
    rows[200:300, :70] = rows[200, :70]
    for i in range(100):
        rows[300 + i] = rows[i]
        rows[300 + i, rnd.choice(J.T, 22, replace=False)] = 0
    labels = np.arange(400)
    labels[300:310] = labels[:10]
    found = set()
    for run in range(J.runs_for(J.DEEP)):
        i, j, _ = J.cross_pairs(np.uint64(run * 7919 + 3), rows, labels)
        found |= set(zip(i.tolist(), j.tolist(), strict=True))
    assert found == {(i, 300 + i) for i in range(10, 100)}


# 2


def test_batches_apply_once_and_deletes_cancel(spark):
    docs = spark.createDataFrame([(1, "s", "en", 3), (2, "s", None, 5), (3, "t", "en", None)], "doc_id long, source string, lang string, n long")
    roll = TC.TokenRollup(spark, scratch(spark, "roll"))
    assert roll.totals().count() == 0
    assert roll.apply("a", TC.inserts(docs, "v1", F.col("n"))) and not roll.apply("a", TC.inserts(docs, "v1", F.col("n")))
    assert roll.apply("b", TC.revisions(docs.where("doc_id = 1"), "v1", F.col("n"), F.col("n") + 10)) and roll.apply("c", TC.deletes(docs.where("doc_id = 2"), "v1", F.col("n")))
    assert roll.apply("d", TC.inserts(docs.limit(0), "v1", F.col("n")))
    want = {("s", "en", "v1"): (1, 13), ("t", "en", "v1"): (1, 0)}
    totals = lambda: {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in roll.totals().collect()}
    assert totals() == want
    assert roll.compact("all") and not roll.compact("all")
    assert totals() == want and not roll.apply("b", TC.inserts(docs, "v1", F.col("n")))


@pytest.mark.parametrize("step", ["_totals", "_commit", "_clean"])
def test_a_crash_while_compacting_changes_no_totals(spark, monkeypatch, step):
    docs = spark.createDataFrame([(1, "s", "en", 3)], "doc_id long, source string, lang string, n long")
    root = scratch(spark, "roll")
    roll = TC.TokenRollup(spark, root)
    assert roll.apply("a/1", TC.inserts(docs, "v1", F.col("n"))) and roll.apply("b", TC.inserts(docs, "v1", F.col("n")))

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(TC.TokenRollup, step, crash)
        with pytest.raises(RuntimeError):
            roll.compact("all")
    again = TC.TokenRollup(spark, root)
    assert [(r.n_docs, r.n_tokens) for r in again.totals().collect()] == [(2, 6)]
    assert not again.apply("a/1", TC.inserts(docs, "v1", F.col("n"))) and again.apply("c", TC.inserts(docs, "v1", F.col("n")))
    again.compact("all")
    again.compact("more")
    assert [(r.n_docs, r.n_tokens) for r in again.totals().collect()] == [(3, 9)] and again.committed("b") and again.committed("c")


def test_of_two_compactions_that_overlap_one_is_refused(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "s", "en", 3)], "doc_id long, source string, lang string, n long")
    root = scratch(spark, "roll")
    one, two = TC.TokenRollup(spark, root), TC.TokenRollup(spark, root)
    assert one.apply("a", TC.inserts(docs, "v1", F.col("n"))) and one.apply("b", TC.inserts(docs, "v1", F.col("n")))
    totals = lambda roll: [(r.n_docs, r.n_tokens) for r in roll.totals().collect()]
    inner, results = TC.TokenRollup._totals, []

    def meanwhile(self, commits):
        """The other compaction runs between this one's reading and its commit, and a batch comes in."""
        monkeypatch.undo()
        results.append(two.compact("second"))
        assert two.apply("c", TC.inserts(docs, "v1", F.col("n")))
        return inner(self, commits)

    monkeypatch.setattr(TC.TokenRollup, "_totals", meanwhile)
    results.append(one.compact("first"))
    assert results == [True, False] and totals(one) == totals(two) == [(3, 9)]
    assert one.committed("a") and one.committed("c") and not one.apply("b", TC.inserts(docs, "v1", F.col("n")))
    # Who read before a compaction still can after it.
    before = one.totals()
    assert one.compact("third") and [(r.n_docs, r.n_tokens) for r in before.collect()] == [(3, 9)] and totals(two) == [(3, 9)]
    assert one.compact("fourth") and one.compact("fifth") and totals(two) == [(3, 9)]
    assert len(one._listed("generations")) == 2 and not one._listed("commits") and one.committed("a")


# 3


def base_by_hand(text):
    t = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
    five = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    covered = {i + k for i, f in enumerate(five) if five.count(f) > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_quality_base_counts(spark, odd):
    extra = ["a b c d e f a b c d e x", "l #1\nl #1\n|\n|\n", "a a a a a a a", "é b c\x0cd"]
    df = odd.select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(100 + i, t, "en") for i, t in enumerate(extra)], "doc_id long, text string, lang string"))
    by_id = dict(enumerate(ODD)) | {50: "word " * 12} | {100 + i: t for i, t in enumerate(extra)}
    rows = quality.quality_rules(df).collect()
    assert len(rows) == len(ODD) + 2 + len(extra)
    for r in rows:
        n = base_by_hand(by_id[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n, r
        assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0]) and (not r.kept or not r.base_failed)
    assert quality.quality_rules(odd.limit(0)).count() == 0


def test_divergent_texts_go(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice(["the", "of", "and", f"n{rnd.randrange(999)}word"]) for _ in range(80)), "en") for i in range(60)]
    rows += [(100, " ".join(f"QX{rnd.randrange(9999)}*#" for _ in range(80)), "en")]
    out = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).where("NOT base_failed").collect()
    assert [r.doc_id for r in out if not r.kept] == [100] and len(out) > 30


def test_a_text_without_common_words_goes(spark):
    """A language with a fifth of common words, all of five letters and more, in Cyrillic; and a mixture that has no name."""
    rnd = random.Random(9)
    common = ["также", "потому", "которые", "сегодня", "человек", "может", "очень"]
    letters = "абвгдежзиклмнопрстуфхцчшыэюя"
    word = lambda: "".join(rnd.choice(letters) for _ in range(rnd.randint(3, 9)))
    say = lambda n, share: " ".join(rnd.choice(common) if rnd.random() < share else word() for _ in range(n))
    rows = [(i, say(rnd.choice([60, 150, 400]), 0.2), "ru") for i in range(120)] + [(500 + i, say(200, 0), "ru") for i in range(5)]
    english = ["therefore", "because", "which", "today", "human"]
    rows += [(600 + i, say(200, 0.2) if i % 2 else " ".join(rnd.choice(english) if rnd.random() < 0.2 else f"w{rnd.randrange(10**6)}" for _ in range(200)), None) for i in range(60)]
    out = {r.doc_id: r for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(out[i].word_distance is not None for i in range(120)) and {i for i, r in out.items() if not r.kept} == set(range(500, 505))


@pytest.mark.parametrize("share", [0.2, 0.5, 0.6, 0.8])
@pytest.mark.parametrize("kind", ["letters", "codes"])
def test_junk_goes_at_any_share(spark, share, kind):
    rnd = random.Random(int(share * 10))
    common = ["the", "of", "and", "to", "in", "is", "that", "for"]
    letters = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(3, 9)))
    codes = lambda: f"X{rnd.randrange(10**6)}#{rnd.randrange(99)}"
    good = lambda n: " ".join(rnd.choice(common) if rnd.random() < 0.4 else letters() for _ in range(n))
    junk = lambda n: " ".join((letters if kind == "letters" else codes)() for _ in range(n))
    bad = int(200 * share)
    rows = [(i, (junk if i < bad else good)(rnd.choice([60, 150, 400])), "en") for i in range(200)]
    out = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert {r.doc_id for r in out if not r.kept} == set(range(bad))


def test_common_counts_are_the_words(spark):
    df = spark.createDataFrame([(["a", "a", "ab", "a", "é", "b"], ["a", "b", "c", "é"])], "w array<string>, c array<string>")
    assert df.select(quality.common_counts(F.col("w"), F.col("c"))).first()[0] == [3.0, 1.0, 0.0, 1.0]


# 4


def luhn(d):
    return sum(int(x) if i % 2 == 0 else sum(divmod(2 * int(x), 10)) for i, x in enumerate(reversed(d))) % 10 == 0


def spans_by_hand(text):
    out = []
    for rank, (kind, rx, ok) in enumerate([
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(d := re.sub(r"\D", "", m)) <= 19 and luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"\D", "", m)) <= 15),
    ]):
        out += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(rx, text or "") if ok(m[0])]
    return ",".join(x for _, _, x in sorted(out))


PII = [
    "mail a.b@c.de_f@g.hi, x@y, @z.w and q@r.s.t.", "1.2.3.4.5.6.7.8 999.1.1.1 0255.1.1.1 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 12", "+1 (377) 555-0271 +12 +1 23456789012345678",
    "😀é 4111111111111111 é+49 30 1234567", "GB82 WEST 1234 5698 7654 32 and GB82WEST12345698765433", "ssn 078-05-1120; 078-05-1121" + " " * 60, "9" * 40_000, "a" * 40_000 + "@", "1." * 9000, None, "",
]


def test_pii_is_the_plain_regex(spark):
    df = spark.createDataFrame(list(enumerate(PII)), "doc_id long, text string").withColumn("spans", F.lit(1))
    rows = pii.find_pii(df).select("doc_id", pii.joined(pii.all_spans(pii.BASE)).alias("base"), pii.joined(pii.all_spans(list(pii.KINDS))).alias("every")).collect()
    for r in rows:
        assert r.base == spans_by_hand(PII[r.doc_id])
    every = {r.doc_id: r.every for r in rows}
    assert "iban:0:27" in every[5] and every[5].count("iban") == 1 and every[6] == "ssn:4:15,ssn:17:28"


SCORED = [
    ("GB82 WEST 1234 5698 7654 32 BIC ABC", ["iban:0:27:70"]), ("GB82WEST12345698765432 12.50 EUR", ["iban:0:22:70"]), ("our account GB82WEST12345698765432", ["iban:12:34:100"]),
    ("XGB82WEST12345698765432", []), ("GB82WEST123456987654321", []), ("sample GB82WEST12345698765432", []), ("GB82WEST1234569876543", []),
    ("ssn 1234-56-78901", []), ("ssn 000-12-3456, 666-12-3456, 912-12-3456, 123-00-4567, 123-12-0000", []), ("ssn 123-12-4567", ["ssn:4:15:60"]), ("123-12-4567", []),
    ("ssn test 123-12-4567", []), ("assn 123-12-4567", []), ("ssn" + " " * 40 + "123-12-4567", []), ("ssn" + " " * 36 + "123-12-4567", ["ssn:39:50:60"]),
    ("a ship at 1.2.3.4", ["ip:10:17:60"]), ("its ip: 1.2.3.4", ["ip:8:15:90"]), ("hotel +1 (377) 555-0271", ["phone:6:23:60"]), ("tel. +1 (377) 555-0271", ["phone:5:22:90"]),
]


def test_context_and_borders_decide(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(SCORED)], "doc_id long, text string")
    got = pii.find_pii(df).select("doc_id", pii.all_spans(list(pii.KINDS)).alias("s")).orderBy("doc_id").collect()
    assert [[f"{s.kind}:{s.start}:{s.end}:{s.score}" for s in r.s] for r in got] == [w for _, w in SCORED]


def test_pii_of_repeated_rows_and_none(spark, odd):
    rows = pii.mask_pii(odd.unionByName(odd)).groupBy("doc_id", "text").count().collect()
    assert all(r["count"] % 2 == 0 for r in rows) and sum(r["count"] for r in rows) == 2 * (len(ODD) + 2)
    assert pii.mask_pii(odd.limit(0)).count() == pii.find_pii(odd.limit(0)).count() == 0


def test_masking(spark):
    df = spark.createDataFrame([(0, "x a@b.cd +1 (377) 555-0271 é", 7), (1, None, None), (2, "clean", 5)], "doc_id long, text string, n_chars long")
    assert [(r.text, r.n_chars) for r in pii.mask_pii(df).orderBy("doc_id").collect()] == [("x <EMAIL> <PHONE> é", 19), (None, None), ("clean", 5)]


# 5


def test_language_id(spark, odd):
    rnd = random.Random(2)
    rows = [(i, " ".join("".join(rnd.choice(a) for _ in range(4)) for _ in range(9)), lang, None, None) for i in range(200) for lang, a in [rnd.choice([("aa", "abcd"), ("bb", "xyzé")])]]
    docs = spark.createDataFrame(rows, DOCS)
    model = langid.learn(docs.where("doc_id < 150"))
    held = langid.predict(docs.where("doc_id >= 150"), model).join(docs, "doc_id")
    assert held.where("lang_pred <> lang").count() == 0
    out = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(odd, model).collect()}
    assert out[0] == out[1] == out[2] == ("und", 0.0) and out[4][0] in ("aa", "bb") and all(0 <= s <= 1 for _, s in out.values())
    assert langid.predict(odd.limit(0), model).count() == 0
    assert {r.lang_pred for r in langid.predict(odd, langid.learn(odd.limit(0))).collect()} == {"und"}


def by_plain_counts(text, train):
    """The language with the most n-grams of text among its frequent ones, by plain counting."""
    def grams(t):
        x = [c if c.isalpha() else "" for c in ["", *t.lower(), ""]]
        return [(x[i - 1], x[i], x[i + 1]) for i in range(1, len(x) - 1) if x[i]]

    counts = {}
    for t, lang in train:
        for g in grams(t):
            counts.setdefault(lang, {}).setdefault(g, 0)
            counts[lang][g] += 1
    known = {lang: {g for g, n in c.items() if n >= langid.SHARE * sum(c.values())} for lang, c in counts.items()}
    return {lang: sum(g in k for g in grams(text)) for lang, k in known.items()}


@pytest.mark.parametrize("n", [3, 64, 65, 130])
def test_language_id_is_plain_counting(spark, n):
    """Languages of overlapping alphabets, as many as one mask word, more than one, and three words hold."""
    rnd = random.Random(n)
    alphabets = {f"l{k:03d}": rnd.sample([chr(c) for c in [*range(97, 123), *range(0x430, 0x450)]], 9) for k in range(n)}
    say = lambda a, k: " ".join("".join(rnd.choice(a) for _ in range(4)) for _ in range(k))
    train = [(say(a, 60), lang) for lang, a in alphabets.items()]
    held = [(i, say(alphabets[rnd.choice(list(alphabets))], 12)) for i in range(60)]
    model = langid.learn(spark.createDataFrame(train, "text string, lang string"))
    got = {r.doc_id: r.lang_pred for r in langid.predict(spark.createDataFrame(held, "doc_id long, text string"), model).collect()}
    for i, t in held:
        want = by_plain_counts(t, train)
        assert want[got[i]] >= max(want.values()) - 1, i
    assert model.masks.shape[0] == -(-n // 64)


def test_counts_are_handed_on_in_parts(monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["abab", None, "ab", "é"] * 5), pa.array(["x", "x", "y", "y"] * 5)], ["text", "lang"])
    whole = [tuple(r.values()) for b in langid._count([batch] * 3, ["x", "y"]) for r in b.to_pylist()]
    monkeypatch.setattr(langid, "HELD", 1)
    parts = {}
    for b in langid._count([batch] * 3, ["x", "y"]):
        for r in b.to_pylist():
            parts[r["lang"], r["gram"]] = parts.get((r["lang"], r["gram"]), 0) + r["n"]
    assert {(a, b): n for a, b, n in whole} == parts and sum(n for *_, n in whole) == 105


def test_filter_has_no_false_negatives():
    grams = np.arange(1, 3000, dtype=np.uint64) * np.uint64(7919)
    f = langid.Filter(["a", "b"], [grams[:1500], grams[1000:]], 0)
    masks = f.languages(grams)[0]
    assert (masks[:1500] & np.uint64(1)).all() and (masks[1000:] & np.uint64(2)).all() and (masks[:1000] & np.uint64(2)).mean() < 0.01


# 6


def edits_by_hand(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_least_edits():
    rnd = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12))) for _ in range(2))
        assert DC.least_edits(a, b) == edits_by_hand(a, b)


def test_decontamination_finds_edited_items(spark):
    rnd, base = random.Random(4), texts(60, 9)
    items = [(i, t[: rnd.randint(90, 200)]) for i, t in enumerate(base[:20])] + [(20, "a short item of text"), (21, ""), (22, None), (3, base[40][:120])]
    rows, want = [], []
    for n in range(200):
        item_id, text = rnd.choice(items[:20])
        chars = list(text)
        for _ in range(int(0.05 * len(chars))):
            chars[rnd.randrange(len(chars))] = rnd.choice("abcdefgh ")
        other = texts(4, 1000 + n)[0]
        rows.append((n, f"{other} {''.join(chars)} {other}" if n % 2 == 0 else other))
        want.append(item_id if n % 2 == 0 else None)
    rows += [(300, "x\nA SHORT item\tof text y"), (301, None), (302, base[40][:120])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_ids", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in DC.find_items(docs, bench).collect()}
    planted = [n for n in range(200) if want[n] is not None]
    assert sum(want[n] in got[n] for n in planted) >= 0.97 * len(planted)
    assert not [n for n in range(200) if want[n] is None and got[n]]
    assert got[300] == [20] and got[301] == [] and 3 in got[302]
    blocks = {r.doc_id: r.item_ids for r in DC.find_items(docs, bench, block=5 * DC.EACH).collect()}
    assert sum(blocks[n] == got[n] for n in got) >= 0.97 * len(got)
    assert DC.find_items(docs, bench.limit(0)).where("size(item_ids) > 0").count() == 0


def test_decontamination_is_brute_force(spark):
    """Every document with every item, of all length classes, at all edit rates up to and over the limit."""
    rnd = random.Random(21)
    lexicon = texts(60, 77)
    items = [(i, lexicon[i % 60][: rnd.choice([20, 40, 70, 100, 170, 260])].strip()) for i in range(36)]
    rows = []
    for n in range(140):
        item, other = list(rnd.choice(items)[1]), texts(4, 3000 + n)[0]
        for _ in range(int(rnd.choice([0, 0.03, 0.06, 0.1, 0.2]) * len(item))):
            k = rnd.randrange(len(item))
            item[k : k + 1] = rnd.choice(["", rnd.choice("abcdefgh"), item[k] + rnd.choice("abcdefgh")])
        rows.append((n, f"{other} {''.join(item)} {other}" if n % 3 else other))
    want = {(n, i) for n, t in rows for i, x in items if DC.least_edits(x, t) <= int(DC.RATE * len(x))}
    got = {(r.doc_id, i) for r in DC.find_items(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect() for i in r.item_ids}
    assert got <= want and len(got) >= 0.97 * len(want) and len(want) > 60
    for low, high in ((0, 80), (80, 160), (160, 999)):
        own = {(n, i) for n, i in want if low <= len(items[i][1]) < high}
        assert len(got & own) >= 0.95 * len(own) and own


def test_walks_find_items_without_the_pieces(monkeypatch):
    """The walks alone: exact and lightly edited items of every class down to LEAST bytes."""
    rnd, lexicon = random.Random(2), texts(40, 5)
    for size, steps, stride, least in ((30, DC.FEW, 1, 0.8), (60, DC.FEW, 1, 0.9), (100, DC.STEPS, DC.STRIDE, 0.8), (200, DC.STEPS, DC.STRIDE, 0.95)):
        items = [(i, lexicon[i][:size].encode()) for i in range(40)]
        index, found = DC.build(items, steps, stride), 0
        for i, item in items:
            raw = bytearray(item)
            for k in rnd.sample(range(len(raw)), int(0.03 * len(raw))):
                raw[k] = 35
            data = np.frombuffer(b"some words before it " + bytes(raw) + b" and some after" + b"\0" * 80, dtype=np.uint8)
            starts = np.array([m.start() for m in re.finditer(rb"[^\x20\0]+", data.tobytes())])[::stride]
            _, entry = DC.candidates(data, starts, index)
            found += i in {int(index.entries[e][0]) for e in entry}
        assert found >= least * len(items), size


@pytest.mark.parametrize("kind", ["ascii", "han", "spaced"])
def test_the_index_of_a_full_block_is_bounded(spark, kind):
    """Items of over a block, unspaced (an entry a character) and spaced, are cut so that no block's index passes 100 MB."""
    rnd = random.Random(1)
    letters = "一二三四五六七八九十" if kind == "han" else "abcdefghij"
    one = "".join(rnd.choice(letters) for _ in range(3000))
    one = " ".join(one[i : i + 5] for i in range(0, 3000, 5)) if kind == "spaced" else one
    items = [(i, one[k:] + one[:k]) for i, k in enumerate(range(0, 900 if kind == "spaced" else 220))]
    placed = DC.in_blocks(spark.createDataFrame(items, "item_id long, text string")).collect()
    blocks = {b: [(r.item_id, DC._plain(r.text)) for r in placed if r.block == b] for b in {r.block for r in placed}}
    assert len(placed) == len(items) and len(blocks) == 2
    sizes = [len(pickle.dumps(DC.build(x, DC.STEPS, DC.STRIDE))) for x in blocks.values()]
    assert 50e6 < max(sizes) < 100e6


@pytest.mark.parametrize("block", [DC.BLOCK, 50 * DC.EACH])
def test_decontamination_rows_do_not_depend_on_blocks(spark, odd, block):
    """2,001 items, repeated rows, blank and very long texts: a row for every row, in one block or many."""
    items = [(i, f"item number {i} of the list") for i in range(2001)]
    rows = [(1, "here is item number 1999 of the list"), (1, "here is item number 1999 of the list"), (1, "item number 5 of the list"), (2, None), (3, "")]
    rows += [(4, "word " * 40_000 + "item number 77 of the list"), (None, "item number 6 of the list")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1)), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.item_ids) for r in DC.find_items(docs, bench, block=block).collect()), key=str)
    near = lambda k: sorted(i for i, t in items if DC.least_edits(t, f"item number {k} of the list") <= int(DC.RATE * len(t)))
    want = [(1, near(1999)), (1, near(1999)), (1, near(5)), (2, []), (3, []), (4, near(77)), (None, near(6))]
    assert got == sorted(want, key=str)
    assert DC.find_items(odd, bench, block=block).count() == len(ODD) + 2 and DC.find_items(docs.limit(0), bench, block=block).count() == 0


@pytest.mark.parametrize("size", [15, 16, 18, 30, 60, 75, 85, 140])
def test_short_items_are_found_at_the_limit_of_edits(spark, size):
    rnd, lexicon = random.Random(size), texts(40, 5)
    rows, items = [], []
    for i in range(80):
        item = lexicon[i % 40][i : i + size].strip().ljust(size, "x")
        chars = list(item)
        for k in rnd.sample(range(size), int(DC.RATE * size) if size >= DC.LEAST else 0):
            chars[k] = "#"
        items.append((i, item))
        rows.append((i, f"{texts(4, 500 + i)[0]} {''.join(chars)} {texts(4, 900 + i)[0]}"))
    got = {r.doc_id: r.item_ids for r in DC.find_items(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert all(i in got[i] for i, _ in items)


def test_items_inside_text_without_spaces_are_found(spark):
    rnd = random.Random(11)
    run = lambda n: "".join(chr(rnd.randrange(0x4E00, 0x5E00)) for _ in range(n))
    items = [(i, run(40 if i % 2 else 80)) for i in range(40)]
    items += [(40 + i, "".join(rnd.choice("abcdefgh/=<>") for _ in range(200))) for i in range(20)]
    rows = [(i, f"{run(rnd.randint(30, 90))}{t}{run(60)}") for i, t in items] + [(900, run(500))]
    got = {r.doc_id: r.item_ids for r in DC.find_items(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {i: [i] for i, _ in items} | {900: []}


def test_tiny_items_stand_exactly(spark):
    docs = spark.createDataFrame([(0, "say yes! now"), (1, "eyes"), (2, "YES"), (3, "眼はい耳"), (4, "ye s")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "yes"), (8, "はい"), (9, " ")], "item_id long, text string")
    assert {r.doc_id: r.item_ids for r in DC.find_items(docs, bench).collect()} == {0: [7], 1: [], 2: [7], 3: [8], 4: []}


# 7


def test_toxicity(spark, odd):
    rnd = random.Random(6)
    bad = ["vile", "awful", "rotten"]
    rows, marks = [], []
    for i in range(1500):
        w = [f"w{rnd.randrange(400)}" for _ in range(40)]
        if i % 8 == 0:
            for _ in range(3):
                w[rnd.randrange(40)] = rnd.choice(bad)
        rows.append((i, " ".join(w)))
        marks.append((i, int(i % 8 == 0)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.learn(docs.where("doc_id < 1000"), labels.where("doc_id < 1000"))
    out = toxicity.score(docs.where("doc_id >= 1000"), model).join(labels, "doc_id").collect()
    assert sum((r.score >= 0.7) == bool(r.toxic) for r in out) >= 0.97 * len(out)
    assert {r.score for r in toxicity.score(odd, toxicity.learn(docs, labels.where("toxic = 0"))).collect()} == {0.0}
    scores = {r.doc_id: r.score for r in toxicity.score(odd, model).collect()}
    assert scores[0] == scores[1] and all(0 <= s <= 1 for s in scores.values())


def plain_nnpu(x, positive, unlabelled, prior, rounds, rate, decay):
    """The non-negative risk document by document, gradients by hand, Adam."""
    n, d = x.shape
    w, b = np.zeros(d), np.log(prior / (1 - prior))
    m = v = np.zeros(d + 1)
    p, u = np.flatnonzero(positive), np.flatnonzero(unlabelled)
    for t in range(1, rounds + 1):
        gw, gb, up, un = np.zeros(d), 0.0, 0.0, 0.0
        rest = []
        for side, own, sign in (("p", p, prior / len(p)), ("u", u, 1 / len(u))):
            for i in own:
                f = x[i] @ w + b
                s = 1 / (1 + np.exp(-f))
                rest.append((-sign if side == "p" else sign, np.log1p(np.exp(f)), s, i))
        total = sum(k * loss for k, loss, *_ in rest)
        for k, _, s, i in rest:
            g = k * s if total >= 0 else -k * s
            gw, gb = gw + g * x[i], gb + g
        if total >= 0:
            for i in p:
                s = 1 / (1 + np.exp(-(x[i] @ w + b)))
                gw, gb = gw + prior / len(p) * (s - 1) * x[i], gb + prior / len(p) * (s - 1)
        g = np.append(gw + decay * w, gb)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


@pytest.mark.parametrize("prior", [0.1, 0.6])
def test_the_fit_is_the_plain_non_negative_risk(monkeypatch, prior):
    rnd = np.random.default_rng(4)
    x = (rnd.random((40, 6)) < 0.3).astype(float)
    positive, unlabelled = np.arange(40) < 10, np.arange(40) >= 6
    monkeypatch.setattr(toxicity, "ROUNDS", 60)
    row, col = np.nonzero(x)
    got = toxicity.fit(np.arange(6, dtype=np.uint64), row, col, positive, unlabelled, prior)
    w, b = plain_nnpu(x, positive, unlabelled, prior, 60, toxicity.RATE, toxicity.DECAY)
    assert np.allclose(got.weights, w) and abs(got.bias - b) < 1e-9


def test_toxicity_of_empty_tables(spark, odd):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1)], "doc_id long, toxic int")
    for docs, marks in ((odd.limit(0), labels), (odd, labels.limit(0)), (odd, labels)):
        model = toxicity.learn(docs, marks)
        assert toxicity.score(odd, model).count() == len(ODD) + 2 and toxicity.score(odd.limit(0), model).count() == 0


# 8


def test_warc_round_trip_and_bytes(spark):
    html = [None, "", "<p>a</p>", "<p>é</p>" * 500, "<p>a</p>", "<p>a</p>"]
    rows = [(i, f"http://x/{i}" if i % 2 else None, h) for i, h in enumerate(html)] + [(5, "http://x/5", "<p>a</p>"), (None, "u", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("shard", F.lit("clash"))
    root = scratch(spark, "warc")
    warc.write_archive(pages, root, shard_bytes=3000, roll_bytes=600)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.read_archive(spark, root).collect()), key=str)
    b32 = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    kinds = {0: ("revisit", 1), 1: ("response", None), 2: ("revisit", 5), 3: ("response", None), 4: ("revisit", 5)}
    want = [(i, *kinds[i], len((html[i] or "").encode()), b32(html[i])) for i in range(5)]
    want += [(5, "response", None, 8, b32(html[5])), (5, "revisit", 5, 8, b32(html[5])), (None, "response", None, 1, b32("z"))]
    assert got == sorted(want, key=str)
    again = scratch(spark, "warc")
    warc.write_archive(pages, again, shard_bytes=3000, roll_bytes=600)
    sums = lambda r: {tuple(x) for x in spark.read.schema(warc.MANIFEST).json(f"{r}/manifest").collect()}
    assert sums(root) == sums(again) and len(sums(root)) > 1
    with pytest.raises(FileExistsError):
        warc.write_archive(pages, again)
    none = scratch(spark, "warc")
    warc.write_archive(pages.limit(0), none)
    assert warc.read_archive(spark, none).count() == 0
    small = scratch(spark, "warc")
    warc.write_archive(pages, small, min_bytes=100)
    assert {r.record_type for r in warc.read_archive(spark, small).collect()} == {"response"}


def test_a_task_that_runs_again_leaves_its_files(tmp_path, monkeypatch):
    """On a file system that refuses a rename over a file; one file was left cut off; and a payload is larger than a file."""
    inner = warc._Shard.__init__

    class Strict:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def move(self, a, b):
            if Path(b).exists():
                raise OSError("exists")
            self.fs.move(a, b)

    def strict(self, *args):
        inner(self, *args)
        self.fs = Strict(self.fs)

    monkeypatch.setattr(warc._Shard, "__init__", strict)
    rnd = random.Random(3)
    bodies = [bytes(rnd.randrange(256) for _ in range(n)) for n in (10, 5000, 300, 40)]
    rows = [(0, i, hashlib.sha1(b).hexdigest(), None, b, None) for i, b in enumerate(bodies)]
    types = (pa.int32(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64())
    batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["shard", "page_id", "sha1", "url", "payload", "refers_to"])
    run = lambda: next(warc._write(iter([batch]), tmp_path.as_uri(), 2000)).to_pylist()
    first = run()
    assert [f["records"] for f in first] == [2, 2] and first[0]["bytes"] > 5000
    cut = tmp_path / "records" / first[1]["file"]
    cut.write_bytes(cut.read_bytes()[:-9])
    assert run() == first == run() and not any((tmp_path / "_temporary").iterdir())
    for f in first:
        assert hashlib.sha1((tmp_path / "records" / f["file"]).read_bytes()).hexdigest() == f["sha1"]


def test_places_are_those_of_the_plain_search():
    rnd = random.Random(8)
    key = lambda: (rnd.choice([-5, 0, 7, 7, 9, 1 << 40]), f"{rnd.randrange(16):x}")
    bounds = sorted({(-(1 << 63), "0")} | {key() for _ in range(20)})
    rows = [key() for _ in range(300)]
    want = [max(i for i, b in enumerate(bounds) if b <= r) for r in rows]
    split = (np.array([p for p, _ in bounds], dtype=np.int64), [d for _, d in bounds])
    assert warc.place_of(split, np.array([p for p, _ in rows]), pd.Series([d for _, d in rows])).tolist() == want


def test_warc_shards_follow_bytes_not_gaps(spark):
    """An outlying page_id, and a third of the rows under one page_id with their own payloads."""
    rows = [(7 if i % 3 == 0 else i if i else 10**15, None, f"<p>{i}</p>" * 40) for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    root = scratch(spark, "warc")
    warc.write_archive(pages, root, shard_bytes=20_000, roll_bytes=1 << 20)
    files = spark.read.schema(warc.MANIFEST).json(f"{root}/manifest").collect()
    total = sum(len(h) + warc.HEAD_BYTES for _, _, h in rows)
    assert len(files) >= total // 20_000 and max(f.records for f in files) <= 40
    got = sorted((r.page_id, r.payload_bytes) for r in warc.read_archive(spark, root).collect())
    assert got == sorted((i, len(h)) for i, _, h in rows)


# 9


def test_pieces_are_the_library_s(spark, odd):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=SP.MODEL)
    rnd = random.Random(8)
    alphabet = " \t\nabcdethe▁éß漢字😀.,!?  "
    rows = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(800)] + texts(40) + [t for t in ODD if t is None or "\u0000" not in t] + ["   a  b ", "▁▁a", "a" * 500, " " * 37]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").withColumn("token_ids", F.lit(1))
    out = SP.encode(df).collect()
    assert all(r.token_ids == sp.encode(rows[r.doc_id] or "") and r.n_tokens == len(r.token_ids) and r.decodes_back for r in out)
    back = {r.doc_id: r.text for r in SP.decode(SP.encode(df)).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in enumerate(rows))
    assert SP.encode(odd).count() == len(ODD) + 2 and SP.encode(odd.limit(0)).count() == 0


# 10


def test_pseudo_likelihood_is_position_by_position(spark, odd):
    docs = spark.createDataFrame([*enumerate(texts(60)), (70, "漢字かな жизнь é😀")], "doc_id long, text string").withColumn("code", F.lit(1))
    net = lmscore.learn(docs)
    both = {r.doc_id: r for r in lmscore.score(docs, net).collect()}
    vectors, one, two, given, w1, b1, w2, b2 = (x.astype(float) for x in net.parts)
    logp = lambda z: z - z.max() - np.log(np.exp(z - z.max()).sum())
    for r in docs.where("doc_id < 5 OR doc_id = 70").collect():
        raw = r.text.encode()
        x, total = [0] * lmscore.SIDE + [1 + c for c in raw] + [0] * lmscore.SIDE, 0.0
        for i, c in enumerate(raw):
            s = sum(vectors[k][x[i + lmscore.SIDE + q]] for k, q in enumerate(lmscore.PLACES))
            total += logp(np.tanh(s + one) @ w1 + b1)[c >> 4] + logp(np.tanh(s + two + given[c >> 4]) @ w2 + b2)[c & 15]
        assert both[r.doc_id].n_tokens == len(raw) and abs(total - both[r.doc_id].log_likelihood) < 1e-3 * abs(total)
    rnd = random.Random(1)
    noise = spark.createDataFrame([(0, "".join(rnd.choice("abcdefgh ") for _ in range(2000)))], "doc_id long, text string")
    mean = sum(r.mean_log_likelihood for r in both.values()) / len(both)
    assert lmscore.score(noise, net).first().mean_log_likelihood < mean
    out = {r.doc_id: r for r in lmscore.score(odd.unionByName(odd), net).collect()}
    assert (out[0].n_tokens, out[0].log_likelihood, out[0].mean_log_likelihood) == (0, 0.0, None)
    untrained = lmscore.learn(odd.limit(0))
    assert abs(lmscore.score(odd.where("doc_id = 4"), untrained).first().log_likelihood + np.log(256)) < 1e-6
    assert lmscore.score(odd.limit(0), net).count() == 0


def test_the_gradient_is_the_differences():
    rnd = np.random.default_rng(3)
    net = lmscore.Network([rnd.normal(0, 0.5, x.shape) for x in lmscore.Network().parts])
    data = np.frombuffer("the cat; é 漢".encode() * 3, dtype=np.uint8)
    codes, counts = np.unique(lmscore.windows(data, np.array([0, 20, len(data)])), return_counts=True)
    loss = lambda: -(net.log_probabilities(codes) * counts).sum() / counts.sum()
    for part, grad in zip(net.parts, net.gradient(codes, counts.astype(float)), strict=True):
        flat, at = part.ravel(), rnd.choice(np.flatnonzero(np.abs(grad.ravel()) > 1e-5), 5)
        for i in at:
            old, ends = flat[i], []
            for d in (1e-4, -1e-4):
                flat[i] = old + d
                ends.append(loss())
            flat[i] = old
            assert abs((ends[0] - ends[1]) / 2e-4 - grad.ravel()[i]) < 1e-3 + 0.02 * abs(grad.ravel()[i])


def test_training_in_many_parts_is_averaged(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts(80))], "doc_id long, text string")
    base = np.mean([r.mean_log_likelihood for r in lmscore.score(docs, lmscore.Network()).collect()])
    monkeypatch.setattr(lmscore, "PER_TASK", 300)
    monkeypatch.setattr(lmscore, "MERGE", 2)
    nets = [lmscore.learn(docs) for _ in range(2)]
    means = [np.mean([r.mean_log_likelihood for r in lmscore.score(docs, n).collect()]) for n in nets]
    assert means[0] > base + 0.3 and abs(means[0] - means[1]) < 1e-3


def test_scripts_do_not_share_signs(spark):
    """Of two rows of ideographs, that of the corpus scores higher than that of characters it has never seen."""
    rnd = random.Random(5)
    say = lambda low, n: "".join(chr(low + rnd.randrange(40)) for _ in range(n))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts(200), *(say(0x4E00, 80) for _ in range(30))])], "doc_id long, text string")
    probes = spark.createDataFrame([(0, say(0x4E00, 80)), (1, say(0x9F00, 80))], "doc_id long, text string")
    got = {r.doc_id: r.mean_log_likelihood for r in lmscore.score(probes, lmscore.learn(docs)).collect()}
    assert got[0] > got[1] + 0.5


def test_words_split_on_ascii_white_space(spark):
    df = spark.createDataFrame([("a\tb\u00a0c \x0bd",), (None,)], "t string")
    assert [r[0] for r in df.select(words(F.col("t"))).collect()] == [["a", "b\u00a0c", "d"], []]
