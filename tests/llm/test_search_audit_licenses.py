"""Search, filter audit and license scans against plain versions and on odd rows."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom.llm import filter_audit as FA
from chatloom.llm import licenses as L
from chatloom.llm import search as S

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " \n", "...", "a", "É a1 b" * 3, "word " * 12, "x" * 30_000, "😀 ▁ \u0000 \x0b"]
CLASHES = ("row", "part", "item", "terms", "score", "rank", "n", "E", "good", "place", "labels", "spans", "digest", "first")


def texts(n, seed, size=(1, 60), lexicon=40):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(lexicon)]
    return [" ".join(rnd.choice(words[: rnd.choice((5, lexicon))]) for _ in range(rnd.randint(*size))) for _ in range(n)]


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in CLASHES if c not in df.columns})


# 11


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain_search(docs, items, k=10):
    own = [(i, terms(t)) for i, t in docs if terms(t)]
    n_docs, size = len(own), sum(len(t) for _, t in own)
    df = Counter(x for _, t in own for x in set(t))
    out = []
    for item, text in items:
        found = []
        for i, t in own:
            tf, m = Counter(t), 25 + 75 * len(t) * n_docs // size
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (1_000_000_000 * tf[x] // (1000 * tf[x] + 8 * m)) for x in terms(text) if x in tf)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize(("block", "whole"), [(4096, 1 << 19), (60, 200), (1, 1)])
def test_search_is_brute_force(spark, monkeypatch, block, whole):
    monkeypatch.setattr(S, "BLOCK_TERMS", block)
    monkeypatch.setattr(S, "PASS_TERMS", whole)
    rnd = random.Random(4)
    own = texts(150, 1)
    docs = list(enumerate(own)) + [(200 + i, t) for i, t in enumerate(ODD)]
    # A text that stands in a third of the rows, repeated rows, rows without an id.
    docs += [(300 + i, own[3]) for i in range(80)] + [(7, own[7]), (7, own[7]), (None, own[3]), (None, own[9])]
    items = [(i, " ".join(rnd.choice(own).split()[:12])) for i in range(30)] + [(30, None), (31, " . "), (5, own[3].upper()), (None, own[7]), (32, "W1 w1 w1 nowhere")]
    if block == 1:
        items = items[:4]
    rnd.shuffle(docs)
    df = clashing(spark.createDataFrame([(i, t, None, None, None) for i, t in docs], DOCS)).repartition(5)
    found = S.search(df, clashing(spark.createDataFrame(items, "item_id long, text string")))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(found) == sorted(plain_search(docs, items), key=str)


def test_search_over_several_slices(spark, monkeypatch):
    docs = list(enumerate(texts(2500, 8, (1, 12), 8)))
    items = list(enumerate(texts(6, 9, (2, 6), 8)))
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    assert rows(S.search(df, spark.createDataFrame(items, "item_id long, text string"), 25)) == sorted(plain_search(docs, items, 25), key=str)


def test_search_of_empty_tables(spark):
    empty, items = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert S.search(empty, items).count() == 0
    assert S.search(spark.createDataFrame([(1, "a b", None, None, None)], DOCS), items.limit(0)).count() == 0
    assert S.search(spark.createDataFrame([(1, None, None, None, None)], DOCS), items).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_shared_sets_give_the_items_back_with_fewer_sums(seed):
    rnd = random.Random(seed)
    leaves = rnd.randint(1, 60)
    common = [rnd.sample(range(leaves), rnd.randint(1, leaves)) for _ in range(4)]
    items = [np.array(sorted({*rnd.choice(common), *rnd.sample(range(leaves), rnd.randint(1, min(4, leaves)))})) for _ in range(rnd.randint(1, 30))]
    children, roots = S.share(items, leaves)

    def held(node):
        return Counter([node]) if node < leaves else sum((held(x) for x in children[node - leaves]), Counter())

    assert all(max(own) < leaves + k for k, own in enumerate(children))
    for own, top in zip(items, roots, strict=True):
        assert sum((held(x) for x in top), Counter()) == Counter(own.tolist())
    sums = sum(len(x) - 1 for x in [*children, *roots])
    assert sums <= sum(len(x) - 1 for x in items)
    if len(items) > 8:
        assert sums < 0.8 * sum(len(x) - 1 for x in items)


# 12


def plain_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    judged = []
    for i, text, part in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs),
        }
        judged.append((part or "", {k for k, v in fails.items() if v}, i is not None and i in good, i is not None and i in toxic))
    out = []
    for part in {x[0] for x in judged}:
        own, shapley, lines = [x for x in judged if x[0] == part], Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                failing = sum(f in x[1] for x in own)
                lines.append((part, "".join(order), step, len(left), len(gone), failing - len(gone), sum(x[1] == {f} for x in own), sum(x[2] for x in gone), sum(x[3] for x in gone), f))
        out += [(*x[:-1], shapley[x[-1]]) for x in lines]
    return out


@pytest.mark.parametrize(("heavy", "most"), [(1000, 1 << 16), (2, 7)])
def test_audit_is_brute_force(spark, monkeypatch, heavy, most):
    monkeypatch.setattr(FA, "HEAVY", heavy)
    monkeypatch.setattr(FA, "GROUPS", 1000)
    monkeypatch.setattr(FA, "RANGE_ROWS", most)
    rnd = random.Random(6)
    own = texts(60, 2, (20, 90), 200)
    own = [t.upper() if rnd.random() < 0.2 else t + " 5%" if rnd.random() < 0.3 else t for t in own]
    docs = [(i, t, rnd.choice(["hot", "hot", "b", "c", None])) for i, t in enumerate(own)] + [(100 + i, t, "odd") for i, t in enumerate(ODD)]
    docs += [(200 + i, own[0], "hot") for i in range(30)] + [(5, own[5], "b"), (5, own[5], "b"), (None, own[6], None), (None, None, "c"), (1, own[7], "only")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in range(0, 130, 2)] + [(5, 1, 0), (5, 0, 1), (None, 1, 1)]
    df = clashing(spark.createDataFrame([(i, t, None, s, None) for i, t, s in docs], DOCS)).repartition(4)
    out = FA.audit(FA.posting_lists(FA.judged(df, clashing(spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))))
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert out.columns == names
    assert rows(out) == sorted(plain_audit(docs, labels), key=str)


def test_posting_lists_are_sorted_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(FA, "RANGE_ROWS", 50)
    docs = spark.createDataFrame([(i, "short" if i % 3 else "long " * 60, None, "hot" if i % 7 else f"s{i}", None) for i in range(700)], DOCS)
    judged = FA.judged(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    lists = FA.posting_lists(judged).collect()
    assert sum(r.n for r in lists) == 700 and max(r.n for r in lists) <= 50
    assert all(list(r[f]) == sorted(set(r[f])) for r in lists for f in FA.LISTS)
    assert sum(len(r.A) for r in lists) == 466 and {len(r.good) for r in lists} == {0}


def test_audit_of_an_empty_table(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert FA.audit(FA.posting_lists(FA.judged(docs, labels))).count() == 0


def test_merges_of_lists():
    rnd = random.Random(1)
    for _ in range(50):
        lists = [np.array(sorted(rnd.sample(range(60), rnd.randint(0, 40))), dtype=np.int64) for _ in range(4)]
        assert FA.merged(lists).tolist() == sorted({x for own in lists for x in own.tolist()})
        assert FA.without(lists[0], lists[1]).tolist() == sorted({*lists[0].tolist()} - {*lists[1].tolist()})
    assert FA.merged([]).tolist() == []


# 13

OPTION = "alpha beta <<beginOptional>>gamma <<beginOptional>>delta<<endOptional>> alpha<<endOptional>> beta beta"
CHOICE = 'gamma <<var;name="x";match="alpha|beta beta">> <<var;name="y";original="z";match=".{1,3}">> delta alpha'
OPEN = '<<var;name="holder">> delta delta <<beginOptional>>alpha<<endOptional>>'


def wording(parts, rnd, words):
    """A random text that a template accepts."""
    out = []
    for p in parts:
        if isinstance(p, str):
            out.append(p)
        elif isinstance(p, L.Optional):
            out += wording(p.parts, rnd, words) if rnd.random() < 0.5 else []
        elif p.choices:
            out += rnd.choice(p.choices)
        else:
            out += [rnd.choice(words) for _ in range(rnd.randint(p.least, min(p.most, 5)))]
    return out


@pytest.mark.parametrize("template", [OPTION, CHOICE, OPEN, f"{OPTION} {CHOICE}", f"<<beginOptional>>{CHOICE}<<endOptional>> gamma gamma"])
def test_automata_accept_what_the_expression_does(spark, template):
    rnd = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta"]
    some = lambda: [rnd.choice(words) for _ in range(rnd.randint(0, 12))]
    docs = []
    for i in range(600):
        own = [*some(), *(wording(L.parse(template), rnd, words) if i % 3 else some()), *some()] or ["alpha"]
        own[rnd.randrange(len(own))] = rnd.choice(words)
        docs.append((i, " ".join(own)))
    pattern = re.compile(" " + L._pattern(L.parse(template)))
    got = L.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string"), {"t": [template]}, {}).collect()
    text = dict(docs)
    for r in got:
        want = pattern.search(f" {text[r.doc_id]} " if text[r.doc_id] else " ") is not None
        assert (r.labels == "t") == want, text[r.doc_id]
        for s in r.spans:
            assert pattern.fullmatch(" " + "".join(f"{w} " for w in text[r.doc_id].split()[s.first : s.after])), (text[r.doc_id], s)
    assert 0 < sum(r.labels == "t" for r in got) < len(got)


MIT = """The MIT License (MIT)
Copyright (c) 2020 Some Person <person@mail.example.com>
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions
of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL SOME PERSON BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def test_license_texts_and_statements(spark):
    cases = [
        (MIT, "MIT,mit"), (f"some prose\n{MIT}\nmore prose", "MIT,mit"), (MIT.replace("NO EVENT SHALL SOME PERSON", "NO EVENT SHALL THE AUTHORS"), "MIT,mit"),
        (MIT.replace("free of charge", "for a small fee"), "mit"), (MIT.replace("furnished", "FURNISHED"), "MIT,mit"),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0,gpl"), ("Released under the MIT License.", "MIT,mit"),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0,cc-by"), ("Licensed under the Apache License, Version 2.0.", "Apache-2.0,apache"),
        ("licensed\nunder the terms of the\n* mit license", "MIT,mit"), ("we like the MIT License", "mit"), ("licenced under the mit licence", ""),
    ]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in L.scan_licenses(docs).collect()}
    for i, (text, want) in enumerate(cases):
        assert got[i].labels == want, text
    assert got[2].score > 0.9 > got[6].score > got[10].score > got[11].score == 0
    assert [(s.label, s.first, s.after) for s in got[5].spans] == [("GPL-3.0", 0, 12)]


def test_places_of_phrases(spark):
    text = "MIT License, apache license mit-license\n" + "x " * 10 + "Mit\x0blicense CC BY cc by"
    docs = clashing(spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate([*ODD, text, text])] + [(None, "mit license", None, None, None)], DOCS))
    got = L.scan_licenses(docs).drop("spans").collect()
    assert len(got) == len(ODD) + 3
    by = {r.doc_id: r for r in got}
    none = by[0]
    assert tuple(none) == (0, 0, 0, None, None, "", "", 0.0)
    assert tuple(by[len(ODD)])[1:] == (22, 6, 0, 20, "apache,cc-by,mit", "apache,cc-by,mit", 0.2)
    assert tuple(by[len(ODD)])[1:] == tuple(by[len(ODD) + 1])[1:]
    assert by[None].base_labels == "mit" and by[7].n_words == 1
    assert L.scan_licenses(docs.limit(0)).count() == 0


@pytest.mark.parametrize("template", ["a <<beginOptional>> b", "a <<endOptional>>", "<<beginOptional>>a<<endOptional>>", 'a <<var;match="b.*c">>', 'a <<var;match="b|">>', ""])
def test_templates_that_are_none(template):
    with pytest.raises(ValueError, match="mandatory|match|<<"):
        L.compiled(template)
