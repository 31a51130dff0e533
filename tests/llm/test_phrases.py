"""Operator 12."""

import random
import re
from collections import Counter

import pytest

from orderflow.llm import phrases, queries
from orderflow.plans.compare import compare

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for d in range(1, 5):
                for i in range(len(w) - d + 1):
                    f[lang, tuple(w[i:i + d])] += 1
    found = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    most = Counter()
    for (lang, p), a in found.items():
        for d in range(2, len(p)):
            for i in range(len(p) - d + 1):
                most[lang, p[i:i + d]] = max(most[lang, p[i:i + d]], a)
    out = {}
    for (lang, p), a in found.items():
        if 100 * most[lang, p] >= 80 * a:
            continue
        cuts = [(2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s)
                  for lang, rs in out.items() for i, (s, a, p, l, r) in enumerate(sorted(rs)[:top]))


def corpus():
    rng = random.Random(3)
    words = ["New", "york", "CITY", "Été", "a b", "the", "of", "\U0001f600", "x-y", "q"]
    out = []
    for k in range(160):
        t = "".join(rng.choices(words, [9, 9, 8, 3, 2, 30, 20, 1, 2, 2])[0]
                    + rng.choices([" ", "\t ", ". ", "\n", ", "], [20, 2, 1, 1, 1])[0] for _ in range(rng.randint(0, 120)))
        out.append((t, rng.choice(["en", "en", "en", "fr", None, "und"])))
    return out + [(None, "en"), ("", None), (" \t.\n", "fr"), ("the the the " * 400, "en"), ("one", "de")] + [out[0]] * 5


@pytest.fixture(scope="module")
def mined(spark):
    return spark.createDataFrame([(*r, 1, "x") for r in corpus()],
                                 "text string, lang string, i1 int, phrase string").repartition(5)


def rows_of(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize("light,group,flush,top", [(phrases.LIGHT, phrases.GROUP, phrases.FLUSH, 2000),
                                                   (40, 160, 700, 15), (5, 20, 50, 3)])
def test_equals_brute_force(mined, light, group, flush, top):
    """Also with prefixes that must be lengthened to all depths, and many small groups."""
    got = rows_of(phrases.collocations(mined, least=6, top=top, light=light, group=group, flush=flush))
    assert got == brute(corpus(), 6, top)


def test_limit_rises_where_too_many_prefixes_are_heavy(mined, monkeypatch):
    monkeypatch.setattr(phrases, "HEAVY_ROWS", 3)
    assert rows_of(phrases.collocations(mined, least=6, light=5, group=60)) == brute(corpus(), 6, 2000)


def test_equal_digests_are_counted_again(mined, monkeypatch):
    """The first vocabulary claims one digest for two words."""
    written, seeds, digests = phrases.written, [], phrases._vocabulary

    def clashing(df, what):
        out = written(df, what)
        return out.withColumn("id", phrases.F.lit(1).cast("long")) if what == "vocabulary" and seeds == [0] else out

    monkeypatch.setattr(phrases, "_vocabulary", lambda seed, flush: (seeds.append(seed), digests(seed, flush))[1])
    monkeypatch.setattr(phrases, "written", clashing)
    assert rows_of(phrases.collocations(mined, least=6)) == brute(corpus(), 6, 2000)
    assert seeds == [0, 1]


def test_awkward_and_empty(awkward, nothing):
    assert phrases.collocations(nothing).count() == 0
    rows = [(r.text, r.lang) for r in awkward.collect()]
    assert rows_of(phrases.collocations(awkward, least=3)) == brute(rows, 3, 2000)


def test_equals_sql(spark, sf_dir, con):
    r = compare(queries.QUERIES["op12_phrase_collocations"](spark, sf_dir), con, phrases.ORACLE)
    assert r["columns_match"] and r["values_match"], r
