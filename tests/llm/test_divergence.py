"""Source divergence audit against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tideline.llm import divergence


def plain(rows, least, top=50):
    """(text, lang, source) rows -> the audit, by dictionaries and Python's whole numbers."""
    holds, own, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in ((t or "", x or "", s or "") for t, x, s in rows):
        words = [m.decode().translate({c: c + 32 for c in range(65, 91)}) for m in re.findall(rb"[A-Za-z\x80-\xff]+", text.encode())]
        holds[lang].update(set(words))
        own[lang, source].update(words)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [w for w, n in holds[lang].items() if n >= least]
        whole = Counter()
        for s in sources:
            whole.update({w: own[lang, s][w] for w in kept})

        def share(counts, kept=kept):
            under = sum(counts[w] for w in kept) + 5 * len(kept)
            return {w: 1 + 10**9 * (counts[w] + 5) // under for w in kept}

        p, q = {s: share(own[lang, s]) for s in sources}, share(whole)
        for s in sources:
            pairs = [(o, sum(abs(p[s][w] - p[o][w]) for w in kept)) for o in sources if o != s]
            terms = [(w, p[s][w] - q[w]) for w in kept if own[lang, s][w] and p[s][w] > q[w]]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(ranked, 1) if part == "pair" or k <= top]
    return sorted(out)


def audit(frame, **how):
    return sorted(map(tuple, divergence.divergence(frame, **how).collect()))


@pytest.mark.parametrize("size", [0, 1, 2, 500])
def test_pointers_are_sorted_like_words(size):
    rng = random.Random(size)
    texts = ["".join(rng.choice("abAé1 -z") for _ in range(rng.randint(0, 200))).encode() for _ in range(size)]
    texts += [b"", b"abcdefgh abcdefghi abcdefghabcdefgh abcdefgh", "éé É".encode()] if size else []
    bounds = np.cumsum([0, *map(len, texts)])
    low = np.concatenate([divergence._LOWER[np.frombuffer(b"".join(texts), np.uint8)], np.zeros(8, np.uint8)])
    starts, lengths = divergence.word_pointers(low[:-8], bounds)
    words = [low[s : s + n].tobytes() for s, n in zip(starts, lengths, strict=True)]
    assert words == [w for t in texts for w in re.findall(rb"[a-z\x80-\xff]+", t.lower())]
    order, runs = divergence.sorted_runs(low, starts, lengths)
    assert order.tolist() == sorted(range(len(words)), key=lambda i: (words[i], i))
    assert runs.tolist() == [k for k, i in enumerate(order) if k == 0 or words[i] != words[order[k - 1]]]


def test_shares_are_exact_beyond_64_bits():
    counts, under = [0, 7, 10**12, 10**13], [10**13 + 5, 3 * 10**12, 10**15, 10**13 + 15]
    assert divergence.shares(np.array(counts), np.array(under)).tolist() == [1 + 10**9 * (c + 5) // u for c, u in zip(counts, under, strict=True)]


@pytest.mark.parametrize("how", [{}, {"shard_bytes": 300, "cells": 12}])
def test_audit_equals_plain_counts(spark, how):
    rng = random.Random(5)
    words = ["the", "The", "of", "éa", "x1y", "longerthaneight", "longerthaneightandmore", "rare", "ünï", "q"]
    rows = []
    for i in range(400):
        lang = rng.choice(["a", "b", None, ""])
        source = "hot" if i % 3 == 0 else rng.choice(["s1", "s2", None, "é", "z"])
        rows.append((" ".join(rng.choices(words, k=rng.randint(0, 30))) if i % 11 else rng.choice([None, "", "123 !"]), lang, source, i))
    rows += [("the of the", "a", "hot", 1)] * 150 + [("word " * 20_000 + "the", "b", "z", 2)]
    rows += [(None, "c", "only", 3), ("", "c", "other", 3), ("the", "d", "alone", 4)]
    frame = spark.createDataFrame([(*r[:3], 1.5, r[3], "x") for r in rows], "text string, lang string, source string, value double, rank long, term string").repartition(7)
    want = plain([r[:3] for r in rows], 30)
    assert audit(frame, **how) == want
    assert ("c", "only", "pair", "other", 0, 1) in want and {r[0] for r in want} >= {"a", "b", "", "c"}


def test_only_the_top_terms(spark):
    rows = [(" ".join(f"w{'abcdefghij'[k]}" for k in range(10) for _ in range(k + i % 2)), "a", f"s{i % 2}") for i in range(20)]
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    assert audit(frame, least_docs=3, top=2) == plain(rows, 3, 2)


def test_odd_tables(spark, docs, no_docs, null_docs):
    assert audit(no_docs) == []
    assert audit(null_docs) == []
    rows = [(r["text"], r["lang"], r["source"]) for r in docs.collect()]
    assert audit(docs, least_docs=2) == plain(rows, 2)
