"""SimHash classes against all pairs."""

import numpy as np
import pytest
import xxhash

from tideline.llm import simhash
from tideline.llm.components import components


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, radius=3):
    """doc index -> least doc index of its component."""
    n = len(prints)
    root = list(range(n))
    for i in range(n):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = root[i], root[j]
                if a != b:
                    lo, hi = min(a, b), max(a, b)
                    root = [lo if r == hi else r for r in root]
    return root


def test_documents(docs, no_docs, null_docs):
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    prints = [plain_print(t) for _, t in rows]
    want = {(rows[i][0], f"{prints[i]:016x}", rows[r][0]) for i, r in enumerate(plain_classes(prints))}
    assert got == want
    assert simhash.near_duplicates(no_docs).count() == 0
    assert [tuple(r) for r in simhash.near_duplicates(null_docs).collect()] == [(1, "0" * 16, 1)]


@pytest.mark.parametrize("most_rows", [50_000, 7])
def test_chains_and_groups(spark, most_rows):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 64, 40, dtype=np.uint64)
    prints = [int(b) for b in base]
    for b in base[:12]:
        at = int(b)
        for _ in range(15):  # a chain drifts away step by step
            for bit in rng.choice(64, rng.integers(1, 5), replace=False):
                at ^= 1 << int(bit)
            prints.append(at)
    prints = list(dict.fromkeys(prints))
    frame = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)], "doc_id long, bits long")
    got = {r["doc_id"]: r["component_id"] for r in simhash.classes(frame, most_rows=most_rows).collect()}
    assert [got[i] for i in range(len(prints))] == plain_classes(prints)


def test_thresholds_are_complete():
    rng = np.random.default_rng(5)
    bits = rng.integers(-(1 << 63), (1 << 63) - 1, 300)
    parts = simhash.arrange(300, np.ones((64, 64)), 3)
    assert sorted(b for p in parts for b in p) == list(range(64))
    near = simhash.near_shares(np.ones((9, 256)), 3)
    how = simhash.Plan(300, parts, {(i, g): near[0] for i, p in enumerate(parts) for g in range(0, len(p), 8)}, 3)
    chosen = how.thresholds(bits)
    assert (chosen.min() >= -1) and ((chosen + 1).sum(1) == 4).all()


def test_one_per_class_stays(docs):
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert 17 not in ids and 5 in ids


def test_texts_that_share_an_id_are_judged_apart(spark):
    a, b, c = ("the quick brown fox jumps over the lazy dog " * 3, "a wholly other text about rivers and their mouths " * 3, "some third thing without any partner at all " * 3)
    rows = [(3, a, 1), (5, a, 2), (5, b, 3), (7, c, 4), (7, c, 4), (None, a, 5), (None, a, 5)]
    kept = simhash.without_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, __row int"))
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == sorted([(0, a), (0, a), (3, a), (5, b), (7, c)])
    assert kept.columns == ["doc_id", "text", "__row"]


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root[x] for x in touched}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
