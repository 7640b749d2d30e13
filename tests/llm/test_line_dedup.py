"""Line dedup against all pairs of lines."""

from collections import Counter

import numpy as np
import pytest
import xxhash

from tideline.llm import line_dedup


def key(text):
    h = xxhash.xxh64_intdigest(text.encode())
    return h - (1 << 64) if h >> 63 else h


def plain(rows, similarity=0.8):
    """(doc_id, text) -> line numbers removed."""
    lines = []
    for i, t in sorted({(i, t) for i, t in rows if i is not None and t is not None}, key=lambda r: (r[0], key(r[1]))):
        for k, line in enumerate(t.encode().lower().split(b"\n")):
            if line.split():
                lines.append(((i, t), k, frozenset(line.split())))
    gone = {}
    for a, (doc, k, words) in enumerate(lines):
        if any(len(words & w) >= similarity * len(words | w) - 1e-9 for _, _, w in lines[:a]):
            gone.setdefault(doc, []).append(k)
    return gone


def check(frame, **how):
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    gone = plain(rows)
    want = Counter()
    for i, t in rows:
        drop = gone.get((i, t), []) if i is not None else []
        want[i, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in drop), 0 if t is None else t.count("\n") + 1, tuple(drop)] += 1
    got = Counter((r["doc_id"], r["text"], r["n_lines"], tuple(r["removed"])) for r in line_dedup.dedup_lines(frame, **how).collect())
    assert got == want
    return gone


def test_awkward_texts(docs, no_docs, null_docs):
    check(docs.select("doc_id", "text", "n_words"))
    check(null_docs)
    assert line_dedup.dedup_lines(no_docs).count() == 0
    kept = line_dedup.with_lines_removed(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()


@pytest.mark.parametrize("most_rows", [20_000, 9])
def test_equals_all_pairs(spark, most_rows):
    rng = np.random.default_rng(11)
    lines = []
    for _ in range(25):
        base = [f"w{x}" for x in np.minimum(rng.zipf(1.3, rng.integers(1, 45)), 600)]
        for _ in range(rng.integers(1, 9)):  # variants around the bound
            own = list(base)
            for _ in range(rng.integers(0, 1 + len(own) // 5)):
                own[rng.integers(len(own))] = f"v{rng.integers(300)}"
            if rng.random() < 0.3:
                own.append(f"w{rng.integers(50)}")
            lines.append(" ".join(rng.permutation(own)))
    lines += ["the of", "of the", "The of and", "", "  "]
    texts = ["\n".join(rng.choice(lines, rng.integers(1, 6))) for _ in range(90)]
    frame = spark.createDataFrame([*enumerate(texts), (None, texts[0]), (3, texts[3]), (3, texts[4])], "doc_id long, text string")
    gone = check(frame, most_rows=most_rows)
    assert sum(map(len, gone.values())) > 100


def test_large_buckets(spark):
    """One group of near copies, in more variants than the small path takes."""
    rng = np.random.default_rng(12)
    base = [f"b{i}" for i in range(30)]
    texts = []
    for _ in range(260):
        own = list(base)
        for _ in range(rng.integers(0, 5)):
            own[rng.integers(30)] = f"x{rng.integers(1000)}"
        texts.append(" ".join(own))
    check(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"))
