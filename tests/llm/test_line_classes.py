"""Copies of a line are one row in the buckets of line dedup."""

import numpy as np
import pyarrow as pa

from tideline.llm import line_dedup
from tests.llm.test_line_dedup import check


def test_copies_do_not_fill_buckets(spark, monkeypatch):
    common = [f"w{i}" for i in range(12)]
    variants = [" ".join([*common[:k], f"x{k}", *common[k + 1 :]]) for k in range(12)]
    texts = [" ".join(common)] * 60 + variants
    frame = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    seen = []

    def counted(rows, keys, member, most, sizes):
        cut = split(rows, keys, member, most, sizes)
        seen.append((rows.count(), cut.groupBy(*keys, "c", "d", *member).count().agg({"count": "max"}).first()[0], max((r["bucket_n"] for r in sizes.collect()), default=0)))
        return cut

    split = line_dedup.split_hot
    monkeypatch.setattr(line_dedup, "split_hot", counted)
    check(frame, most_rows=9)
    rows, together, largest = seen[0]
    assert together == 1 and largest <= 13
    assert rows == 13 * line_dedup.prefix_length(12, 0.8)


def test_shared_words_of_many_sets_at_once():
    """Pairs are compared together, over all buckets of a batch; ``shared`` goes through blocks of 4096 pairs."""
    rng = np.random.default_rng(6)
    words = [np.sort(rng.choice(np.arange(1, 60, dtype=np.uint64) << np.uint64(50), rng.integers(1, 40), replace=False)) for _ in range(110)]
    sets = line_dedup.Sets(pa.array([b"skipped!", *(w.tobytes() for w in words)], pa.binary()).slice(1))
    a, b = (x.ravel() for x in np.meshgrid(np.arange(110), np.arange(110)))
    want = np.array([len(set(words[i].tolist()) & set(words[j].tolist())) for i, j in zip(a, b, strict=True)])
    assert len(a) > 2 * 4096 and sets.shared(a, b).tolist() == want.tolist()
    classes = np.arange(110) // 2
    close = sets.match(a, b, classes, 0.5)
    union = np.array([len(words[i]) + len(words[j]) for i, j in zip(a, b, strict=True)]) - want
    assert close.any() and close.tolist() == ((want >= 0.5 * union) & (classes[a] != classes[b])).tolist()


def test_each_bucket_is_verified_apart():
    """The first row of a bucket has no earlier match, also in the midst of a batch; large and small buckets give the same."""
    rng = np.random.default_rng(8)
    rows = []
    for bucket in range(30):
        base = rng.integers(1, 1 << 62, 20, dtype=np.uint64)
        for _ in range(60 if bucket == 7 else rng.integers(1, 6)):
            own = base.copy()
            own[: rng.integers(0, 4)] += np.uint64(rng.integers(1, 9))
            rows.append((bucket, 0, 0, len(rows), np.unique(own).tobytes()))
    kinds = [pa.int64()] * 4 + [pa.binary()]
    table = pa.table([pa.array(v, k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "c", "d", "class", "words"])
    sets = [set(np.frombuffer(r[4], np.uint64).tolist()) for r in rows]
    want = [i for i, r in enumerate(rows) if any(rows[j][0] == r[0] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in range(i))]
    for size, most in ((7, 48), (1000, 48), (1000, 1), (1000, 100)):
        got = [v for b in line_dedup._verify(0.8, most_small=most, block=16)(iter(table.to_batches(size))) for v in b.column(0).to_pylist()]
        assert sorted(got) == want and 30 < len(want) < len(rows) - 30


def test_runs_are_sorted_in_place():
    values = np.array([5, 3, 9, 1, 7, 7, 2, 8, 6], np.uint64)
    line_dedup.sorted_runs(values, np.array([3, 0, 1, 3, 2]))
    assert values.tolist() == [3, 5, 9, 1, 2, 7, 7, 6, 8]
    line_dedup.sorted_runs(values[:0], np.zeros(0, np.int64))
