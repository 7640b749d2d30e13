"""Decontamination, secrets and shards against plain rules."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tideline.llm import decontaminate, secret_scan, sharding


def test_wu_manber_equals_every_window(spark, docs):
    long = " ".join(f"w{i}" for i in range(30))
    items = spark.createDataFrame(
        [("b", "The quick brown fox jumps over the lazy dog near the old river"), ("a", "quick brown"), ("c", "one"), ("n", None), ("e", " "), (None, "one"), ("l", long), ("a", "quick brown")],
        "item_id string, text string",
    )
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(100, "zz " + long + " w1 w2"), (101, long.replace("w15", "v") + " one")], "doc_id long, text string"))
    for block_bytes in (1 << 20, 400):
        got = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in decontaminate.contamination(more, items, block_bytes=block_bytes).collect())
        want = Counter()
        for r in more.collect():
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r["text"] or "").translate({c: c + 32 for c in range(65, 91)}))
            hit, found = set(), set()
            for item, text in [(x["item_id"], x["text"]) for x in items.collect()]:
                own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
                for w in [own[i : i + 13] for i in range(max(1, len(own) - 12))] if own and item else []:
                    for i in range(len(words) - len(w) + 1):
                        if words[i : i + len(w)] == w:
                            hit.update(range(i, i + len(w)))
                            found.add(item)
            want[r["doc_id"], len(words), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(words)] += 1
        assert got == want


def test_decontaminate_empty_sides(docs, no_docs, spark):
    none = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.contamination(no_docs, none).count() == 0
    assert {r["n_hit"] for r in decontaminate.contamination(docs, none).collect()} == {0}
    kept = decontaminate.without_contaminated(docs, none)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def plain_base(text):
    out = []
    kinds = [("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24)]
    for k, (kind, pattern, group, least) in enumerate(kinds):
        out += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text or "") if len(m.group(group)) >= least]
    return [(kind, s, e) for s, _, e, kind in sorted(out)]


def test_base_secrets_stay(docs):
    extra = ["token=token:abcdefgh", "ſecret=abcdefgh", "toKen : abcdef", "é" * 9 + "secret = 'q1w2e3r4t5'", "f" * 23 + " " + "f" * 24]
    for text in [r["text"] for r in docs.collect()] + extra:
        found = secret_scan.scan(text.encode() if text else None)
        assert [x for x in found if x[0] in secret_scan.BASE_KINDS] == plain_base(text)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ('K = "a8F2kd91Lmx0"\ndb_password = K\n', ["a8F2kd91Lmx0"]),
        ('A = "Zq81mmXa"\nB = "77Gh-yQ2"\nclient_secret = A + B', ["Zq81mmXa", "77Gh-yQ2"]),
        ('{"accessKey": "Ab12Cd34Ef56", "name": "Ab12Cd34Ef57"}', ["Ab12Cd34Ef56"]),
        ("export AUTH_TOKEN=Ab12Cd34Ef56 # note", ["Ab12Cd34Ef56"]),
        ("private-key: q8W3e9R1t7Y", ["q8W3e9R1t7Y"]),
        ('config["pass_word"] = "q8W3e9R1t7Y"', ["q8W3e9R1t7Y"]),
        ('password = "changeme"\ntoken_url = "q8W3e9R1t7Y"\npassphrase = "a few plain words"\n', []),
        ("he said: the token was here, and = signs abound", []),
        ('A = B\nB = A\nsecret = B + A + "Kx02mmQ918z"', ["Kx02mmQ918z"]),
    ],
)
def test_literals_follow_constants(text, want):
    assert [text.encode()[s:e].decode() for s, e in secret_scan.literals(text.encode())] == want


def test_scan_and_redact(docs, no_docs):
    assert secret_scan.scan_secrets(docs).count() == docs.count() and secret_scan.scan_secrets(no_docs).count() == 0
    clean = secret_scan.redact(docs)
    assert clean.columns == docs.columns
    assert not clean.where(F.col("text").contains("hunter22") | F.col("text").contains("AKIAABCDEF")).count()


def jump_plainly(key, n):
    b, j = -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_shards(spark, docs, no_docs, null_docs):
    for frame in (docs, null_docs, spark.range(5000).selectExpr("id * 7919 - 100 AS doc_id", "string(id % 10) AS text")):
        for block in (200_000, 1):
            got = sharding.shard(frame, 7, rows_a_block=block).collect()
            want = Counter()
            for r in frame.collect():
                text = (r["text"] or "").encode()
                key = (r["doc_id"] or 0) % (1 << 64)
                want[r["doc_id"], len(text) + 16, zlib.crc32(text), "key", jump_plainly(key, 7), jump_plainly(key, 8)] += 1
            assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in got) == want
            for s in {r["shard"] for r in got}:
                assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
            assert all(r["grown_shard"] in (r["shard"], 7) for r in got)
    assert sharding.shard(no_docs, 7).count() == 0
    assert hashlib.sha256(b"").hexdigest()  # text keys
    assert sharding.shard(docs, 5, key_col="source").select("shard").distinct().count() <= 2
