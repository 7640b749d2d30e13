"""Secret scans: plain patterns, and literals assigned to names that sound secret.

Plain kinds are regular expressions, matched leftmost and without overlap within a kind:

- ``assign``: a secret-sounding word, an optional quote, ``=`` or ``:``, and a value of six characters or more;
- ``access``: access key ids of twenty characters or more;
- ``hex``: runs of twenty-four or more lower-case hexadecimal digits.

Kind ``literal`` comes from assignment-aware lexing. Lines with an assignment sign are cut into names, string
literals, bare values and signs, as source code and configuration files write them (``name = "x"``, ``"name": "x"``,
``export NAME=x``, ``settings["name"] = x``, ``name := a + b``). Each assignment binds its name to the
literals on its right; a name on the right stands for what it was bound to, so constants propagate through
the document, also through concatenations. A literal is reported once when weight of the name times strength of the literal
reaches ``least_score``. Strength looks at length, kinds of characters and entropy; placeholders have none.

Offsets count code points, the end is exclusive. Null and empty texts have no spans. Rows are judged one by one.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import as_bytes, fresh, pick, with_columns

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "literal")

_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(rb"[0-9a-f]{24,}")

_TOKENS = re.compile(
    rb"""(?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)"""
    rb"""|(?P<assign>:=|=>|\+=|=(?![=~])|:(?![:/]))"""
    rb"""|(?P<join>\+|\.\.|\bor\b)"""
    rb"""|(?P<end>\n|;|,|\x23[^\n]*|//[^\n]*)"""
    rb"""|(?P<open>[\[({])|(?P<close>[\])}])"""
    rb"""|(?P<bare>[A-Za-z0-9_\x80-\xff$@%~*!?^&|<>/.\-]+)"""
)
_NAME = re.compile(rb"[A-Za-z_$@][A-Za-z0-9_.$\-]*\Z")
_PARTS = re.compile(rb"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

# How strongly a part of a name says that its value is secret, and parts that say it is not.
_WEIGHT = {
    b"password": 1.0, b"passwd": 1.0, b"pwd": 1.0, b"passphrase": 1.0, b"secret": 1.0, b"credential": 1.0, b"credentials": 1.0,
    b"apikey": 1.0, b"token": 0.9, b"bearer": 0.9, b"auth": 0.8, b"signature": 0.6, b"salt": 0.6, b"session": 0.6, b"pin": 0.6,
}
_WEIGHT_OF_PAIRS = {(b"api", b"key"): 1.0, (b"access", b"key"): 1.0, (b"private", b"key"): 1.0, (b"encryption", b"key"): 1.0, (b"signing", b"key"): 1.0, (b"pass", b"word"): 1.0}
_HARMLESS = frozenset(b"id name count length len url uri path file type hint field label max min limit ttl expires policy public title form".split())
_PLACEHOLDER = re.compile(rb"(?i)(change.?me|example|placeholder|your|dummy|sample|xxx|\*\*\*|<.*>|\$\{.*\}|%\(|none\Z|null\Z|true\Z|false\Z|undefined\Z)")


def name_weight(name: bytes) -> float:
    parts = [p.lower() for p in _PARTS.findall(name)]
    if not parts or parts[-1] in _HARMLESS:
        return 0.0
    return max([0.0, *(_WEIGHT.get(p, 0.0) for p in parts), *(_WEIGHT_OF_PAIRS.get(p, 0.0) for p in zip(parts, parts[1:], strict=False))])


def literal_strength(value: bytes) -> float:
    """From 0 (a word, a placeholder, prose) to 1 (long, mixed, without pattern)."""
    if len(value) < 6 or re.search(rb"\s", value) or _PLACEHOLDER.search(value):
        return 0.0
    counts = Counter(value)
    entropy = -sum(c / len(value) * math.log2(c / len(value)) for c in counts.values())
    kinds = sum(bool(re.search(k, value)) for k in (rb"[a-z]", rb"[A-Z]", rb"[0-9]", rb"[^A-Za-z0-9]"))
    return min(1.0, len(value) / 12) * min(1.0, entropy / 3.0) * (1.0 if kinds > 1 else 0.55)


class _Bound:
    """What a name stands for: spans of literals of its own, and other bindings."""

    __slots__ = ("spans", "parts", "told")

    def __init__(self) -> None:
        self.spans: list[tuple[int, int]] = []
        self.parts: list[_Bound] = []
        self.told = 0.0  # the greatest weight it was reported with


def _report(bound: _Bound, weight: float, text: bytes, least: float, out: set[tuple[int, int]]) -> None:
    todo = [bound]
    while todo:
        b = todo.pop()
        if b.told >= weight:
            continue
        b.told = weight
        out.update((s, e) for s, e in b.spans if weight * literal_strength(text[s:e]) >= least)
        todo.extend(b.parts)


def literals(text: bytes, least: float = 0.5) -> list[tuple[int, int]]:
    """Byte spans of literals that reach a sensitive name."""
    known: dict[bytes, _Bound] = {}
    out: set[tuple[int, int]] = set()
    for line in re.finditer(rb"[^\n]*[=:][^\n]*", text):
        _read_line(text, line.start(), line.end(), known, least, out)
    return sorted(out)


def _read_line(text: bytes, start: int, stop: int, known: dict[bytes, _Bound], least: float, out: set[tuple[int, int]]) -> None:
    target: bytes | None = None  # the name whose value is being read
    last: bytes | None = None  # the last name or key seen on the left
    bound: _Bound | None = None
    wants = False

    def close() -> None:
        nonlocal target, bound, wants
        if target is not None and bound is not None and (bound.spans or bound.parts):
            weight = name_weight(target)
            if weight:
                _report(bound, weight, text, least, out)
            known[target] = bound
        target, bound, wants = None, None, False

    for token in _TOKENS.finditer(text, start, stop):
        kind, s, e = token.lastgroup, token.start(), token.end()
        if kind == "assign":
            if last is not None:
                close()
                target, bound, wants, last = last, _Bound(), True, None
        elif kind == "end":
            close()
            last = None
        elif kind == "string":
            if wants and bound is not None:
                bound.spans.append((s + 1, e - 1))
                wants = False
            last = text[s + 1 : e - 1]
        elif kind == "join":
            wants = target is not None
        elif kind == "bare":
            value = text[s:e]
            if wants and bound is not None:
                if value in known:
                    bound.parts.append(known[value])
                else:
                    bound.spans.append((s, e))
                wants = False
            elif target is not None:
                close()  # a second value: what follows is something else
            if _NAME.match(value):
                last = value
    close()


def _code_points(text: bytes, at: list[int]) -> list[int]:
    if text.isascii():
        return at
    inside = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) == 0x80)
    return [p - int(inside[p - 1]) if p else 0 for p in at]


def scan(text: bytes | None, least: float = 0.5) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind in the order of ``KINDS``; offsets in code points."""
    if not text:
        return []
    found: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(low) if m.end(2) - m.start(2) >= 6]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    if b"=" in text or b":" in text:
        found += [(s, 3, e) for s, e in literals(text, least)]
    found.sort()
    at = _code_points(text, [x for s, _, e in found for x in (s, e)])
    return [(KINDS[k], at[2 * i], at[2 * i + 1]) for i, (_, k, _) in enumerate(found)]


_SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
)


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_score: float = 0.5) -> DataFrame:
    """One row for each document: doc_id and ``spans``, an array of kind, start and end."""

    def start():
        def work(texts: pa.Array):
            return [[[{"kind": k, "start": s, "end": e} for k, s, e in scan(t, least_score)] for t in as_bytes(texts)]]

        return work

    return with_columns(pick(docs, id_col, text_col), ["text"], start, T.StructType([T.StructField("spans", _SPANS)])).drop("text")


def redact(docs: DataFrame, *, text_col: str = "text", mask: str = "[removed]", least_score: float = 0.5) -> DataFrame:
    """``docs`` with each found span replaced by ``mask``; overlapping spans are replaced together."""
    names = docs.columns

    def clean(text: bytes | None) -> str | None:
        if text is None:
            return None
        whole, out, done = text.decode(errors="replace"), [], 0
        for _, s, e in sorted(scan(text, least_score), key=lambda x: x[1:]):
            if s >= done:
                out += [whole[done:s], mask]
            done = max(done, e)
        return "".join([*out, whole[done:]])

    def start():
        return lambda texts: [[clean(t) for t in as_bytes(texts)]]

    out = fresh(docs, "redacted")
    made = with_columns(docs.withColumn(text_col, F.col(text_col).cast("string")), [text_col], start, T.StructType([T.StructField(out, T.StringType())]))
    return made.select(*[F.col(out).alias(c) if c == text_col else F.col(c) for c in names])
