"""Subword ids of whole texts by a public byte-level vocabulary, worked out once for each different chunk.

The vocabulary file (its path is a parameter) is one for ``tokenizers``; the ids are that library's. Its
pre-tokens never cross from a word into the white space after it, so a text may be cut before each run of
spaces and line feeds and the ids of the chunks put together. Chunks repeat, so most are looked up.
Texts with other white space, where a cut might fall inside a run, or with a special token's string, go to ``tokenizers`` whole.
New chunks are encoded many at a time by the same ranks; lengths in bytes tell their ids apart.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import tiktoken
import xxhash
from tokenizers import Tokenizer

from tideline.llm.common import Vocabulary

_EDGE = b" \n.,;:!?\"'()[]{}"
_CHUNK = re.compile(rb"[ \n]*[^ \n]+")
# White space other than the space and the line feed, as UTF-8.
_ODD = re.compile(rb"[\t\r\v\f\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_ODD_ASCII = b"\t\r\v\f\x1c\x1d\x1e\x1f"
_ODD_STARTS = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte as itself and the others as the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def load(path: str) -> Encoder:
    return Encoder(path)


class Encoder:
    """The vocabulary in one process."""

    def __init__(self, path: str):
        import public_tokenizers

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token.encode() not in self.special}
        self.ranks = tiktoken.Encoding("chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = self.whole.get_vocab_size()
        self.widths = np.zeros(self.size, np.int64)
        for token, i in ranks.items():
            self.widths[i] = len(token)
        bare = [(token.strip(_EDGE).lower(), i) for token, i in ranks.items()]
        self.bare = np.zeros(self.size, np.uint64)  # a hash of each id's letters, 0 if it has none
        for token, i in bare:
            self.bare[i] = xxhash.xxh64_intdigest(token) if token else 0

    def is_plain(self, text: bytes) -> bool:
        if any(s in text for s in self.special) or len(text.translate(None, _ODD_ASCII)) < len(text):
            return False
        return not any(x in text for x in _ODD_STARTS) or not _ODD.search(text)

    def chunks(self, text: bytes) -> list[bytes]:
        found = _CHUNK.findall(text)
        end = len(text.rstrip(b" \n"))
        return [*found, text[end:]] if end < len(text) else found

    def encode(self, text: bytes) -> np.ndarray:
        return np.array(self.whole.encode(text.decode(errors="replace"), add_special_tokens=False).ids, np.uint32)

    def encode_flat(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks one after the other, and how many each has.

        Chunks that start a word after white space are encoded as one text, and told apart by the bytes their ids stand for.
        """
        lengths, parts = np.zeros(len(chunks), np.int64), []
        odd = re.compile(_ODD.pattern + b"".join(b"|" + re.escape(x) for x in self.special)).search
        for i in range(0, len(chunks), 50_000):
            block = chunks[i : i + 50_000]
            joined = np.array([c[:1] in b" \n" and c[-1:] not in b" \n" for c in block], bool)
            if not self.is_plain(b"".join(block)):
                joined &= np.array([not odd(c) for c in block], bool)
            together = [c for c, ok in zip(block, joined, strict=True) if ok]
            ids = np.array(self.ranks.encode_ordinary(b"".join(together).decode(errors="replace")), np.uint32)
            ends = np.searchsorted(np.cumsum(self.widths[ids]), np.cumsum(np.fromiter(map(len, together), np.int64, len(together)))) + 1
            alone = {k: np.array(self.ranks.encode_ordinary(block[k].decode(errors="replace")), np.uint32) for k in np.flatnonzero(~joined)}
            own = np.zeros(len(block), np.int64)
            own[joined] = np.diff(ends, prepend=0)
            for k, x in alone.items():
                own[k] = len(x)
            begin = np.cumsum(own) - own
            out = np.zeros(int(own.sum()), np.uint32)
            taken = own[joined]
            out[np.repeat(begin[joined] - np.cumsum(taken) + taken, taken) + np.arange(len(ids))] = ids
            for k, x in alone.items():
                out[begin[k] : begin[k] + len(x)] = x
            lengths[i : i + len(block)] = own
            parts.append(out)
        return np.concatenate([*parts, np.zeros(0, np.uint32)]), lengths

    def encode_chunks(self, chunks: list[bytes]) -> list[np.ndarray]:
        """Ids of each chunk."""
        flat, lengths = self.encode_flat(chunks)
        return np.split(flat, np.cumsum(lengths)[:-1]) if len(chunks) else []


class Chunks:
    """Chunks met by a task, with their ids one after the other in ``flat``."""

    def __init__(self, encoder: Encoder, most: int = 300_000):
        self.encoder, self.known = encoder, Vocabulary(most)
        self._empty()

    def _empty(self) -> None:
        self.starts, self.lengths, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.terms = np.zeros(0, np.int64)

    def trim(self) -> None:
        self.known.trim()
        if len(self.known.words) < len(self.starts):
            self._empty()

    def learn(self) -> None:
        """Encode what has been numbered since the last call."""
        new = self.known.words[len(self.starts) :]
        if new:
            ids, lengths = self.encoder.encode_flat(new)
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, ids])

    def term_numbers(self) -> np.ndarray:
        """A number for each chunk by the letters of its ids, in any case and without edge signs: chunks that differ in these alone are one term."""
        have = len(self.terms)
        if have < len(self.starts):
            begin = self.starts[have:]
            each = self.encoder.bare[self.flat[begin[0] :]]
            sums = np.concatenate([[np.uint64(0)], np.cumsum(each * np.uint64(0x9E3779B97F4A7C15) ^ (each >> np.uint64(31)))])
            ends = begin - begin[0] + self.lengths[have:]
            self.terms = np.concatenate([self.terms, ((sums[ends] - sums[begin - begin[0]]) >> np.uint64(1)).astype(np.int64)])
        return self.terms

    def gather(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of the numbered chunks, in order."""
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        if not len(ends):
            return np.zeros(0, np.uint32)
        return self.flat[np.repeat(self.starts[numbers] - ends + lengths, lengths) + np.arange(ends[-1])]

    def encode_all(self, texts: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(ids, chunk numbers) of each text; texts that are encoded whole have chunk numbers too."""
        self.trim()
        numbers = [self.known.ids(self.encoder.chunks(t)) for t in texts]
        plain = [self.encoder.is_plain(t) for t in texts]
        self.learn()
        return [self.gather(n) if ok else self.encoder.encode(t) for t, n, ok in zip(texts, numbers, plain, strict=True)], numbers
