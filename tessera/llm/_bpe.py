"""Byte-level BPE over pre-tokens, shared by the encoder and the packer."""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterator
from itertools import accumulate, chain

import numpy as np
import regex
import tiktoken
from public_tokenizers import PATTERN

#: Code points from one chunk's start to the next one's, and the least that two chunks share.
CHUNK, OVERLAP = 1 << 12, 1 << 8
#: Code points in which a sure boundary is looked for.
REACH = 1 << 16
#: Pre-tokens whose ids a worker keeps.
KEPT = 400_000
#: Where letters or digits end, public_tokenizers.PATTERN has a boundary, wherever it began.
_SURE = regex.compile(r"[\p{L}\p{N}][^\p{L}\p{N}]")
#: A chunk's end can mislead its last match and boundaries within so many code points of it (contractions, white space).
_MARGIN = 3


def cuts(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of overlapping chunks.  What two neighbours share holds a place where letters or digits end, so
    that both find a boundary there; where none is in reach, there is no cut, as one pre-token may go on.  A chunk
    shares no place with the next but one, so that its two seams stand in order."""
    out, start, end, n = [], 0, 0, len(text)
    for at in range(chunk, n - overlap, chunk):
        if at < end:
            continue
        sure = _SURE.search(text, at, min(n, at + max(REACH, overlap)))
        if sure:
            end = max(sure.end() + _MARGIN, at + overlap)
            if end >= n:
                break
            out.append((start, end))
            start = at
    return [*out, (start, n)]


def seam(starts: list[int], following: list[int], end: int) -> int:
    """The first common boundary of a chunk and of the next one, which resynchronise there: a match depends only on
    what follows its start.  end: where the first chunk ends."""
    others = set(following)
    for b in starts:
        if b >= following[0] and b in others and b <= end - _MARGIN:
            return b
    raise ValueError("two chunks never resynchronise")


def starts_of(pieces: list[str], at: int) -> list[int]:
    return list(accumulate(map(len, pieces), initial=at))[:-1]


def pretokens(text: str, find: Callable[[str], list[str]], chunk: int = 1 << 16, overlap: int = OVERLAP) -> Iterator[list[str]]:
    """find(text), in parts, from overlapping chunks that are cut one after the other."""
    edges = cuts(text, chunk, overlap)
    begin, pieces = 0, find(text[slice(*edges[0])])
    for (start, end), (after, until) in zip(edges, edges[1:], strict=False):
        own, following = starts_of(pieces, start), find(text[after:until])
        meet = seam(own, starts_of(following, after), end)
        yield pieces[own.index(begin) : own.index(meet)]
        begin, pieces = meet, following
    last = edges[-1][0]
    yield pieces if begin == last else pieces[starts_of(pieces, last).index(begin) :]


class _Memo(dict):
    """Pre-token -> its ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, encode: Callable[[bytes], list[int]]):
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= KEPT:
            self.clear()
        found = np.array(self.encode(piece.encode()), "<u4").tobytes()
        if len(piece) < 64:
            self[piece] = found
        return found


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id, of a rank file or of a byte-level tokenizer's JSON file."""
    if not path.endswith(".json"):
        with open(path, "rb") as lines:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    # byte-level files write each byte as one visible character: those that are visible in Latin-1 as they are,
    # the others as U+0100 and following, in order
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in visible]
    byte = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(rest)}
    special = {x["content"] for x in given.get("added_tokens", [])}
    return {bytes(byte[c] for c in token): i for token, i in given["model"]["vocab"].items() if token not in special}


class Bpe:
    def __init__(self, path: str):
        ranks = read_ranks(path)
        size = max(ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, i in ranks.items():
            self.tokens[i] = token
        self.digits = [str(i) for i in range(size)]
        #: What holds an id between tasks.
        self.width = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self._find = regex.compile(PATTERN).findall
        encoding = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._ids = _Memo(encoding._core_bpe.encode_single_piece)

    def encode(self, text: str) -> bytes:
        """The ids, as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self._ids.__getitem__, chain.from_iterable(pretokens(text, self._find))))

    def chunk(self, text: str, lead: int, after: int) -> tuple[bytes, int, list[int], list[int]]:
        """A chunk by itself.  lead: code points that the chunk before sees too; after: where the next one starts, or
        -1.  Returns the ids up to the seam with the next, that seam, and the boundaries of the lead with the number
        of ids before each, one of which is the seam with the chunk before."""
        pieces = self._find(text)
        starts = starts_of(pieces, 0)
        meet = len(text) if after < 0 else seam(starts, starts_of(self._find(text[after:]), after), len(text))
        ids = [self._ids[p] for p, s in zip(pieces, starts, strict=True) if s < meet]
        before = [0, *accumulate(len(x) // 4 for x in ids)]
        heads = [k for k, s in enumerate(starts) if s <= lead and k < len(before)]
        return b"".join(ids), meet, [starts[k] for k in heads], [before[k] for k in heads]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_loaded: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    """The encoder of a vocabulary file, once per worker."""
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]
