"""Byte-level BPE ids of Arrow text columns.

Pieces are cut with vector operations by the vocabulary's own rule (contractions, words, numbers and
signs with one leading blank, white space); each distinct piece is encoded once and remembered, so the
cost per text is mostly table look-ups. Texts are cut at the tokenizer file's added tokens first, each of which is one piece. The ids equal those of the tokenizer file (tests hold them together).
"""

from __future__ import annotations

import base64
import json
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken

from atelier.llm import words as W

#: At most so many pieces are remembered by a worker (about 100 MB).
REMEMBERED = 400_000
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_SIGN, _LETTER, _NUMBER, _SPACE = range(4)


@cache
def classes() -> np.ndarray:
    """Class by code point."""
    table = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    shift = lambda i: i if i < 0xD800 else i + 0x800
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            table[shift(m.start()) : shift(m.end() - 1) + 1] = kind
    table[_WHITE] = _SPACE
    return table


@cache
def encoding(path: str) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding(path, pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})


@cache
def added(path: str) -> dict[bytes, int]:
    """Ids of the added tokens of the tokenizer file beside the vocabulary, none of which strips blanks or asks for whole words."""
    tokens = json.load(open(path.removesuffix(".tiktoken") + ".json", encoding="utf-8"))["added_tokens"]
    return {t["content"].encode(): t["id"] for t in tokens}


def markers(text: bytes, offsets: np.ndarray, path: str) -> np.ndarray:
    """Starts and ends, by row, of the added tokens in texts: leftmost first, the longest of those at one place; none reaches into another text."""
    known = sorted(added(path), key=len, reverse=True)
    if not any(t in text for t in known):
        return np.zeros((0, 2), np.int64)
    pattern = re.compile(b"|".join(map(re.escape, known)))
    found = [m.span() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True) for m in pattern.finditer(text, a, b)]
    return np.array(found, np.int64).reshape(-1, 2)


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions of the characters of UTF-8 data, and their code points."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    cp = data[at].astype(np.uint32)
    wide = np.flatnonzero(cp >= 0x80)
    lead, padded = cp[wide], np.concatenate([data, np.zeros(3, np.uint8)])
    b1, b2, b3 = (padded[at[wide] + i].astype(np.uint32) & 0x3F for i in (1, 2, 3))
    two, three = ((lead & 0x1F) << 6) | b1, ((lead & 0x0F) << 12) | (b1 << 6) | b2
    cp[wide] = np.select([lead < 0xE0, lead < 0xF0], [two, three], ((lead & 0x07) << 18) | (b1 << 12) | (b2 << 6) | b3)
    return at, cp


def pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which a piece starts; texts never share one."""
    at, cp = code_points(data)
    n, kind = len(cp), classes()[cp]
    edge = np.zeros(n + 3, bool)  # a text begins here
    edge[np.searchsorted(at, offsets[:-1][offsets[:-1] < len(data)])] = True
    edge[n:] = True
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # the last of some white space before a word stands alone or, if a blank, goes with the word
    last = np.flatnonzero((kind == _SPACE) & ~edge[1 : n + 1] & (np.append(kind[1:], _SPACE) != _SPACE))
    start[last] = True
    start[last[cp[last] == 0x20] + 1] = False
    quote = np.flatnonzero((cp == 0x27) & start)
    quote = quote[~edge[quote + 1]]
    after, then = cp[quote + 1], np.append(cp, [0, 0])[quote + 2]
    then[edge[quote + 2]] = 0
    one = np.isin(after, [ord(c) for c in "stmd"])
    two = ((then == ord("e")) & ((after == ord("r")) | (after == ord("v")))) | ((after == ord("l")) & (then == ord("l")))
    start = np.append(start, [True] * 3)
    for chosen, length in ((one, 2), (two, 3)):
        start[quote[chosen] + 1] = False
        start[quote[chosen] + length] = True
    return at[np.flatnonzero(start[:n])]


_known: dict[str, dict[int, bytes]] = {}


def token_ids(column: pa.Array, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For some rows at a time: first row, end row, ids (uint32) of all, and offsets by row. Null is empty."""
    encode = encoding(path)._core_bpe.encode_single_piece
    known, special = _known.setdefault(path, {}), added(path)
    data, offsets = W.raw(column)
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + W.CHUNK_BYTES, "right")) - 1)
        part, own = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        if not len(part):
            yield lo, hi, np.zeros(0, np.uint32), np.zeros(hi - lo + 1, np.int64)
            lo = hi
            continue
        text = part.tobytes()
        marked = markers(text, own, path)
        starts = pieces(part, np.union1d(own, marked))
        if len(marked):  # nothing starts inside a marker
            at = np.searchsorted(marked[:, 0], starts, "left") - 1
            starts = starts[(at < 0) | (starts >= marked[at, 1])]
        ends = np.append(starts[1:], len(part))
        distinct, where, which = np.unique(W.segment_hash(part, starts, ends), return_index=True, return_inverse=True)
        if len(known) > REMEMBERED:
            known.clear()
        keys = distinct.tolist()
        found = list(map(known.get, keys))
        missing = [i for i, x in enumerate(found) if x is None]
        for i, s, e in zip(missing, starts[where[missing]].tolist(), ends[where[missing]].tolist(), strict=True):
            own_id = special.get(text[s:e])
            found[i] = known[keys[i]] = array("I", encode(text[s:e]) if own_id is None else [own_id]).tobytes()
        sizes = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        heads = np.cumsum(sizes) - sizes
        length = sizes[which]
        till = np.cumsum(length)
        begin = till - length
        ids = np.frombuffer(b"".join(found), "<u4")[np.repeat(heads[which] - begin, length) + np.arange(int(till[-1]))]
        yield lo, hi, ids, np.append(0, till)[np.searchsorted(starts, own)]
        lo = hi
