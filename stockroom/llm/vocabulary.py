"""Token ids of whole batches of texts with a public word-level BPE vocabulary.

Texts are cut where the tokenizer's own splitting always cuts: at white space, and inside plain
words at the edges of letter runs, digits and marks. Each distinct unit is encoded once per task and
the ids are gathered by numpy. Plain units go straight to the vocabulary's merge model; a word with
anything unusual in it (an apostrophe, characters from U+0080 to U+00BF or past U+024F, ``<|``) is one
unit and goes through the complete tokenizer, so the ids are those of encoding the text in one call.
"""

from __future__ import annotations

from array import array

import numpy as np

from .tokens import SPACE, span_hashes


def byte_map() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 bytes are
    themselves, the others follow U+00FF in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


STAND_IN = byte_map()


def byte_classes() -> np.ndarray:
    """0 white space, 1 letters (ASCII, and all bytes past it), 2 digits, 3 marks."""
    c = np.full(256, 3, np.uint8)
    c[SPACE] = 0
    c[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
    c[48:58] = 2
    return c


CLASS = byte_classes()
#: Units remembered at most (about 150 bytes each); past it a task starts to learn anew.
MOST = 500_000


def strange_bytes() -> tuple[np.ndarray, np.ndarray]:
    """1: makes a word unusual by itself; 2: together with some next bytes (multiplication and
    division sign, capital I with a dot, the opening of a special string)."""
    one, pair = np.zeros(256, np.uint8), np.zeros((256, 256), bool)
    one[[0x27, 0xC2, 127, *(b for b in range(32) if not SPACE[b]), *range(0xCA, 256)]] = 1
    for b, follow in ((0xC3, (0x97, 0xB7)), (0xC4, (0xB0,)), (0x3C, (0x7C,))):
        one[b] = 2
        pair[b, list(follow)] = True
    return one, pair


STRANGE, STRANGE_PAIR = strange_bytes()
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


class Encoder:
    """Ids of texts by the vocabulary file at ``path``; remembers the units it has seen."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.known: dict[int, bytes] = {}  # the ids of a unit, four bytes each

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        buf, spans, odd, first = units(texts)
        starts, ends = spans
        if not len(starts):
            return [np.zeros(0, np.uint32) for _ in texts]
        h = span_hashes(buf, starts, ends) ^ odd.astype(np.uint64)
        import pandas as pd
        code, distinct = pd.factorize(h)
        where = np.empty(len(distinct), np.int64)
        where[code[::-1]] = np.arange(len(h))[::-1]
        ids = self.learned(buf, starts[where], ends[where], odd[where], distinct.tolist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.uint32)
        at = np.concatenate(([0], np.cumsum(size)))[:-1]
        n = size[code]
        end = np.concatenate(([0], np.cumsum(n)))
        out = flat[np.repeat(at[code] - end[:-1], n) + np.arange(end[-1])]
        cut = end[first]
        return [out[cut[i]:cut[i + 1]] for i in range(len(texts))]

    def learned(self, buf, starts, ends, odd, keys) -> list[bytes]:
        raw, known, model = buf.tobytes(), self.known, self.model
        if len(known) > MOST:
            known.clear()
        for k, s, e, o in zip(keys, starts.tolist(), ends.tolist(), odd.tolist()):
            if k not in known:
                unit = raw[s:e]
                if o:
                    ids = self.whole.encode(unit.decode("utf-8", "replace"), add_special_tokens=False).ids
                elif unit.isascii():
                    ids = [t.id for t in model.tokenize(unit.decode())]
                else:
                    unit = unit.decode().lower().encode()
                    ids = [t.id for t in model.tokenize(unit.decode("latin-1").translate(STAND_IN))]
                known[k] = array("I", ids).tobytes()
        return [known[k] for k in keys]


def units(texts: list[bytes]):
    """The texts end to end (ASCII lower case in plain words), the units' byte ranges, which units are
    whole unusual words, and the index of each text's first unit."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    at = np.concatenate(([0], np.cumsum(size + 1)))
    kind = CLASS[buf]
    before = np.concatenate(([np.uint8(0)], kind[:-1]))
    cut = (kind != 0) & ((kind != before) | (kind == 2))
    lowered = LOWER[buf]
    strange = np.flatnonzero(STRANGE[buf])
    pair = STRANGE[buf[strange]] == 2
    second = buf[np.minimum(strange + 1, len(buf) - 1)]
    strange = strange[~pair | STRANGE_PAIR[buf[strange], second]]
    in_bad = None
    if len(strange):
        first = np.flatnonzero((kind != 0) & (before == 0))  # of each word
        last = np.flatnonzero((kind == 0) & (before != 0))
        bad = np.unique(np.searchsorted(first, strange, "right") - 1)
        edge = np.zeros(len(buf), np.int8)
        edge[first[bad]], edge[last[bad]] = 1, -1
        in_bad = np.cumsum(edge, dtype=np.int8) > 0
        cut &= ~in_bad
        cut[first[bad]] = True
        lowered = np.where(in_bad, buf, lowered)
    stop = np.flatnonzero(cut | (kind == 0))
    opens = np.flatnonzero(cut[stop])
    starts, ends = stop[opens], stop[opens + 1]
    odd = np.zeros(len(starts), bool) if in_bad is None else in_bad[starts]
    return lowered, (starts, ends), odd, np.searchsorted(starts, at)
