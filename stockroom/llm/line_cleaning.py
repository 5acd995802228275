"""Line-first cleaning: rules judge each line, failing lines go, then documents that lost too
much text go.

Rules of a line (only lines with a word are judged):

* punctuation: over 1 in ``SYMBOL_SHARE`` of the code points in its words is one of
  ``! # * $ % & | < > { } ~ ^``;
* navigation: at least 3 bars and no more than 3 words to a bar, or under 3 words and no
  closing mark (``. ! ? : ; , " ' )`` or a byte outside ASCII);
* boilerplate: at most 30 words and a phrase of ``BOILERPLATE`` (any case).

A document fails when the failing lines hold more than ``LOSS_PERCENT`` of the code points in its
words. Defined results: null and empty texts have no words and fail; a repeated row gets the same
result each time; texts of any length are judged whole; extra columns are left alone.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame

from .shared import map_texts, replace_texts, table
from .tokens import SPACE, Batch, span_hashes, windows

# Fixed values.
SYMBOL_SHARE = 8
LOSS_PERCENT = 60
BOILERPLATE = ["all rights reserved", "cookie policy", "privacy policy", "terms of service", "terms of use",
               "click here", "enable javascript", "sign up for our newsletter", "licensed under"]
PHRASES = re.compile(b"(?i)" + b"|".join(re.escape(p.encode()) for p in BOILERPLATE))


def table_of(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


BASE_SYMBOL = table_of(b"#*$%&|<>")
SYMBOL = table_of(b"!#*$%&|<>{}~^")
CLOSING = table_of(b".!?:;,\"')" + bytes(range(128, 256)))

COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, n_lines_removed long, chars_removed long, kept boolean")


def cumulated(x: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(x, dtype=np.int64)))


def group_any_repeat(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: does an equal one exist in its text; does an equal one stand earlier there."""
    order = np.lexsort((np.arange(len(h)), h, doc))
    d, x = doc[order], h[order]
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = (d[1:] == d[:-1]) & (x[1:] == x[:-1])
    repeated, later = np.zeros(len(h), bool), np.zeros(len(h), bool)
    repeated[order], later[order] = same[1:] | same[:-1], same[:-1]
    return repeated, later


def judge(texts: list[bytes]) -> tuple[dict, Batch, dict]:
    """The counts and verdict of each text, and the lines: byte range and whether they fail."""
    b = Batch(texts)
    buf, n = b.buf, np.diff(b.first)
    letter = ~SPACE[buf] & ((buf & 0xC0) != 0x80)
    chars = cumulated(letter)
    end = b.at + b.size
    word_chars = chars[end] - chars[b.at]
    symbols = cumulated(BASE_SYMBOL[buf])
    n_symbols = symbols[end] - symbols[b.at]

    h, at = windows(b.hashes(), b.first, 5)
    repeated, _ = group_any_repeat(b.doc[at], h)
    cover = np.zeros(len(b.starts) + 1, np.int64)
    np.add.at(cover, at[repeated], 1)
    np.add.at(cover, at[repeated] + 5, -1)
    covered = cumulated(np.cumsum(cover[:-1]) > 0)
    n_repeat = covered[b.first[1:]] - covered[b.first[:-1]]

    breaks = np.flatnonzero(buf == 10)
    ls, le = np.concatenate(([0], breaks + 1)), np.append(breaks, len(buf))
    words = np.searchsorted(b.starts, le) - np.searchsorted(b.starts, ls)
    ls, le, words = ls[words > 0], le[words > 0], words[words > 0]
    line_doc = np.searchsorted(b.at, ls, "right") - 1
    _, again = group_any_repeat(line_doc, span_hashes(buf, ls, le))
    n_dup = np.bincount(line_doc[again], minlength=b.n)

    line_chars = chars[le] - chars[ls]
    marks = cumulated(SYMBOL[buf])
    bars = cumulated(buf == 124)
    bars = bars[le] - bars[ls]
    last = np.searchsorted(b.starts, le) - 1
    closed = CLOSING[buf[b.ends[last] - 1]] if len(ls) else np.zeros(0, bool)
    phrase = np.zeros(len(ls), bool)
    found = np.fromiter((m.start() for m in PHRASES.finditer(buf.data)), np.int64)
    if len(found) and len(ls):
        phrase[np.clip(np.searchsorted(ls, found, "right") - 1, 0, None)] = True
    fails = (SYMBOL_SHARE * (marks[le] - marks[ls]) > line_chars) | (bars >= 3) & (words <= 3 * bars) \
        | (words < 3) & ~closed | phrase & (words <= 30)
    removed = np.bincount(line_doc[fails], weights=line_chars[fails], minlength=b.n).astype(np.int64)

    base_failed = (n < 10) | (100 * n_repeat > 20 * n)
    out = {
        "n_words": n, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup,
        "n_repeat_words": n_repeat, "base_failed": base_failed,
        "n_lines_removed": np.bincount(line_doc[fails], minlength=b.n), "chars_removed": removed,
        "kept": ~base_failed & (100 * removed <= LOSS_PERCENT * word_chars) & (n > 0)}
    return out, b, {"start": ls, "end": le, "doc": line_doc, "fails": fails}


def measure(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): counts, verdict of the method (``kept``)."""
    return map_texts(docs, ["doc_id"], lambda texts: (None, judge(texts)[0]), COLUMNS)


def clean(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their failing lines taken out of ``text``."""
    def run(texts):
        out, b, lines = judge(texts)
        new = list(texts)
        for d in np.unique(lines["doc"][lines["fails"]]):
            gone = set((lines["start"][(lines["doc"] == d) & lines["fails"]] - b.at[d]).tolist())
            at, keep = 0, []
            for line in new[d].split(b"\n"):
                if at not in gone:
                    keep.append(line)
                at += len(line) + 1
            new[d] = b"\n".join(keep)
        rows = np.flatnonzero(out["kept"])
        return rows, [new[i] for i in rows]

    return replace_texts(docs, run)


def op4_line_cleaning(spark, sf_dir: str) -> DataFrame:
    return measure(table(spark, sf_dir, "documents"))
