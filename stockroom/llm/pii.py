"""Personal data: generators of high recall propose overlapping spans, boosted trees score them
from format and context, and a calibrated threshold selects what is redacted.

Validated formats (``email``, ``ip``, ``card``, ``phone``) are always redacted. They are also the
labels the trees learn from: a proposal is positive if it overlaps a validated span. The features
hold no validator (no checksum, no range check), so the trees pass on what validated spans look
like and the words around them to proposals that a validator misses (a masked address, a number
without its plus sign). Such spans have the kinds ``soft_email`` and ``soft_number``.

So a masked address is a negative while the trees learn, by construction: what is found of them is what looks like a
validated span all the same.

The trees are fitted on a bounded sample: the ``SAMPLE_DOCS`` documents first in a fixed hash order,
and of their proposals four fifths of the ``SAMPLE_SPANS`` first in a fixed hash order. Calibration and threshold (least
score at which ``PRECISION`` of the proposals at or above it are positive) come from a histogram of the margins of all
proposals of all other documents; only where there are none, from the last fifth of the sample. Scoring covers every
proposal of every document.

Defined results: null texts are empty; repeated rows get equal results; empty tables give an empty
result (a sample with one class only gives no trees: validated spans stand alone); texts of any
length are searched whole, in linear time; extra columns are carried by ``redact`` untouched.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosted import calibrate_margins, fit, margins, probability, sigmoid
from .shared import hash_order, map_texts, replace_texts, table

SAMPLE_DOCS = 20_000
SAMPLE_SPANS = 20_000
PRECISION = 0.98

# Fixed values.
BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "soft_email", "soft_number"]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY = re.compile(rb"[0-9@]|[(\[]at[)\]]")
PROPOSALS = [
    re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
               r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++"),
    re.compile(r"(?<![0-9])[+(]?[0-9](?:[\x20().+/-]{0,2}[0-9])++"),
    re.compile(r"(?<![0-9.])[0-9]++(?:[.:][0-9]++){2,7}+"),
]
CONTEXT = [re.compile(p, re.I) for p in (
    r"e-?mail|contact|write to|correo|courriel", r"phone|tel\b|call|mobile|fax|telefon|whatsapp",
    r"card|visa|payment|account|iban|konto|tarjeta|carte", r"\bip\b|host|server|address",
    r"version|license|token|key|hash|sha|md5|\bid\b|isbn|page", r"[=:]\s*[\"']?$", r"[\"'(\[]$")]


def luhn(digits: str) -> bool:
    d = np.frombuffer(digits.encode(), np.uint8)[::-1] - 48
    d = d.astype(np.int64)
    d[1::2] = 2 * d[1::2] - 9 * (d[1::2] > 4)
    return int(d.sum()) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found outwards from each @ (linear in the text)."""
    out, end, p = [], 0, text.find("@")
    while p >= 0:
        s = p
        while s > end and text[s - 1] in LOCAL:
            s -= 1
        m = DOMAIN.match(text, p + 1) if s < p else None
        if m:
            out.append((s, m.end()))
            end = m.end()
        p = text.find("@", max(p + 1, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """The validated spans of a text: (start, end, kind) by start, then kind as listed."""
    out = [(s, e, "email") for s, e in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(x) <= 3 and int(x or "0") <= 255 for x in (y.lstrip("0") for y in m[0].split("."))):
            out.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isascii() and c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda x: (x[0], BASE_KINDS.index(x[2]), x[1]))


def proposals(text: str) -> list[tuple[int, int, int]]:
    """Overlapping candidate spans: (start, end, generator). Numbers need 7 digits."""
    out = []
    for g, p in enumerate(PROPOSALS):
        for m in p.finditer(text):
            if g == 0 or sum(c.isdigit() for c in m[0][:80]) >= (7 if g == 1 else 4):
                out.append((m.start(), m.end(), g))
    return out


def features(text: str, start: int, end: int, generator: int) -> list[float]:
    """Format of the span and its context; lengths are cut off at 80 characters (a feature's
    range, not the span's)."""
    span = text[start:min(end, start + 80)]
    before, after = text[max(0, start - 24):start], text[end:end + 12]
    groups = [len(x) for x in re.findall(r"[0-9]+", span)] or [0]
    count = [sum(c in set_ for c in span) for set_ in (" ", ".", "-", "()[]", "+", "@", "/:")]
    return [generator, len(span), sum(groups), sum(c.isalpha() for c in span), len(groups), max(groups), min(groups),
            groups[0], groups[-1], *count, span[0] == "+", before[-1:].isalnum(), after[:1].isalnum(),
            before[-1:] in ("-", "_", ".", "/"), sum(c.isdigit() for c in before), sum(c.isdigit() for c in after),
            *[bool(p.search(before)) for p in CONTEXT]]


N_FEATURES = len(features("1", 0, 1, 0))


class Covered:
    """Which characters of a text lie in the spans added so far. A test or an addition takes time in the span's length;
    the spans of one kind do not overlap, so all of them together take time in the text's."""

    def __init__(self, text: str, spans=()):
        self.marks = bytearray(len(text))
        for s, e, *_ in spans:
            self.add(s, e)

    def add(self, start: int, end: int) -> None:
        self.marks[start:end] = b"\1" * (end - start)

    def meets(self, start: int, end: int) -> bool:
        return self.marks.find(1, start, end) >= 0


def all_spans(text: str, model: dict | None) -> tuple[list, list]:
    """(validated spans, all spans), each (start, end, kind) in order. Selected proposals do not
    overlap validated spans or one another: the likelier goes first, then the longer, the earlier."""
    base = base_spans(text)
    if model is None:
        return base, base
    taken = Covered(text, base)
    found = [c for c in proposals(text) if not taken.meets(c[0], c[1])]
    if not found:
        return base, base
    p = probability(model, np.array([features(text, *c) for c in found], np.float64))
    chosen = []
    for q, (s, e, g) in sorted(zip(p, found), key=lambda x: (-x[0], x[1][0] - x[1][1], x[1][0])):
        if q >= model["threshold"] and not taken.meets(s, e):
            taken.add(s, e)
            chosen.append((s, e, "soft_email" if g == 0 else "soft_number"))
    return base, sorted([*base, *chosen], key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def train(docs: DataFrame, *, sample_docs: int = SAMPLE_DOCS, sample_spans: int = SAMPLE_SPANS,
          precision: float = PRECISION) -> dict | None:
    """The trees, fitted on the bounded sample, with calibration and threshold (see above); None if one class is missing."""
    order = hash_order("doc_id", "pii")
    last = docs.select(order.alias("h")).orderBy("h").limit(sample_docs).agg(F.max("h")).first()[0]
    if last is None:
        return None

    def run(texts):
        rows, at, x, y = [], [], [], []
        for i, t in enumerate(texts):
            for (s, e, g), hit, text in labelled(t):
                rows.append(i), at.append(s), y.append(hit)
                x.append([float(v) for v in features(text, s, e, g)])
        return rows, {"at": at, "y": y, "x": x}

    got = (map_texts(docs.filter(order <= last), ["doc_id"], run, "at int, y boolean, x array<double>")
           .orderBy(F.xxhash64("doc_id", "at", F.to_json("x")), "doc_id", "at").limit(sample_spans).collect())
    y = np.array([r["y"] for r in got], float)
    if not 0 < y.sum() < len(y) or len(y) < 20:
        return None
    x = np.array([r["x"] for r in got])
    held = np.arange(len(y)) % 5 == 0
    model = fit(x[~held], y[~held])
    m, n = histogram(docs.filter(order > last), model)
    if not (n[0].sum() and n[1].sum()):  # nothing outside the sample to set the threshold by
        m, n = binned(margins(model, x[held]), y[held])
        if not (n[0].sum() and n[1].sum()):
            return None
    model = calibrate_margins(model, np.concatenate((m, m)), np.repeat([0.0, 1.0], len(m)), np.concatenate(n))
    good = np.cumsum(n[1][::-1]) / np.maximum(np.cumsum((n[0] + n[1])[::-1]), 1)
    ok = np.flatnonzero((good >= precision) & (np.cumsum(n[1][::-1]) > 0))
    lowest = m[::-1][ok[-1]] - 0.5 / BINS if len(ok) else None
    return model | {"threshold": 2.0 if lowest is None else max(0.5, float(sigmoid(model["scale"] * lowest + model["shift"])))}


#: Margins are counted in this many steps a unit, from -LIMIT to LIMIT.
BINS, LIMIT = 32, 16


def labelled(t: bytes):
    """Each proposal of a text: (span, does it meet a validated span, text)."""
    if ANY.search(t):
        text = t.decode("utf-8", "replace")
        base = Covered(text, base_spans(text))
        for span in proposals(text):
            yield span, base.meets(span[0], span[1]), text


def bin_of(margin: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((margin + LIMIT) * BINS), 0, 2 * LIMIT * BINS - 1).astype(np.int64)


def binned(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(middle of each bin, counts by label and bin)."""
    n = np.zeros((2, 2 * LIMIT * BINS))
    np.add.at(n, (y.astype(int), bin_of(margin)), 1)
    return (np.arange(n.shape[1]) + 0.5) / BINS - LIMIT, n


def histogram(docs: DataFrame, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """``binned`` of all proposals of ``docs``, counted in Spark (at most two rows a bin reach the driver)."""
    def run(texts):
        x, y = [], []
        for t in texts:
            for (s, e, g), hit, text in labelled(t):
                x.append(features(text, s, e, g)), y.append(hit)
        if not x:
            return [], {"bin": [], "y": [], "n": []}
        _, n = binned(margins(model, np.array(x, np.float64)), np.array(y))
        label, at = np.nonzero(n)
        return [0] * len(at), {"bin": at.tolist(), "y": label.tolist(), "n": n[label, at].astype(np.int64).tolist()}

    m, n = binned(np.zeros(0), np.zeros(0))
    for r in map_texts(docs, [], run, "bin int, y int, n long").groupBy("bin", "y").agg(F.sum("n").alias("n")).collect():
        n[r["y"], r["bin"]] = r["n"]
    return m, n


def line(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def detect(docs: DataFrame, model: dict | None) -> DataFrame:
    """One row for each row of ``docs``: counts of the validated kinds, spans and their digest."""
    empty = hashlib.sha256(b"").hexdigest()

    def run(texts):
        out = {k: [] for k in (*[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans")}
        for t in texts:
            base, every = all_spans(t.decode("utf-8", "replace"), model) if ANY.search(t) else ([], [])
            for k in BASE_KINDS:
                out[f"n_{k}"].append(sum(x[2] == k for x in base))
            out["base_sha256"].append(hashlib.sha256(line(base).encode()).hexdigest() if base else empty)
            out["spans"].append(line(every))
        return None, out

    return map_texts(docs, ["doc_id"], run, ", ".join(f"n_{k} long" for k in BASE_KINDS) + ", base_sha256 string, spans string")


def redact(docs: DataFrame, model: dict | None) -> DataFrame:
    """``docs`` with each selected span replaced by its kind in brackets; overlapping spans
    become one, named after the first."""
    def run(texts):
        out = []
        for t in texts:
            text = t.decode("utf-8", "replace")
            if ANY.search(t):
                parts, end = [], 0
                for s, e, k in all_spans(text, model)[1]:
                    if s >= end:
                        parts += [text[end:s], f"[{k.removeprefix('soft_').upper()}]"]
                    end = max(end, e)
                text = "".join(parts) + text[end:]
            out.append(text)
        return range(len(texts)), out

    return replace_texts(docs, run)


def op3_pii(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return detect(docs, train(docs))
