"""Periodic runs of words: maximal stretches that repeat with a smallest period.

A run is a stretch ``[s, e)`` of consecutive words of one text in which words ``q`` apart are equal, ``q`` is the
smallest such period, ``e - s >= max(LEAST, 2 * q)``, and neither neighbour extends it. They are found by:

1. **Direct lag scans** for periods below ``DIRECT``: words compared with the words q further on.
2. **Minimizers at every scale** S = DIRECT, 2 DIRECT, ... for periods in [S, 2S). In a run of such a period every window of
   S words has a copy q words on, so the least m-gram (m = S/2, by hash) of both windows lies q apart. Only the windows'
   least m-grams are kept; pairs of equal ones at a distance in [S, 2S) are seeds, extended to both sides word by word.
   An m-gram that itself repeats with a period of at most m/2 lies inside a run of a smaller scale and is never chosen (its
   equal neighbours would be as many as the words). The others stand more than m/2 apart, so a seed has at most 8 partners.
3. **Junctions**, for windows that hold nothing but such m-grams: then both halves of the run lie in two touching runs of
   one smaller period, and it is extended from where the first of them ends.

A stretch that also repeats with a smaller period is found by both and counts for the smaller. The texts of an Arrow batch
are scanned together, a word that equals nothing between two of them; no text is sent anywhere. Words are compared by
64-bit hashes of their bytes. Work is n log^2 n in the words of a text, whatever they are.

Defined results: null and empty texts have no words and no runs (both digests are those of the empty string); a null doc_id
counts as the empty string in ``planted``; repeated rows and ids are searched row by row; an empty table gives an empty
result; texts of any length are searched whole; ties go to the smallest start, then period; extra columns are left alone by
``runs_of`` and carried by ``collapse``.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import replace_texts, table
from .tokens import BASE, U64, Batch, blob, mix, powers, text_parts

LEAST = 12
#: Periods below it are scanned lag by lag. A gram of DIRECT / 2 words or more with a period of at most half its length is
#: itself long enough to lie in a run that is already known; so DIRECT / 2 must not be below LEAST.
DIRECT = 24
NEVER = U64(2**64 - 1)

COLUMNS = ("n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
           "collapsed_sha256 string")


def streaks(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each stretch of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], equal, [False])).view(np.int8)))
    return edge[0::2], edge[1::2]


def extend(x: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The stretch of i around ``at`` with x[i] == x[i + q]; empty if they differ there."""
    n, step, end = len(x) - q, 64, at
    while end < n:
        k = min(step, n - end)
        differ = x[end:end + k] != x[end + q:end + q + k]
        first = int(differ.argmax())
        if differ[first]:
            end += first
            break
        end, step = end + k, 2 * step
    step, start = 64, at
    while start > 0 and end > at:
        k = min(step, start)
        differ = x[start - k:start] != x[start - k + q:start + q]
        last = int(differ[::-1].argmax())
        if differ[k - 1 - last]:
            start -= last
            break
        start, step = start - k, 2 * step
    return start, end


def window_minima(key: np.ndarray, u: int) -> np.ndarray:
    """Positions that hold the leftmost minimum of some ``u`` consecutive keys, ascending."""
    if len(key) < u:
        return np.zeros(0, np.int64)
    at, width = np.arange(len(key)), 1

    def less(a, b):
        return np.where(key[b] < key[a], b, a)

    while 2 * width <= u:
        at = less(at[:len(at) - width], at[width:])
        width *= 2
    if width < u:
        at = less(at[:len(at) - (u - width)], at[u - width:])
    at = at[np.concatenate(([True], at[1:] != at[:-1]))]
    return at[key[at] != NEVER]


def equal_pairs(at: np.ndarray, key: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of the pairs of equal keys at a distance in [low, high)."""
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    first, lag, t = [], [], 1
    while t < len(at):
        near = (key[t:] == key[:-t]) & (at[t:] - at[:-t] < high)
        if not near.any():
            break
        i = np.flatnonzero(near)
        d = at[i + t] - at[i]
        first.append(at[i][d >= low]), lag.append(d[d >= low])
        t += 1
    return (np.concatenate(first), np.concatenate(lag)) if first else (np.zeros(0, np.int64),) * 2


def from_seeds(x: np.ndarray, at: np.ndarray, lag: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """The stretches around the seeds that are long enough: (start, end, period). Seeds inside the stretch that the
    seed before them gave are passed over."""
    out, order = [], np.lexsort((at, lag))
    last, end = -1, -1
    for i, q in zip(at[order].tolist(), lag[order].tolist()):
        if q == last and i < end:
            continue
        s, end = extend(x, i, q)
        last, end = q, max(end, i + 1)
        if end - s >= max(q, least - q) and x[i] == x[i + q]:
            out.append((s, end + q, q))
    return out


def covered(n: int, runs: np.ndarray, m: int) -> np.ndarray:
    """Which m-grams lie whole in one of the runs."""
    reach = np.zeros(n, np.int64)
    np.maximum.at(reach, runs[:, 0], runs[:, 1])
    return np.maximum.accumulate(reach) >= np.arange(n) + m


def junctions(x: np.ndarray, runs: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds (position, lag) with a lag in [scale, 2 scale) at the end of a run that touches the next of its period."""
    long = runs[runs[:, 1] - runs[:, 0] >= scale]
    long = long[np.lexsort((long[:, 0], long[:, 2]))]
    first, lag = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    touch = (long[1:, 2] == long[:-1, 2]) & (long[1:, 0] <= long[:-1, 1])
    for s, e, _ in long[:-1][touch].tolist():
        q = np.arange(scale, min(2 * scale, e - s + 1))
        q = q[x[e - q] == x[e]] if e < len(x) else q[:0]
        first.append(e - q), lag.append(q)
    return np.concatenate(first), np.concatenate(lag)


def find_runs(x: np.ndarray, longest: int, piece: np.ndarray | None = None, *, least: int = LEAST, direct: int = DIRECT) -> np.ndarray:
    """All runs of the sequence ``x`` (uint64) as rows (start, end, period) by start, then period. No run is longer
    than ``longest``; ``piece`` gives for each position the length of the text it lies in."""
    if direct < 2 * least:
        raise ValueError("direct must be at least 2 * least")
    found: list[tuple[int, int, int]] = []
    for q in range(1, min(direct, longest // 2 + 1)):
        s, e = streaks(x[:-q] == x[q:])
        ok = e - s >= max(q, least - q)
        found.extend(zip(s[ok].tolist(), (e[ok] + q).tolist(), [q] * int(ok.sum())))
    known = distinct(found)
    scale = direct
    pw, ipw = powers(BASE, len(x) + 1), powers(pow(BASE, -1, 2**64), len(x) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, U64), np.cumsum(mix(x) * pw[:-1], dtype=U64)))
    while 2 * scale <= longest:
        m = scale // 2
        small = known[known[:, 2] <= m // 2]
        with np.errstate(over="ignore"):
            key = mix((total[m:] - total[:-m]) * ipw[:len(x) - m + 1])
        key[covered(len(x), small, m)[:len(key)]] = NEVER
        where = None if piece is None else np.flatnonzero(piece[:len(key)] >= 2 * scale)
        sel = window_minima(key if where is None else key[where], scale - m + 1)
        sel = sel if where is None else where[sel]
        at, lag = equal_pairs(sel, key[sel], scale, 2 * scale)
        more, its = junctions(x, small, scale)
        found = from_seeds(x, np.concatenate((at, more)), np.concatenate((lag, its)), least)
        if found:
            known = distinct([*map(tuple, known.tolist()), *found])
        scale *= 2
    return known[np.lexsort((known[:, 2], known[:, 0]))]


def distinct(found) -> np.ndarray:
    """One row for each stretch: that with the smallest period."""
    runs = np.array(found, np.int64).reshape(-1, 3)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    return runs[new]


def planted(doc_id, n: int) -> tuple[int, int]:
    """(a, p): from word a on, a text repeats its p words from there; (n, 1) for the nine in ten texts left as they are."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return n, 1
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


class Scanned:
    """The runs of a list of texts. ``source``: for each word of the texts as judged, the word of the batch it is."""

    def __init__(self, texts: list[bytes], plant: list[tuple[int, int]] | None = None):
        b = self.batch = Batch(texts)
        n = np.diff(b.first)
        self.source = np.arange(len(b.starts))
        for i, k in enumerate(n.tolist()):
            a, p = plant(i, k) if plant else (k, 1)
            if a < k:
                at = self.source[b.first[i]:b.first[i + 1]]
                at[a:] = b.first[i] + a + np.arange(k - a) % p
        words = b.hashes()[self.source]
        # one word between two texts that equals nothing
        place = np.arange(len(words)) + b.doc
        x = mix(np.arange(len(words) + b.n, dtype=U64) + U64(0x5851F42D4C957F2D))
        x[place] = words
        size = np.zeros(len(x), np.int64)
        size[place] = n[b.doc]
        runs = find_runs(x, int(n.max(initial=0)), size)
        self.doc = np.searchsorted(b.first[1:] + np.arange(b.n), runs[:, 0], "right")
        self.start = runs[:, 0] - b.first[self.doc] - self.doc
        self.length, self.period = runs[:, 1] - runs[:, 0], runs[:, 2]
        self.of = np.searchsorted(self.doc, np.arange(b.n + 1))
        edge = np.zeros(len(words) + 1, np.int64)
        first = b.first[self.doc] + self.start
        np.add.at(edge, first + self.period, 1)
        np.add.at(edge, first + self.length, -1)
        self.stays = np.cumsum(edge[:-1]) == 0

    def collapsed(self) -> list[bytes]:
        """The words that stay of each text, joined by one space."""
        b = self.batch
        word = self.source[self.stays]
        size = b.ends[word] - b.starts[word] + 1
        to = np.concatenate(([0], np.cumsum(size)))
        out = np.take(b.buf, np.repeat(b.starts[word] - to[:-1], size) + np.arange(to[-1]), mode="clip") if len(word) else np.zeros(0, np.uint8)
        out[to[1:] - 1] = 32
        cut = to[np.concatenate(([0], np.cumsum(self.stays)))[b.first]]
        raw = out.tobytes()
        return [raw[s:max(s, e - 1)] for s, e in zip(cut[:-1].tolist(), cut[1:].tolist())]


def digests(made: Scanned) -> dict[str, list]:
    """The columns of ``runs_of`` for each text."""
    out: dict[str, list] = {k: [] for k in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256")}
    empty = hashlib.sha256(b"").hexdigest()
    for i, j in zip(made.of[:-1].tolist(), made.of[1:].tolist()):
        out["n_runs"].append(j - i)
        if i == j:
            for k in ("start", "length", "period", "exponent_milli"):
                out[k].append(None)
            out["runs_sha256"].append(empty)
            continue
        top = i + int(made.length[i:j].argmax())  # by start, then period: the first is the tie's winner
        s, n, q = int(made.start[top]), int(made.length[top]), int(made.period[top])
        for k, v in zip(("start", "length", "period", "exponent_milli"), (s, n, q, 1000 * n // q)):
            out[k].append(v)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in zip(made.start[i:j], made.length[i:j], made.period[i:j]))
        out["runs_sha256"].append(hashlib.sha256(lines.encode()).hexdigest())
    out["collapsed_sha256"] = [hashlib.sha256(t).hexdigest() for t in made.collapsed()]
    return out


def runs_of(docs: DataFrame, *, plant: bool = False, limit: int = 2 << 20) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): number of runs, the longest, digests of all runs and of the text
    without its repeats. ``plant``: texts are first made to repeat as ``planted`` says."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    inner = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.col("doc_id").cast("string").alias("id"))
    schema = StructType([inner.schema["doc_id"], *StructType.fromDDL(COLUMNS).fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for i, j, held in text_parts(batch.column(1), limit):
                ids = batch.column(2).slice(i, j - i).to_pylist()
                made = digests(Scanned([blob(t) for t in held], (lambda k, n: planted(ids[k], n)) if plant else None))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).cast(arrow.field(0).type), *(pa.array(made[f.name], f.type) for f in list(arrow)[1:])], schema=arrow)

    return inner.mapInArrow(run, schema)


def collapse(docs: DataFrame) -> DataFrame:
    """``docs`` with each run cut down to its first period; a text with a run has its words joined by one space, the
    others stay as they are."""
    def run(texts):
        made = Scanned(texts)
        short = made.collapsed()
        return range(len(texts)), [short[i] if made.of[i + 1] > made.of[i] else t for i, t in enumerate(texts)]

    return replace_texts(docs, run)


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    return runs_of(table(spark, sf_dir, "documents"), plant=True)
