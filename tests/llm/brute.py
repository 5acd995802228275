"""Plain single-machine versions of the operators' contracts, and small fixtures with odd rows."""

from __future__ import annotations

import collections
import hashlib
import re

from pyspark.sql import types as T

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])


def words(text):
    return WORD.findall((text or "").encode())


def documents(spark, rows):
    """(doc_id, text[, source]) rows as a documents table."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows], DOC)


def spans(text, kinds):
    """kinds: name -> (pattern, accept(match)); the joined spans and the counts."""
    out, n = [], {}
    for rank, (k, (p, accept)) in enumerate(kinds.items()):
        found = [m for m in re.finditer(p, text or "") if accept(m)]
        n[k] = len(found)
        out += [(m.start(), rank, f"{k}:{m.start()}:{m.end()}") for m in found]
    return ",".join(x[2] for x in sorted(out)), n


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


SECRETS = {
    "assign": (r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24)}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def card(m):
    d = re.sub(r"[\x20-]", "", m[0])
    return 12 <= len(d) <= 19 and luhn(d)


PERSONAL = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(len(x) < 4 and int(x or 0) <= 255 for x in (y.lstrip("0") for y in m[0].split(".")))),
    "card": (r"[0-9]([\x20-]?[0-9])+", card),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15)}


def line_counts(text):
    w = words(text)
    windows = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    covered = set()
    for k in range(len(w) - 4):
        if windows[tuple(w[k:k + 5])] > 1:
            covered.update(range(k, k + 5))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def substring_dedup(rows, window=20):
    """rows: (doc_id, text) -> list of (doc_id, n_words, n_removed, sha) in the order of rows."""
    first = {}
    split = [words(t) for _, t in rows]
    order = [2 ** 63 - 1 if i is None else i for i, _ in rows]
    for i, w in zip(order, split):
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            first[key] = min(first.get(key, (i, s)), (i, s))
    out = []
    for (doc_id, _), i, w in zip(rows, order, split):
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (i, s):
                gone.update(range(s, s + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text):
    w = words(text)
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def jaccard_links(rows, threshold=0.8):
    """rows: (doc_id, text) -> {index: (links, component's least id)} by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    near = [[] for _ in rows]
    holder = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holder[x].append(i)
    for i, s in enumerate(sets):
        common = collections.Counter(j for x in s for j in holder[x] if j < i)
        for j, c in common.items():
            if c >= threshold * (len(s) + len(sets[j]) - c) - 1e-9:
                near[i].append(j), near[j].append(i)
    label = list(range(len(rows)))
    for i in range(len(rows)):
        stack, seen = [i], {i}
        while stack:
            for j in near[stack.pop()]:
                if j not in seen:
                    seen.add(j), stack.append(j)
        label[i] = min(rows[j][0] for j in seen if rows[j][0] is not None) if any(rows[j][0] is not None for j in seen) else None
    return {i: (len(near[i]), label[i]) for i in range(len(rows))}


ODD = [None, "", " ", "\n\n \t", "a", "é" * 3, "word " * 200, "x" * 5000, "line one here.\nline one here.\nother | nav | bar | x |",
       "p q r s", "The quick brown fox jumps over the lazy dog again and again today."]
