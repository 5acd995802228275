"""Repeated passages: Rabin-Karp hashes of every window of ``WINDOW`` words, counted in Spark; windows
that also start earlier are removed, merged into maximal intervals of words.

The rows are numbered and written once to the shared checkpoint folder. Messages go to row numbers, so
rows that share an id, or have none, share no message; doc_id only says which window is earlier. Three
steps in one plan; only the second and the last move texts, through one shuffle that Spark reuses for
both:

1. **Which windows can repeat.** Equal windows hold the same least hash among their ``SUB``-word
   parts (at the same place). Each document sends the low 32 bits of its windows' least hashes,
   about one for seven windows, to slices by hash; a slice answers the documents whose hash occurs
   again. This never misses a repeat; a chance match only lets a window through to step 2.
2. **Counting.** The remaining windows' 64-bit hashes go to slices by their least part, with
   document and start. A slice keeps the earliest start of each hash and answers the others.
3. **Removal.** Each document covers the words of its answered windows and hashes what is left.

Both kinds of message are combined before they are sent: of equal hashes in a task's batch one
is sent, the others are answered on the spot; a window of the same id and start as the one sent (of
rows that share an id or have none) takes that one's answer. So a passage in a third of all documents
costs a slice one entry per batch. A slice holds a share of the hashes; their number follows
``spark.sql.shuffle.partitions``.

Defined results: windows are judged on the input; texts under ``WINDOW`` words and null texts lose
nothing; a null doc_id counts as larger than any other; rows that repeat a doc_id count as one
document for order (equal id and start: neither is earlier) and each keeps its own result; an empty
table gives an empty result; extra columns are left alone. Two different windows with one 64-bit
hash would be taken for equal: about n^2 / 2^65 pairs among n windows that reach step 2.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import kept, table
from .tokens import U64, Batch, blob, text_parts, windows

WINDOW = 20
SUB = 8
LAST = 2 ** 63 - 1


def least_parts(words: np.ndarray, first: np.ndarray, window: int, sub: int):
    """For every window: hash, index of its first word, index and hash of its leftmost least part."""
    w, at = windows(words, first, window)
    if not len(at):
        return w, at, at, w
    s, s_at = windows(words, first, sub)
    part = np.full(len(words), np.iinfo(np.uint64).max, U64)
    part[s_at] = s
    low, size, wide = np.arange(len(words)), 1, window - sub + 1
    while size < wide:
        step = min(size, wide - size)
        a, b = low[:-step], low[step:]
        low = np.where(part[a] <= part[b], a, b)
        size += step
    where = low[at]
    return w, at, where, part[where]


def slice_of(least: np.ndarray, slices: int) -> np.ndarray:
    return ((least >> U64(34)) % U64(slices)).astype(np.int64)


def short(least: np.ndarray) -> np.ndarray:
    return (least & U64(0xFFFFFFFF)).astype(np.uint32)


def runs_of(group: np.ndarray) -> np.ndarray:
    """First index of each run of equal values, and the length at the end."""
    return np.concatenate((np.flatnonzero(np.append(True, group[1:] != group[:-1])), [len(group)])) if len(group) else np.zeros(1, np.int64)


def batches_of(batch, limit: int = 8 << 20):
    for i, j, held in text_parts(batch.column(batch.schema.get_field_index("text")), limit):
        yield i, j, [blob(x) for x in held]


def announce(slices: int, window: int, sub: int):
    """Step 1, document side: (slice, row, hashes, rows). A negative slice is an answer already."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            row = batch.column(batch.schema.get_field_index("row")).to_numpy(zero_copy_only=False)
            for i, j, texts in batches_of(batch):
                b = Batch(texts)
                _, _, where, least = least_parts(b.hashes(), b.first, window, sub)
                if not len(where):
                    continue
                new = runs_of(where)[:-1]  # a window with the same least part as the one before says nothing new
                at, least = where[new], least[new]
                doc, low, to = b.doc[at], short(least), slice_of(least, slices)
                order = np.lexsort((doc, low, to))
                doc, low, to = doc[order], low[order], to[order]
                group = runs_of(to.astype(U64) << U64(32) | low.astype(U64))
                again = np.repeat(np.diff(group) > 1, np.diff(group))
                lone, sent = ~again, group[:-1]
                out = {"slice": [], "row": [], "hashes": [], "rows": []}

                def put(s, r, h, rs):
                    out["slice"].append(s), out["row"].append(r), out["hashes"].append(h), out["rows"].append(rs)

                # one entry for each hash; a hash met twice here is sent twice, so that its slice counts two
                entry = np.sort(np.concatenate((sent, sent[again[sent]])))
                cut = runs_of(to[entry])
                for a, z in zip(cut[:-1], cut[1:]):
                    e = entry[a:z]
                    put(int(to[e[0]]), None, low[e].tobytes(), np.where(lone[e], row[i + doc[e]], -1).astype(np.int64).tobytes()
                        + lone[e].tobytes())
                known = np.flatnonzero(again)
                known = known[np.argsort(doc[known], kind="stable")]
                cut = runs_of(doc[known])
                for a, z in zip(cut[:-1], cut[1:]):
                    d = int(doc[known[a]])
                    put(-1 - int(row[i + d] % slices), int(row[i + d]), low[known[a:z]].tobytes(), b"")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["slice"], pa.int32()), pa.array(out["row"], pa.int64()), pa.array(out["hashes"], pa.binary()), pa.array(out["rows"], pa.binary())],
                    names=["slice", "row", "hashes", "rows"])
    return run


def answer_repeats(pdf):
    """Step 1, slice side: for each document the hashes that occur again."""
    import pandas as pd
    if pdf["slice"].iloc[0] < 0:
        return pdf[["row", "hashes"]].astype({"row": "int64"})
    low = np.frombuffer(b"".join(pdf["hashes"]), np.uint32)
    rows = np.concatenate([np.frombuffer(x[: len(x) // 9 * 8], np.int64) for x in pdf["rows"]])
    lone = np.concatenate([np.frombuffer(x[len(x) // 9 * 8:], bool) for x in pdf["rows"]])
    order = np.argsort(low, kind="stable")
    group = runs_of(low[order])
    again = np.zeros(len(low), bool)
    again[order] = np.repeat(np.diff(group) > 1, np.diff(group))
    told = np.flatnonzero(again & lone)
    told = told[np.argsort(rows[told], kind="stable")]
    cut = runs_of(rows[told])
    return pd.DataFrame({"row": rows[told[cut[:-1]]] if len(told) else np.zeros(0, np.int64),
                         "hashes": [low[told[a:z]].tobytes() for a, z in zip(cut[:-1], cut[1:])]})


def intervals(row: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Sorted (row, start) pairs as runs of consecutive starts: the rows, and for each its (start,
    number) pairs as bytes."""
    if not len(row):
        return row, []
    new = np.append(True, (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1))
    at = np.flatnonzero(new)
    pair = np.stack([start[at], np.diff(np.append(at, len(row)))], 1).astype(np.uint32)
    cut = runs_of(row[at])
    return row[at[cut[:-1]]], [pair[a:z].tobytes() for a, z in zip(cut[:-1], cut[1:])]


def count(slices: int, window: int, sub: int):
    """Step 2, document side: (slice, row, head, keys, rows, counts, hashes, starts); a negative slice is
    an answer already, its runs in ``starts``. With a ``head`` it holds for those of them that the head,
    the row that was sent for windows of equal hash, id and start, is told are removed."""
    names = ["slice", "row", "head", "keys", "rows", "counts", "hashes", "starts"]

    def run(batches):
        import pyarrow as pa
        kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 5]
        for batch in batches:
            row, key = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("row", "key"))
            told = batch.column(batch.schema.get_field_index("told"))
            for i, j, texts in batches_of(batch):
                b = Batch(texts)
                h, at, _, least = least_parts(b.hashes(), b.first, window, sub)
                wanted = [np.frombuffer(b"".join(told[k].as_py()), np.uint32).astype(U64) | U64(k - i) << U64(32) for k in range(i, j)]
                wanted = np.unique(np.concatenate(wanted))
                doc = b.doc[at]
                some = np.flatnonzero(np.isin(doc.astype(U64) << U64(32) | short(least).astype(U64), wanted))
                if not len(some):
                    continue
                doc, h, to, start = doc[some], h[some], slice_of(least[some], slices), at[some] - b.first[doc[some]]
                k = key[i + doc]
                order = np.lexsort((start, k, h))
                cut = runs_of(h[order])
                head = np.repeat(order[cut[:-1]], np.diff(cut))
                later = (k[order] != k[head]) | (start[order] != start[head])
                gone = np.sort(order[later])
                sent = np.sort(order[cut[:-1]])
                out = []
                rows, runs = intervals(doc[gone], start[gone])
                for d, r in zip(rows, runs):
                    out.append((-1 - int(row[i + d] % slices), int(row[i + d]), None, b"", b"", b"", b"", r))
                tie = ~later & (doc[order] != doc[head])
                led, by = doc[order[tie]], doc[head[tie]]
                near = np.lexsort((start[order[tie]], led, by))
                pair, runs = intervals((by[near] << 32) | led[near], start[order[tie]][near])
                for p, r in zip(pair.tolist(), runs):
                    r_, h_ = int(row[i + (p & 0xFFFFFFFF)]), int(row[i + (p >> 32)])
                    out.append((-1 - h_ % slices, r_, h_, b"", b"", b"", b"", r))
                sent = sent[np.argsort(to[sent], kind="stable")]
                cut = runs_of(to[sent])
                for a, z in zip(cut[:-1], cut[1:]):
                    e = sent[a:z]
                    c = runs_of(doc[e])
                    d = i + doc[e[c[:-1]]]
                    out.append((int(to[e[0]]), None, None, key[d].tobytes(), row[d].tobytes(), np.diff(c).astype(np.uint32).tobytes(),
                                h[e].tobytes(), start[e].astype(np.uint32).tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=names)
    return run


def answer_later(pdf):
    """Step 2, slice side: for each document the runs of windows that also start earlier."""
    import pandas as pd
    if pdf["slice"].iloc[0] < 0:
        return pdf[["row", "head", "starts"]].rename(columns={"starts": "runs"}).astype({"row": "int64", "head": "Int64"})
    read = lambda c, t: np.frombuffer(b"".join(pdf[c]), t)
    key, row, n = read("keys", np.int64), read("rows", np.int64), read("counts", np.uint32)
    h, start = read("hashes", U64), read("starts", np.uint32).astype(np.int64)
    doc = np.repeat(np.arange(len(key)), n)
    k = key[doc]
    order = np.lexsort((start, k, h))
    cut = runs_of(h[order])
    head = np.repeat(order[cut[:-1]], np.diff(cut))
    gone = order[(k[order] != k[head]) | (start[order] != start[head])]
    gone = gone[np.lexsort((start[gone], doc[gone]))]
    docs, runs = intervals(doc[gone], start[gone])
    return pd.DataFrame({"row": row[docs], "head": pd.array([None] * len(docs), "Int64"), "runs": runs})


def starts_of(runs: list[bytes]) -> np.ndarray:
    """The sorted starts of (start, number) pairs as bytes."""
    pair = np.frombuffer(b"".join(runs), np.uint32).reshape(-1, 2).astype(np.int64)
    n = pair[:, 1]
    return np.unique(np.repeat(pair[:, 0] - (np.cumsum(n) - n), n) + np.arange(int(n.sum())))


def share(batches):
    """Answers of each row, and those that its ties of one batch take from it: (row, runs)."""
    import pyarrow as pa
    for batch in batches:
        rows, runs = [], []
        for at, own, ties in zip(*(c.to_pylist() for c in batch.columns)):
            if own:
                rows.extend([at] * len(own)), runs.extend(own)
            if own and ties:
                gone = starts_of(own)
                for t in ties:
                    start = np.intersect1d(starts_of([t["runs"]]), gone, assume_unique=True)
                    if len(start):
                        rows.append(t["row"]), runs.append(intervals(np.zeros(len(start), np.int64), start)[1][0])
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(runs, pa.binary())], names=["row", "runs"])


def removed_words(n_words: int, runs: list[bytes], window: int) -> np.ndarray:
    """Which words the removed windows cover: their maximal intervals."""
    edge = np.zeros(n_words + 1, np.int64)
    for r in runs:
        pair = np.frombuffer(r, np.uint32).reshape(-1, 2).astype(np.int64)
        np.add.at(edge, pair[:, 0], 1)
        np.add.at(edge, pair[:, 0] + pair[:, 1] + window - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def remove(window: int, schema):
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            got = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            out = {"n_words": [], "n_removed": [], "kept_text": []}
            for x, runs in zip(got["text"], got["runs"]):
                words = blob(x.as_py()).split()
                gone = removed_words(len(words), runs.as_py() or [], window)
                n = int(gone.sum())
                out["n_words"].append(len(words)), out["n_removed"].append(n)
                out["kept_text"].append(b" ".join([w for w, g in zip(words, gone) if not g] if n else words))
            yield pa.RecordBatch.from_arrays(
                [got["doc_id"], pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in out["kept_text"]] if schema == "digest" else out["kept_text"],
                          pa.string() if schema == "digest" else pa.binary())],
                names=["doc_id", "n_words", "n_removed", "kept"])
    return run


def dedup(docs: DataFrame, *, window: int = WINDOW, sub: int = SUB, digest: bool = False) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_words, n_removed and ``kept``, the
    kept words joined by one space (``digest``: their SHA-256)."""
    spark = docs.sparkSession
    slices = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows are numbered in a table of their own: numbers made on the way could change when a task runs again
    text = kept(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("text").cast("binary").alias("text")), "numbered-texts")
    # a row number that cannot be null needs no filter in either join, so both read one shuffle of the texts
    text = text.select(F.coalesce("row", F.lit(-1)).alias("row"), "doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("key"), "text")
    told = (text.select("row", "text").mapInArrow(announce(slices, window, sub), "slice int, row long, hashes binary, rows binary")
                .groupBy("slice").applyInPandas(answer_repeats, "row long, hashes binary")
                .groupBy("row").agg(F.collect_list("hashes").alias("told")))
    gone = (text.join(told, "row")
                .mapInArrow(count(slices, window, sub), "slice int, row long, head long, keys binary, rows binary, counts binary, hashes binary, starts binary")
                .groupBy("slice").applyInPandas(answer_later, "row long, head long, runs binary")
                .groupBy(F.coalesce("head", "row").alias("at")).agg(
                    F.collect_list(F.when(F.col("head").isNull(), F.col("runs"))).alias("own"),
                    F.collect_list(F.when(F.col("head").isNotNull(), F.struct("row", "runs"))).alias("ties"))
                .mapInArrow(share, "row long, runs binary")
                .groupBy("row").agg(F.collect_list("runs").alias("runs")))
    return (text.join(gone, "row", "left")
                .mapInArrow(remove(window, "digest" if digest else "text"),
                            f"doc_id long, n_words long, n_removed long, kept {'string' if digest else 'binary'}"))


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("kept", "kept_sha256")
