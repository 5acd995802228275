"""Best-fit packing of tokenised documents by exact-complement hashing.

Documents become pieces of at most ``LENGTH`` tokens (only longer documents are cut). The plan is
made from the histogram of piece lengths, at most ``LENGTH`` rows however large the corpus:

1. full pieces are sequences by themselves;
2. the gap each length leaves is looked up in the index of single lengths, then (for all lengths) of
   pair sums, then of triple sums (a single plus a pair), from the longest length down; a combination
   that fills the gap exactly is taken as often as the availability counts allow. Few-piece fits go
   first: they use up the pieces that fit in few places;
3. what no combination completes is placed by best fit, longest first, into the bins with the
   smallest gap that takes it; bins with equal contents are handled together.

A plan entry says: the r-th to s-th pieces of a length go to consecutive sequences at one offset. Each
step uses up a length or a class of bins, so the plan's size follows the number of lengths, not of
documents; it goes to the tasks with the function that places the pieces (at most some ten thousand
numbers). A piece's rank within its length is a two-level count: within the task that wrote the
piece, then over the tasks. The row's number, which holds the task's, is stored with the piece, so a common length, a null or
repeated doc_id or a text that fills a third of the corpus is spread as widely as the input is, and
no number of buckets has to be chosen. Counts of (length, task) are joined on the keys the ranks are
already partitioned by, so they are never broadcast by order and move no piece again.

Defined results: a null or empty text has just the end token; repeated rows are packed as often as
they occur; a null doc_id is carried; an empty table gives an empty result; extra columns are left
alone. ``tokens=True`` also returns each piece's ids.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import kept, map_texts, table
from .vocabulary import Encoder

LENGTH = 4096
END = 1
VOCABULARY = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def pieces(docs: DataFrame, *, path: str | None = None, length: int = LENGTH, end: int = END, tokens: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of ``docs`` (doc_id, text)."""
    where = path or tokenizer_path()

    def run(texts):
        if not held:
            held.append(Encoder(where))
        rows, out = [], defaultdict(list)
        for row, ids in enumerate(held[0].encode(texts)):
            ids = np.append(ids, np.uint32(end)).astype("<u4")
            for k, at in enumerate(range(0, len(ids), length)):
                part = ids[at:at + length]
                rows.append(row)
                for name, v in (("piece", k), ("start", at), ("length", len(part)), ("ids_crc32", zlib.crc32(part.tobytes()))):
                    out[name].append(v)
                if tokens:
                    out["ids"].append(part.astype(np.int64))
        return rows, out

    held: list[Encoder] = []  # one for each task
    return map_texts(docs, ["doc_id"], run, "piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * tokens)


def best_fit(counts: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """The plan for ``counts`` (length -> pieces): (number of sequences, [(length, how many in each)])."""
    left = np.zeros(size + 1, np.int64)
    for n, c in counts.items():
        left[n] = c
    plan: list[tuple[int, list[tuple[int, int]]]] = []

    def take(combination: list[int]) -> int:
        """Use a combination as often as its pieces last."""
        need = defaultdict(int)
        for n in combination:
            need[n] += 1
        times = min(int(left[n]) // k for n, k in need.items())
        if times:
            for n, k in need.items():
                left[n] -= k * times
            plan.append((times, sorted(need.items(), reverse=True)))
        return times

    if left[size]:
        take([size])
    for n in range(size - 1, 0, -1):
        if left[n] and left[size - n]:
            take([n, size - n])
    for n in range(size - 1, 0, -1):
        pairs(n, size - n, left, take)
    first = pair_sums(left, size)
    for n in range(size - 1, 0, -1):
        triples(n, size - n, left, first, take)
    residual(left, size, plan)
    return plan


def pairs(n: int, gap: int, left: np.ndarray, take) -> None:
    """Fill the gap of n by two pieces, the longest first part first."""
    if not left[n]:
        return
    a = np.arange(gap - 1, (gap - 1) // 2, -1)
    for x in a[(left[a] > 0) & (left[gap - a] > 0)]:
        take([n, int(x), gap - int(x)])
        if not left[n]:
            return


def pair_sums(left: np.ndarray, size: int) -> np.ndarray:
    """For each sum of two available lengths the longest first part that makes it; 0 for no pair."""
    first = np.zeros(size + 1, np.int64)
    have = np.flatnonzero(left > 0)
    for x in have:
        sums = x + have[have <= x]
        first[sums[sums <= size]] = x
    return first


def triples(n: int, gap: int, left: np.ndarray, first: np.ndarray, take) -> None:
    """Fill the gap of n by a single and a pair from the index of pair sums. Lengths only run out, so
    an entry of the index is renewed when it is found used up."""
    if not left[n] or gap < 3:
        return
    have = np.flatnonzero(left[:gap - 1] > 0)[::-1]
    for a in have[first[gap - have] > 0].tolist():
        total = gap - a
        x = int(first[total])
        if not (left[x] and left[total - x]):
            xs = np.arange(total - 1, (total - 1) // 2, -1)
            xs = xs[(left[xs] > 0) & (left[total - xs] > 0)]
            first[total] = x = int(xs[0]) if len(xs) else 0
        if x:
            take([n, a, x, total - x])
            if not left[n]:
                return


def residual(left: np.ndarray, size: int, plan: list) -> None:
    """Best fit, longest first, over classes of bins with equal contents."""
    bins: dict[int, list[tuple[int, list[tuple[int, int]]]]] = defaultdict(list)  # gap -> (bins, contents)
    open_gaps = np.zeros(size + 1, bool)
    for n in range(size, 0, -1):
        c = int(left[n])
        while c:
            fits = np.flatnonzero(open_gaps[n:])
            if len(fits):
                gap = n + int(fits[0])
                many, inside = bins[gap].pop()
            else:
                gap, many, inside = size, c, []
            # equal pieces pile up in a bin: after one, its gap is the smallest that takes the next
            each = min(gap // n, c)
            used = min(many, c // each)
            if not inside:
                many = used
            if used < many:
                bins[gap].append((many - used, inside))
            open_gaps[gap] = bool(bins[gap])
            rest = gap - each * n
            full = (used, [*inside, (n, each)])
            if rest:
                bins[rest].append(full)
                open_gaps[rest] = True
            else:
                plan.append(full)
            c -= used * each
        left[n] = 0
    for same in bins.values():
        plan.extend(same)


def ranges(plan) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first rank of each entry, its first sequence, its offset, copies per sequence."""
    out, used, sequence = defaultdict(list), defaultdict(int), 0
    for times, inside in plan:
        offset = 0
        for n, each in inside:
            out[n].append((used[n], sequence, offset, each))
            used[n] += times * each
            offset += n * each
        sequence += times
    return {n: tuple(np.array(x, np.int64) for x in zip(*v)) for n, v in out.items()}


def numbered(made: DataFrame) -> DataFrame:
    """``made`` written with a number for each row, and the task that wrote it (``__row``, ``__task``).
    Both are read back from the table, so a later task that is run again sees the same order."""
    return kept(made.withColumn("__row", F.monotonically_increasing_id()), "pieces").withColumn("__task", F.shiftright("__row", 33))


def pack(made: DataFrame, *, length: int = LENGTH) -> DataFrame:
    """``made`` (any columns, with length) with sequence_id and offset."""
    names = made.columns
    made_ = numbered(made)
    counts = kept(made_.groupBy("length", "__task").agg(F.count("*").alias("__n")), "pack-counts")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("__n")).collect()}  # at most `length` rows
    entries = ranges(best_fit(histogram, length))
    before = Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("length", "__task").orderBy("__row")
    ranked = (made_.withColumn("__within", F.row_number().over(within)).join(firsts, ["length", "__task"])
                   .withColumn("__rank", F.col("__before") + F.col("__within") - 1)
                   .select(*names, "__rank"))

    def place(batches):
        import pyarrow as pa
        for batch in batches:
            n = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(batch.schema.get_field_index("__rank")).to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            for size in np.unique(n):
                at = np.flatnonzero(n == size)
                first, seq, off, each = entries[int(size)]
                i = np.searchsorted(first, rank[at], "right") - 1
                inner = rank[at] - first[i]
                sequence[at], offset[at] = seq[i] + inner // each[i], off[i] + size * (inner % each[i])
            columns = [batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    from pyspark.sql.types import LongType, StructType
    schema = StructType(list(made.schema.fields)).add("sequence_id", LongType()).add("offset", LongType())
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, *, path: str | None = None, length: int = LENGTH) -> DataFrame:
    return pack(pieces(docs, path=path, length=length), length=length)


def op10_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
