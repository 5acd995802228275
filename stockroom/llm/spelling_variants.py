"""Spelling variants: each word's near words (one edit apart) and the frequent form it is a variant of.

Words are the letter runs of the texts that are long and frequent enough (``frequent_words``). A word is described by how
many letters of each of ``GROUPS`` it has; arranged by these counts, group after group, the words form a trie. One edit
raises at most one count by one (surplus) and lowers at most one by one (deficit), so the near words of a word are found by
a depth-first search that spends a budget of one surplus and one deficit; the words at the leaves are then compared
letter by letter.

On Spark the trie is cut into sub-tries (``split``): from depth ``STEP`` on, a node with at most ``SUBTRIE`` words is a
sub-trie of its own and larger nodes are followed to the next depth. Every word goes once to the sub-trie that holds it,
and as a query to those that its budget reaches, by equi-joins on the counts so far. A sub-trie that many queries reach is
searched by blocks of queries, and the words of one complete count vector, if more than ``SUBTRIE``, by blocks of words
as well: no task holds more than a block of each, and every pair of blocks is compared. Tasks return one row for each query
with a near word: how many there are and the most frequent one.

Inside a task the search walks the trie once for a whole block of queries: a node carries the queries that reach it
and what is left of their budgets. Nodes of at most ``LEAF`` words are compared with their queries on all remaining counts.

Forms are chains of growing frequency (each at least ``RATIO`` times the last), so roots take a number of pointer-doubling
joins that follows from the largest count.

Defined results: null and empty texts have no words; a null doc_id counts as the empty string; repeated rows count as often
as they occur; no frequent words give an empty result; letter runs of any length are taken whole; ties between near words
go to the smallest in code point order; extra columns are left alone. In a batch, words are grouped by 64-bit hashes of
their bytes.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import kept, table
from .tokens import U64, blob, mix, span_hashes, text_parts

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
EVERY = 199
#: Letters of the trie's levels; letters in none of them are in the last.
GROUPS = ("e", "a", "i", "o", "n", "r", "t", "s", "l", "u", "d", "cq", "mw", "pb", "hgv", "kyz", "jfx")
STEP = 3
SUBTRIE = 16_384
QUERIES = 131_072
LEAF = 48
#: Distinct words a counting task holds before it passes them on.
HELD = 200_000
LONG = 64


def crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


CRC = crc_table()
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
ASCII = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])


def crc_after(state: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte span, continued from the CRC-32 of what stands before it."""
    out, size = state.astype(np.uint32), ends - starts
    order = np.argsort(-size, kind="stable")
    order = order[np.searchsorted(-size[order], -LONG):]
    st, at, left = out[order] ^ np.uint32(0xFFFFFFFF), starts[order], size[order]
    for k in range(int(left.max(initial=0))):
        n = int(np.searchsorted(-left, -k))
        st[:n] = CRC[(st[:n] ^ buf[at[:n] + k]) & 255] ^ (st[:n] >> 8)
    out[order] = st ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = zlib.crc32(buf[starts[i]:ends[i]].tobytes(), int(state[i]))
    return out


def words_of(texts: list[bytes], ids: list[str | None], least: int = LEAST_LENGTH, every: int = EVERY) -> dict[bytes, int]:
    """The words of the texts and how often they occur: letter runs with A-Z lower-cased, one in ``every`` pairs of a
    document and a run with a letter taken out, those of ``least`` letters or more."""
    buf = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    at = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
    letter = ASCII[buf]
    two = (buf[:-1] == 0xC3) & (buf[1:] & 0xC0 == 0x80)  # U+00C0 to U+00FF
    letter[:-1] |= two
    letter[1:] |= two
    step = np.diff(np.concatenate(([False], letter, [False])).view(np.int8))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    points = np.concatenate(([0], np.cumsum(buf & 0xC0 != 0x80)))
    length = points[ends] - points[starts]
    ok = length >= least
    starts, ends, length = starts[ok], ends[ok], length[ok]
    if not len(starts):
        return {}
    doc = np.searchsorted(at, starts, "right") - 1
    h = span_hashes(buf, starts, ends)
    _, first, times = np.unique(mix(h ^ mix(doc.astype(U64) + U64(1))), return_index=True, return_counts=True)
    before = np.fromiter((zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids), np.uint32, len(ids))
    starts, ends, length, h = starts[first], ends[first], length[first], h[first]
    crc = crc_after(before[doc[first]], buf, starts, ends).astype(np.int64)
    hit = crc % every == 0
    out: dict[bytes, int] = {}
    _, one, group = np.unique(h[~hit], return_index=True, return_inverse=True)
    raw = buf.tobytes()
    total = np.bincount(group, times[~hit], len(one)).astype(np.int64)
    for s, e, n in zip(starts[~hit][one].tolist(), ends[~hit][one].tolist(), total.tolist()):
        out[raw[s:e]] = n
    for i in np.flatnonzero(hit & (length > least)).tolist():
        word, k = raw[starts[i]:ends[i]].decode(), int(crc[i] % length[i])
        word = (word[:k] + word[k + 1:]).encode()
        out[word] = out.get(word, 0) + int(times[i])
    return out


def frequent_words(docs: DataFrame, *, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, every: int = EVERY,
                   limit: int = 2 << 20) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text) that occur ``least_count`` times or more."""
    import pyarrow as pa

    def rows(held):
        names = list(held)
        for k in range(0, len(names), 50_000):
            part = names[k:k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()).cast(pa.string()), pa.array([held[w] for w in part], pa.int64())],
                                             names=["word", "n"])

    def run(batches):
        held: dict[bytes, int] = {}
        for batch in batches:
            for i, j, texts in text_parts(batch.column(1), limit):
                for w, n in words_of([blob(t) for t in texts], batch.column(0).slice(i, j - i).to_pylist(), least_length, every).items():
                    held[w] = held.get(w, 0) + n
                if len(held) > HELD:
                    yield from rows(held)
                    held = {}
        yield from rows(held)

    counted = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def group_table() -> np.ndarray:
    t = np.full(256, len(GROUPS) - 1)
    for g, letters in enumerate(GROUPS):
        t[[ord(c) for c in letters]] = g
    return t


GROUP_OF = group_table()


def vectors(words: list[bytes]) -> np.ndarray:
    """Letters of each group in each word (Latin-1). Counts end at 32,000, which can only bring vectors closer."""
    of = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    flat = GROUP_OF[np.frombuffer(b"".join(words), np.uint8)]
    n = np.bincount(of * len(GROUPS) + flat, minlength=len(words) * len(GROUPS))
    return np.minimum(n, 32_000).reshape(-1, len(GROUPS)).astype(np.int16)


def leaves(data: np.ndarray, queries: np.ndarray, leaf: int = LEAF):
    """Pairs (query, word) within the budget, as arrays. ``data`` has its rows in lexicographic order; the stack holds
    nodes: a range of them, the level they part at, the queries that reach it and what these may still spend."""
    groups = data.shape[1]
    start = np.ones(len(queries), np.int8)
    stack = [(0, 0, len(data), np.arange(len(queries)), start, start)]
    while stack:
        level, low, high, alive, surplus, deficit = stack.pop()
        if not len(alive):
            continue
        if level == groups or high - low <= leaf:
            each = max(1, (1 << 21) // max(1, (high - low) * max(1, groups - level)))
            for k in range(0, len(alive), each):
                a = alive[k:k + each]
                d = data[None, low:high, level:] - queries[a][:, None, level:]
                change, moved = d.sum(2, dtype=np.int32), np.abs(d).sum(2, dtype=np.int32)
                ok = (moved + change <= 2 * surplus[k:k + each, None]) & (moved - change <= 2 * deficit[k:k + each, None])
                i, j = np.nonzero(ok)
                yield a[i], j + low
            continue
        column = data[low:high, level]
        cut = np.concatenate(([0], np.flatnonzero(column[1:] != column[:-1]) + 1, [high - low])) + low
        mine = queries[alive, level]
        for a, z in zip(cut[:-1].tolist(), cut[1:].tolist()):
            d = data[a, level] - mine
            s, t = surplus - np.maximum(d, 0), deficit - np.maximum(-d, 0)
            ok = (s >= 0) & (t >= 0)
            stack.append((level + 1, a, z, alive[ok], s[ok].astype(np.int8), t[ok].astype(np.int8)))


def one_edit(a: bytes, b: bytes) -> bool:
    """Does exactly one inserted, deleted or replaced letter lead from a to b?"""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[k + 1:] == b[k + (len(a) == len(b)):]


class Letters:
    """Words as rows of letters, for comparing many pairs at once; long words one by one."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        width = int(min(LONG, self.size.max(initial=1))) + 1
        self.rows = np.frombuffer(b"".join(w[:width].ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)

    def near(self, i: np.ndarray, other: Letters, j: np.ndarray) -> np.ndarray:
        """For each pair (word i, word j of other): are they one edit apart?"""
        out = np.zeros(len(i), bool)
        n, m = self.size[i], other.size[j]
        for at in np.flatnonzero((np.abs(n - m) <= 1) & (np.maximum(n, m) > LONG)).tolist():
            out[at] = one_edit(self.words[i[at]], other.words[j[at]])
        short = np.maximum(n, m) <= LONG
        same = np.flatnonzero(short & (n == m))
        width = min(self.rows.shape[1], other.rows.shape[1])
        out[same] = (self.rows[i[same], :width] != other.rows[j[same], :width]).sum(1) == 1
        for longer, x, y, k, l in ((n == m + 1, self, other, i, j), (n + 1 == m, other, self, j, i)):
            at = np.flatnonzero(short & longer)
            a, b = x.rows[k[at]], y.rows[l[at]]
            width = max(a.shape[1], b.shape[1])
            a, b = np.pad(a, ((0, 0), (0, width - a.shape[1]))), np.pad(b, ((0, 0), (0, width - b.shape[1])))
            first = (a != b).argmax(1)
            out[at] = ~((a[:, 1:] != b[:, :-1]) & (np.arange(width - 1) >= first[:, None])).any(1)
        return out


def search(words: list[bytes], counts: np.ndarray, queries: list[bytes]):
    """(number of near words among ``words``, index of the most frequent or -1) for each query."""
    vec, asked = vectors(words), vectors(queries)
    order = np.lexsort(vec.T[::-1])
    name = np.empty(len(words), np.int64)
    name[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    rank = np.empty(len(words), np.int64)  # by count, then by name; the greatest is the most frequent
    rank[np.lexsort((-name, counts))] = np.arange(len(words))
    by_rank = np.argsort(rank)
    left, right = Letters(queries), Letters(words)
    n, best = np.zeros(len(queries), np.int64), np.full(len(queries), -1)
    held, size = [], 0

    def settle():
        i, j = (np.concatenate(x) for x in zip(*held))
        for k in range(0, len(i), 1 << 17):
            a, b = i[k:k + (1 << 17)], order[j[k:k + (1 << 17)]]
            ok = left.near(a, right, b)
            np.add.at(n, a[ok], 1)
            np.maximum.at(best, a[ok], rank[b[ok]])

    for pair in leaves(vec[order], asked):
        held.append(pair)
        size += len(pair[0])
        if size > 1 << 18:
            settle()
            held, size = [], 0
    if held:
        settle()
    return n, np.where(best >= 0, by_rank[best], -1)


def counts_of(word: str = "word"):
    """The count vector as an array column (``vectors`` in SQL functions)."""
    c = F.col(word)
    each = [F.length(c) - F.length(F.translate(c, g, "")) for g in GROUPS[:-1]]
    rest = F.length(c) - sum(each, F.lit(0))
    return F.array(*each, rest)


def reached(vec, key, surplus, deficit, depth: int, step: int):
    """Array of (key, surplus, deficit) of the trie nodes ``step`` levels below ``key`` that the budget reaches."""
    out = F.array(F.struct(key.alias("key"), surplus.alias("surplus"), deficit.alias("deficit")))
    def children(count):
        def child(x, change):
            return F.struct(F.concat(x["key"], F.lit("."), (count + change).cast("string")).alias("key"),
                            (x["surplus"] - max(change, 0)).alias("surplus"), (x["deficit"] - max(-change, 0)).alias("deficit"))

        return lambda x: F.concat(F.array(child(x, 0)), F.when(x["surplus"] > 0, F.array(child(x, 1))).otherwise(F.array()),
                                  F.when((x["deficit"] > 0) & (count > 0), F.array(child(x, -1))).otherwise(F.array()))

    for level in range(depth, depth + step):
        out = F.flatten(F.transform(out, children(vec[level])))
    return out


def split(words: DataFrame, *, subtrie: int = SUBTRIE, step: int = STEP) -> DataFrame:
    """Rows (key, query, word, n): each word of ``words`` (word, n) in its sub-trie, and as a query in all it reaches."""
    made = words.withColumn("vec", counts_of())
    zero = made.select("word", "n", "vec", F.lit("").alias("key"), F.lit(1).alias("surplus"), F.lit(1).alias("deficit"))
    data, asked, out, depth = zero, zero, [], 0
    while depth < len(GROUPS):
        by = min(step, len(GROUPS) - depth)
        here = F.col("key")
        for level in range(depth, depth + by):
            here = F.concat(here, F.lit("."), F.col("vec")[level].cast("string"))
        data = data.withColumn("key", here)
        asked = (asked.withColumn("to", F.explode(reached(F.col("vec"), F.col("key"), F.col("surplus"), F.col("deficit"), depth, by)))
                      .select("word", "n", "vec", "to.*"))
        depth += by
        nodes = data.groupBy("key").agg((F.count("*") <= (subtrie if depth < len(GROUPS) else 2**62)).alias("closed"))
        if depth < len(GROUPS):
            nodes = kept(nodes, "trie-nodes")
        done = [d.join(nodes.filter("closed").select("key"), "key").select("key", F.lit(q).alias("query"), "word", "n") for d, q in ((data, False), (asked, True))]
        out.extend(done)
        if depth == len(GROUPS) or nodes.filter("not closed").isEmpty():
            break
        open_nodes = nodes.filter("not closed").select("key")
        data, asked = kept(data.join(open_nodes, "key"), "trie-words"), kept(asked.join(open_nodes, "key"), "trie-queries")
    rows = out[0]
    for d in out[1:]:
        rows = rows.unionAll(d)
    return rows


def near_words(words: DataFrame, *, subtrie: int = SUBTRIE, queries: int = QUERIES, step: int = STEP) -> DataFrame:
    """(word, n_near, best_n, best) for each word of ``words`` (word, n) that has a near word."""
    import pyarrow as pa
    rows = kept(split(words, subtrie=subtrie, step=step), "trie")
    blocks = (rows.groupBy("key").agg(F.ceil(F.count_if(~F.col("query")) / subtrie).cast("int").alias("of_words"),
                                      F.ceil(F.count_if(F.col("query")) / queries).cast("int").alias("of_queries")))
    salt = F.xxhash64("word")
    mine = F.pmod(salt, F.when(F.col("query"), F.col("of_queries")).otherwise(F.col("of_words"))).cast("int")
    others = F.sequence(F.lit(0), F.when(F.col("query"), F.col("of_words")).otherwise(F.col("of_queries")) - 1)
    placed = (rows.join(blocks, "key").withColumn("mine", mine).withColumn("other", F.explode(others))
                  .select("key", F.when(F.col("query"), F.col("mine")).otherwise(F.col("other")).alias("q"),
                          F.when(F.col("query"), F.col("other")).otherwise(F.col("mine")).alias("w"), "query", "word", "n"))

    def run(group: pa.Table) -> pa.Table:
        asked = np.array(group["query"].to_pylist(), bool)
        every = group["word"].to_pylist()
        names = [w for w, q in zip(every, asked) if q]
        words = [w for w, q in zip(every, asked) if not q]
        counts = group["n"].to_numpy()[~asked]
        n, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if words and names:
            n, best = search([w.encode("latin-1") for w in words], counts, [w.encode("latin-1") for w in names])
        at = np.flatnonzero(n)
        return pa.table({"word": pa.array([names[i] for i in at], pa.string()), "n_near": pa.array(n[at], pa.int64()),
                         "best_n": pa.array(counts[best[at]], pa.int64()), "best": pa.array([words[i] for i in best[at]], pa.string())})

    found = placed.groupBy("key", "q", "w").applyInArrow(run, "word string, n_near long, best_n long, best string")
    top = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("top")).select(
        "word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def forms(words: DataFrame, *, ratio: int = RATIO, subtrie: int = SUBTRIE, queries: int = QUERIES, step: int = STEP) -> DataFrame:
    """One row for each row of ``words`` (word, n): word, form, root, n, n_near, form_n."""
    words = kept(words.select("word", "n"), "words")
    near = near_words(words, subtrie=subtrie, queries=queries, step=step)
    is_form = F.col("best_n") >= ratio * F.col("n")
    made = kept(words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    low, high = made.agg(F.min("n"), F.max("n")).first()
    hops = int(math.log(high / low, ratio) + 1e-9) if high else 0
    pointer = made.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max(0, (hops - 1).bit_length())):  # each round doubles the hops a pointer spans
        onward = pointer.select(F.col("word").alias("at"), F.col("root").alias("far"))
        pointer = kept(pointer.join(onward, F.col("root") == F.col("at"), "left").select("word", F.coalesce("far", "root").alias("root")), "roots")
    return made.join(pointer, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return forms(frequent_words(table(spark, sf_dir, "documents")))
