"""N-gram Jaccard join with Bayesian candidate pruning: documents whose sets of five-word shingles have
a similarity of 0.8 or more are linked.

1. One pass over the texts gives each document the digest of its shingle set and ``BANDS`` band keys,
   each made of ``ROWS`` MinHash values. Documents with equal sets are one class from here on, with
   a weight; copies are never expanded.
2. Classes that share a band key are candidates. A key's holders are chained to its least holder (first
   inside each batch, then in Spark), never paired, and the chains' connected components are the groups
   within which pairs are compared.
3. A group is cut into blocks of bounded size by hash, so a group of any size is many tasks (one for each
   pair of blocks). Inside a task MinHash values are compared ``STEP`` at a time for all pairs of the two
   blocks; a pair goes on while the posterior probability that its similarity reaches the threshold,
   given the matches so far and a uniform prior, is at least ``TOLERANCE``. What is left is verified
   exactly on the shingle sets. Tasks return counts and labels for each class, not pairs.
4. Links are summed; the components of links (one document of which is to stay) come from the labels.

A pair at the threshold misses all bands with probability (1 - 0.8^6)^48 = 5e-7, and pruning loses it
with a probability of the order of the tolerance; both fall fast above the threshold.

Defined results: words are taken as they are; a text of one to four words has one shingle, all its words;
null and empty texts have none, link with nothing and are their own class; a null doc_id takes part
(class_id is the least id that is not null); rows that repeat a doc_id are rows like any other; an
empty table gives an empty result; extra columns are left alone by ``links`` and kept by ``keep_one``.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, local_labels, sorted_groups, without_repeats
from .shared import kept, map_texts, table
from .tokens import U64, Batch, mix, windows

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 48, 6
VALUES, STEP = 64, 16
TOLERANCE = 1e-9
BLOCK_CLASSES, BLOCK_SHINGLES = 128, 1 << 17
#: The ids of candidate classes are broadcast up to this many (16 bytes each); beyond it Spark shuffles.
BROADCAST_ROWS = 1_000_000


def multipliers(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U64) + U64(salt << 32)) | U64(1)


BAND_HASHES = multipliers(BANDS * ROWS, 1)
VALUE_HASHES = multipliers(VALUES, 2)


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after another, and each text's first (the
    total at the end)."""
    b = Batch(texts)
    words, n = b.hashes(), np.diff(b.first)
    h, at = windows(words, b.first, size)
    doc = b.doc[at]
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        extra = []
        for i in short:
            with np.errstate(over="ignore"):
                x = U64(n[i])
                for w in words[b.first[i]:b.first[i + 1]]:
                    x = mix(np.array([x ^ w]))[0]
            extra.append(x)
        h, doc = np.concatenate([h, np.array(extra, U64)]), np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])) if len(h) else np.zeros(0, bool)
    h, doc = h[new], doc[new]
    return h, np.concatenate((np.searchsorted(doc, np.arange(len(texts))), [len(h)]))


def min_hashes(h: np.ndarray, first: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """MinHash values of each set by multiply-shift hashing; empty sets get the largest value."""
    n = np.diff(first)
    full = np.flatnonzero(n > 0)
    out = np.full((len(n), len(factors)), 0xFFFFFFFF, np.uint32)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(full):  # about 64K hashes at a time stay in the cache
            z = max(at + 1, int(np.searchsorted(first[full], first[full[at]] + 65536)))
            rows = full[at:z]
            lo, hi = first[rows[0]], first[rows[-1] + 1]
            part, cut = h[lo:hi], first[rows] - lo
            product = np.empty_like(part)
            for k, f in enumerate(factors):
                np.multiply(part, f, out=product)
                out[rows, k] = np.minimum.reduceat(product, cut) >> U64(32)
            at = z
    return out


def set_digests(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set: equal sets, equal digests."""
    total = lambda x: np.diff(np.concatenate(([U64(0)], np.cumsum(x, dtype=U64)))[first])
    with np.errstate(over="ignore"):
        return total(mix(h)).view(np.int64), total(mix(h ^ U64(0xA5A5A5A55A5A5A5A))).view(np.int64)


def describe(texts: list[bytes]):
    h, first = shingle_sets(texts)
    values = min_hashes(h, first, BAND_HASHES).reshape(len(texts), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=U64), (len(texts), BANDS)).copy()
    with np.errstate(over="ignore"):
        for r in range(ROWS):
            key = mix(key * U64(0x9E3779B97F4A7C15) + values[:, :, r].astype(U64))
    c, c2 = set_digests(h, first)
    return None, {"c": c, "c2": c2, "n": np.diff(first), "keys": [k.tobytes() for k in key]}


def chain_in_batch(batches):
    """(key, a, b): each band key once per batch with its least class; the key's other classes are
    linked to that one at once (key null)."""
    import pyarrow as pa
    for batch in batches:
        if not batch.num_rows:
            continue
        c = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
        key = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
        order = np.lexsort((c, key))
        c, key = c[order], key[order]
        head = np.append(True, key[1:] != key[:-1])
        least = c[head][np.cumsum(head) - 1]
        links = np.unique(np.stack([c[~head], least[~head]], 1), axis=0)
        keys = pa.array(np.concatenate([key[head], np.zeros(len(links), np.int64)]), mask=np.repeat([False, True], [int(head.sum()), len(links)]))
        yield pa.RecordBatch.from_arrays([keys, pa.array(np.concatenate([c[head], links[:, 0]])),
                                          pa.array(np.concatenate([c[head], links[:, 1]]))], names=["key", "a", "b"])


def chain_sorted(batches):
    """Links from every class of a key to the key's least, from rows sorted by key and class; rows that
    are links already pass."""
    import pyarrow as pa
    last_key, last = None, None
    for batch in batches:
        null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        key = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
        a, b = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
        ka, kk = a[~null], key[~null]
        out_a, out_b = a[null], b[null]
        if len(ka):
            head = np.append(True, kk[1:] != kk[:-1])
            least = ka[head]
            if last_key == kk[0]:
                least[0] = last
            least = least[np.cumsum(head) - 1]
            last_key, last = kk[-1], least[-1]
            differ = ka != least
            out_a, out_b = np.concatenate([out_a, ka[differ]]), np.concatenate([out_b, least[differ]])
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])


def least_matches(threshold: float, tolerance: float, values: int = VALUES, step: int = STEP) -> list[tuple[int, int]]:
    """(values compared, matches a pair needs to go on): the posterior of reaching the threshold after k
    of m matches, from a uniform prior, is P(Binomial(m + 1, threshold) <= k)."""
    out = []
    for m in range(step, values + 1, step):
        total, k = 0.0, -1
        while total < tolerance:
            k += 1
            total += math.comb(m + 1, k) * threshold ** k * (1 - threshold) ** (m + 1 - k)
        out.append((m, k))
    return out


def candidate_pairs(va: np.ndarray, vb: np.ndarray, same: bool, needs) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that pass every stage of the pruning; within one block, each pair once."""
    rows, columns = [], []
    for i in range(0, len(va), 64):
        matches = np.zeros((min(64, len(va) - i), len(vb)), np.int16)
        m, k = needs[0]
        for v in range(m):
            matches += va[i:i + 64, v][:, None] == vb[:, v]
        a, b = np.nonzero(matches >= k)
        count = matches[a, b]
        a = a + i
        if same:
            upper = a < b
            a, b, count = a[upper], b[upper], count[upper]
        for (m0, _), (m1, k1) in zip(needs, needs[1:]):
            count = count + (va[a, m0:m1] == vb[b, m0:m1]).sum(1)
            on = count >= k1
            a, b, count = a[on], b[on], count[on]
        rows.append(a), columns.append(b)
    return np.concatenate(rows) if rows else np.zeros(0, int), np.concatenate(columns) if columns else np.zeros(0, int)


def verified(a: np.ndarray, b: np.ndarray, sa: list, sb: list, threshold: float) -> np.ndarray:
    """Whether each pair's exact similarity reaches the threshold. Few pairs: sorted sets are
    intersected; many pairs of the same sets: products of membership matrices, a slice of the
    shingles at a time. Both count exactly."""
    na, nb = np.array([len(s) for s in sa]), np.array([len(s) for s in sb])
    if len(a) <= 4 * (len(sa) + len(sb)):
        common = np.array([len(np.intersect1d(sa[i], sb[j], assume_unique=True)) for i, j in zip(a, b)], np.int64)
    else:
        rows, columns = np.unique(a), np.unique(b)
        xa, xb = np.concatenate([sa[i] for i in rows]), np.concatenate([sb[j] for j in columns])
        ra, rb = np.repeat(np.arange(len(rows)), na[rows]), np.repeat(np.arange(len(columns)), nb[columns])
        shared = np.intersect1d(xa, xb)
        total = np.zeros((len(rows), len(columns)), np.float32)
        pa_, pb_ = np.searchsorted(shared, xa), np.searchsorted(shared, xb)
        oka, okb = (np.append(shared, 0)[p] == x for p, x in ((pa_, xa), (pb_, xb)))
        for at in range(0, len(shared), 4096):
            ma, mb = np.zeros((len(rows), 4096), np.float32), np.zeros((len(columns), 4096), np.float32)
            for m, p, ok, r in ((ma, pa_, oka, ra), (mb, pb_, okb, rb)):
                pick = ok & (p >= at) & (p < at + 4096)
                m[r[pick], p[pick] - at] = 1
            total += ma @ mb.T
        common = total[np.searchsorted(rows, a), np.searchsorted(columns, b)].astype(np.int64)
    return common * (1 + threshold) >= threshold * (na[a] + nb[b]) - 1e-9


def compare_blocks(threshold: float, tolerance: float):
    needs = least_matches(threshold, tolerance)

    def run(batches):
        import pyarrow as pa
        for (_, i, j), t in sorted_groups(without_repeats(batches, ["g", "i", "j", "c"]), ["g", "i", "j"]):
            c, weight, block = (t.column(k).to_numpy() for k in ("c", "weight", "block"))
            parts_ = t.column("blocks").to_numpy()
            values = np.frombuffer(b"".join(t.column("vals").to_pylist()), np.uint32).reshape(-1, VALUES)
            sets = [np.frombuffer(x, U64) for x in t.column("shingles").to_pylist()]
            left = np.flatnonzero(block == i)
            right = left if i == j else np.flatnonzero(block == j)
            a, b = candidate_pairs(values[left], values[right], i == j, needs)
            if len(a):
                ok = verified(a, b, [sets[k] for k in left], [sets[k] for k in right], threshold)
                a, b = a[ok], b[ok]
            a, b = left[a], right[b]
            links = np.bincount(a, weight[b], len(c)) + np.bincount(b, weight[a], len(c))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c), pa.array(links.astype(np.int64)), pa.array(local_labels(len(c), a, b, c)), pa.array(parts_ > 1)],
                names=["c", "links", "label", "split"])

    return run


def row_links(docs: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """One row for each row of ``docs``: doc_id, th (hash of the text), n (shingles), label (its
    component), class_id (the component's least doc_id), n_links."""
    inner = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    described = kept(map_texts(inner, ["doc_id", "th"], describe, "c long, c2 long, n long, keys binary"), "shingles")
    classes = kept(described.groupBy("c", "c2").agg(
        F.min(F.struct(F.isnull("doc_id"), "doc_id", "th")).alias("one"), F.count("*").alias("weight"), F.first("n").alias("n"), F.first("keys").alias("keys"))
        .select("c", "c2", F.col("one.doc_id").alias("rep"), F.col("one.th").alias("rep_th"), "weight", "n", "keys"), "classes")
    chains = (classes.filter("n > 0").select("c", "keys").mapInArrow(chain_in_batch, "key long, a long, b long")
                     .repartition(F.coalesce("key", F.xxhash64("a", "b"))).sortWithinPartitions("key", "a")
                     .mapInArrow(chain_sorted, "a long, b long").distinct())
    groups = components(chains).select(F.col("node").alias("c"), F.col("component").alias("g"))
    members = kept(groups.join(classes.select("c", "rep", "rep_th", "weight", "n"), "c"), "members")
    result = compared(docs, members, threshold, tolerance)
    ends = kept(result.groupBy("c").agg(F.sum("links").alias("links"), F.min("label").alias("label")), "class-links")
    across = result.filter("split AND c <> label").select(F.col("c").alias("a"), F.col("label").alias("b"))
    whole = components(across).select(F.col("node").alias("c"), F.col("component"))
    ends = (ends.join(whole, "c", "left").select("c", "links", F.coalesce("component", "label").alias("label"))
                .join(classes.select("c", "rep"), "c"))
    named = kept(ends.groupBy("label").agg(F.min("rep").alias("class_id")), "class-ids")  # so that Spark can split a large label
    linked = ends.join(named, "label").select("c", "links", "label", "class_id")
    per_class = (classes.select("c", "c2", "rep", "weight").join(linked, "c", "left")
                        .select("c", "c2", F.coalesce("label", "c").alias("label"),
                                F.when(F.col("label").isNull(), F.col("rep")).otherwise(F.col("class_id")).alias("class_id"),
                                (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    return described.select("doc_id", "th", "n", "c", "c2").join(per_class, ["c", "c2"]).drop("c", "c2")


def links(docs: DataFrame, *, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, class_id (least doc_id of its component of
    links) and n_links (other rows linked to it directly)."""
    some = F.col("n") > 0
    return row_links(docs, threshold, tolerance).select(
        "doc_id", F.when(some, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(some, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"))


def compared(docs: DataFrame, members: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(c, links, label, split) from every pair of blocks of every group of ``members``. A class's text is
    that of its member with id ``rep`` (null for a class without ids) and text hash ``rep_th``."""
    sizes = members.groupBy("g").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = members.join(sizes, "g").withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
    if members.count() <= BROADCAST_ROWS:
        placed = F.broadcast(placed)

    def fetch(texts):
        rows = list({t: k for k, t in enumerate(texts)}.values())  # rows equal in id and text are fetched once a batch
        texts = [texts[k] for k in rows]
        h, first = shingle_sets(texts)
        values = min_hashes(h, first, VALUE_HASHES)
        return rows, {"digest": set_digests(h, first)[0], "vals": [v.tobytes() for v in values],
                      "shingles": [h[first[k]:first[k + 1]].tobytes() for k in range(len(texts))]}

    texts = docs.select("doc_id", "text").join(placed, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.xxhash64("text") == F.col("rep_th")))
    rows = (map_texts(texts, ["c", "g", "weight", "block", "blocks"], fetch, "digest long, vals binary, shingles binary")
            .filter("digest = c").drop("digest"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = (rows.withColumn("__x", other)
                  .withColumn("i", F.least("block", "__x")).withColumn("j", F.greatest("block", "__x")).drop("__x"))
    return kept(spread.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "c")
                      .mapInArrow(compare_blocks(threshold, tolerance), "c long, links long, label long, split boolean"), "block-links")


def keep_one(docs: DataFrame, *, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with one row of each component of links: one whose doc_id is the class id, of several the
    one with the least text hash. Rows without shingles stay. Columns are told apart by position."""
    rows = kept(row_links(docs, threshold, tolerance).filter("n > 0"), "row-links")
    first = kept(rows.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("label").agg(F.min("th").alias("first")), "firsts")
    marked = kept(rows.join(first, "label").select(
        "doc_id", "th", (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("th") == F.col("first"))).alias("stays")), "stays")
    at = docs.columns.index
    out = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    doc_id, th = F.col(f"c{at('doc_id')}"), F.xxhash64(f"c{at('text')}")

    def among(ids: DataFrame, how: str) -> DataFrame:
        ids = kept(ids.select(F.col("doc_id").alias("id_"), F.col("th").alias("th_")).distinct(), "ids")
        if ids.count() <= BROADCAST_ROWS:
            ids = F.broadcast(ids)
        return out.join(ids, doc_id.eqNullSafe(F.col("id_")) & (th == F.col("th_")), how)

    repeats = marked.filter("stays").groupBy("doc_id", "th").count().filter("count > 1")
    out = among(marked.filter("NOT stays"), "left_anti")
    if not repeats.isEmpty():  # rows equal in id and text
        again = among(repeats, "left_semi").withColumn("th_", th).dropDuplicates([f"c{at('doc_id')}", "th_"]).drop("th_")
        out = among(repeats, "left_anti").unionAll(again)
    return out.toDF(*docs.columns)


def op2_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return links(table(spark, sf_dir, "documents"))
