"""Embedding near-duplicates by spherical-cap filters: structured random product codes have
``CODES ** PARTS`` directions each, every vector is list-decoded to all directions it exceeds, vectors
that share a filter meet, and their cosine is verified in double precision.

Each of ``TABLES`` codes turns a vector by a fixed random rotation and cuts it into ``PARTS`` parts, each
with its own ``CODES`` random unit words; a direction is one word per part. Decoding adds the parts'
products and cuts off sums that the best remaining word cannot lift over the threshold, so the list is
complete without trying every direction. The threshold is what random vectors exceed in ``LIST``
directions on average. Measured recall is 0.99 or more at a cosine of 0.93 (tests/llm). A label with n
vectors has n * LIST / CODES ** PARTS unrelated vectors to a filter (0.2 for 5,000), so ``CODES`` should grow
with the square root of n.

Filters held by one class only are dropped before any vector moves.

Vectors equal in label and components are one class with a weight; copies are not expanded. Filters with
many classes are cut into blocks by hash, one task group for each pair of blocks. A pair that meets in
several filters counts in its least common one. Tasks return counts and labels, not pairs; the
components come from the labels.

Defined results: vectors that are null, empty, zero or hold a null or a non-finite component, and rows
with a null label, link with nothing; vectors of different lengths do not link; a null vec_id takes part
(component_id is the least id that is not null); repeated rows are rows like any other; an empty table
gives an empty result; extra columns are left alone.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, local_labels, sorted_groups
from .shared import kept, table

COSINE = 0.93
PARTS, CODES, TABLES = 2, 512, 5
LIST = 12
BLOCK = 1024


def codebook(d: int, number: int = 0, trials: int = 64):
    """Rotation, words of each part, and the threshold for vectors of d components: the product that
    random unit vectors exceed in ``LIST`` directions on average."""
    rng = np.random.default_rng([11, d, number])
    rotation = np.linalg.qr(rng.normal(size=(d, d)))[0]
    parts = np.array_split(np.arange(d), min(PARTS, d))
    words = [rng.normal(size=(len(p), min(CODES, 4 ** len(p)))) for p in parts]  # few components, few directions
    words = [w / np.linalg.norm(w, axis=0) / np.sqrt(len(parts)) for w in words]
    tries = rng.normal(size=(trials, d))
    tries /= np.linalg.norm(tries, axis=1, keepdims=True)
    top = []
    for x in tries:
        sums = np.zeros(1)
        for p, w in zip(parts, words):
            sums = np.add.outer(sums, x[p] @ w).ravel()
        top.append(np.sort(sums)[-8 * LIST:])
    top = np.sort(np.concatenate(top))
    return rotation, parts, words, float(top[-min(LIST * trials, len(top))])


def decode(x: np.ndarray, code) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of every direction that a row of unit vectors exceeds, by row and filter."""
    rotation, parts, words, limit = code
    turned = x @ rotation
    scores = [turned[:, p] @ w for p, w in zip(parts, words)]
    best = np.concatenate([np.cumsum(np.stack([s.max(1) for s in scores[::-1]]), 0)[::-1][1:], np.zeros((1, len(x)))])
    row, name, total = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x))
    for s, rest in zip(scores, best):
        sums = total[:, None] + s[row]
        at, word = np.nonzero(sums + rest[row][:, None] >= limit)
        total, name, row = sums[at, word], name[at] * CODES + word, row[at]
    return row, name


def usable():
    e = F.col("embedding")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return (F.col("label").isNotNull() & e.isNotNull() & F.forall(e, finite) & F.exists(e, lambda v: v != 0))


def unit(vectors) -> np.ndarray:
    x = np.array(vectors, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def filters(batches):
    """Each class once per filter: label, f, c. A filter's number holds the vectors' length too."""
    import pyarrow as pa
    codes: dict = {}
    for batch in batches:
        held = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
        vectors = held["embedding"].to_pylist()
        sizes = np.fromiter(map(len, vectors), np.int64, len(vectors))
        for d in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == d)
            if d not in codes:
                codes[d] = [codebook(d, k) for k in range(TABLES)]
            for i in range(0, len(rows), 512):
                pick = rows[i:i + 512]
                x = unit([vectors[k] for k in pick])
                for k, code in enumerate(codes[d]):
                    row, f = decode(x, code)
                    at = pa.array(pick[row])
                    yield pa.RecordBatch.from_arrays(
                        [held["label"].take(at), pa.array(f + k * CODES ** PARTS + (d << 32)), held["c"].take(at)], names=["label", "f", "c"])


def earlier_common(left: list[np.ndarray], right: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs (a, b): do the lists hold a common value?"""
    if len(a) <= 2 * (len(left) + len(right)):
        return np.array([len(np.intersect1d(left[i], right[j], assume_unique=True)) > 0 for i, j in zip(a, b)], bool)
    xl, xr = np.concatenate(left), np.concatenate(right)
    rl, rr = (np.repeat(np.arange(len(s)), [len(v) for v in s]) for s in (left, right))
    shared = np.intersect1d(xl, xr)
    met = np.zeros((len(left), len(right)), bool)
    for at in range(0, len(shared), 2048):
        some = shared[at:at + 2048]
        ml, mr = np.zeros((len(left), len(some)), np.float32), np.zeros((len(right), len(some)), np.float32)
        for m, x, r in ((ml, xl, rl), (mr, xr, rr)):
            p = np.minimum(np.searchsorted(some, x), len(some) - 1)
            ok = some[p] == x
            m[r[ok], p[ok]] = 1
        met |= ml @ mr.T > 0
    return met[a, b]


def verify(cosine: float):
    def run(batches):
        import pyarrow as pa
        for (_, f, i, j), t in sorted_groups(batches, ["label", "f", "i", "j"]):
            if t.num_rows < 2:
                continue
            c, weight, block = (t.column(k).to_numpy() for k in ("c", "weight", "block"))
            x = unit(t.column("embedding").to_pylist())
            left = np.flatnonzero(block == i)
            right = left if i == j else np.flatnonzero(block == j)
            a, b = np.nonzero(x[left] @ x[right].T >= cosine)
            if i == j:
                a, b = a[a < b], b[a < b]
            if not len(a):
                continue
            before = [np.sort(np.array(v, np.int64)) for v in t.column("all").to_pylist()]
            before = [v[v < f] for v in before]
            own = ~earlier_common([before[k] for k in left], [before[k] for k in right], a, b)
            a, b = left[a[own]], right[b[own]]
            links = np.bincount(a, weight[b], len(c)) + np.bincount(b, weight[a], len(c))
            some = np.flatnonzero(links)
            label = local_labels(len(c), a, b, c)
            yield pa.RecordBatch.from_arrays([pa.array(c[some]), pa.array(links[some].astype(np.int64)), pa.array(label[some])],
                                             names=["c", "links", "label"])

    return run


def near_duplicates(vectors: DataFrame, *, cosine: float = COSINE) -> DataFrame:
    """One row for each row of ``vectors`` (vec_id, embedding, label): n_links, component_id, kept."""
    rows = kept(vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
                       .withColumn("ok", usable())
                       .select("vec_id", F.when(F.col("ok"), F.xxhash64("label", "embedding")).alias("c"),
                               F.when(F.col("ok"), F.struct("label", "embedding")).alias("v")), "vectors")
    classes = kept(rows.filter("c IS NOT NULL").groupBy("c").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("v").alias("v")), "vector-classes")
    vectors_ = classes.select("c", "weight", F.col("v.label").cast("long").alias("label"), F.col("v.embedding").alias("embedding"))
    held = kept(vectors_.select("label", "embedding", "c").mapInArrow(filters, "label long, f long, c long"), "caps")
    shared = held.groupBy("label", "f").agg(F.count("*").alias("__n")).filter("__n > 1")
    lists = (held.join(shared, ["label", "f"]).groupBy("c")
                 .agg(F.collect_list("f").alias("all"), F.collect_list(F.struct("f", F.ceil(F.col("__n") / BLOCK).cast("int").alias("blocks"))).alias("met")))
    sized = (vectors_.join(lists, "c").withColumn("met", F.explode("met"))
                     .withColumns({"f": F.col("met.f"), "blocks": F.col("met.blocks")}).drop("met")
                     .withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
                     .withColumn("__x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                     .withColumn("i", F.least("block", "__x")).withColumn("j", F.greatest("block", "__x"))
                     .select("label", "f", "i", "j", "c", "weight", "block", "embedding", "all"))
    result = kept(sized.repartition("label", "f", "i", "j").sortWithinPartitions("label", "f", "i", "j")
                       .mapInArrow(verify(cosine), "c long, links long, label long"), "vector-links")
    total = result.groupBy("c").agg(F.sum("links").alias("links"))
    whole = components(result.filter("c <> label").select(F.col("c").alias("a"), F.col("label").alias("b")))
    whole = whole.select(F.col("node").alias("c"), F.col("component"))
    ends = classes.select("c", "rep", "weight").join(whole, "c", "left").withColumn("component", F.coalesce("component", "c"))
    named = ends.groupBy("component").agg(F.min("rep").alias("component_id"))
    per_class = (ends.join(named, "component").join(total, "c", "left")
                     .select("c", "component_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    return (rows.select("vec_id", "c").join(per_class, "c", "left")
                .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                        F.when(F.col("c").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
                .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def op6_spherical_caps(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
