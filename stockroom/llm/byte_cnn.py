"""Quality classifier: a byte-level convolutional network in numpy.

A document's bytes are cut into overlapping chunks that cover it whole. Learned filters of
``WIDTH`` bytes slide over each chunk (one lookup table per filter position, so a convolution is a
sum of lookups), their activations are max-pooled per chunk, and the chunks' pools are combined into
one probability from their maximum and their mean.

Training (numpy on the driver, mini-batches, Adam, fixed seed) uses at most ``SAMPLE`` labelled rows and ``SAMPLE_BYTES``
bytes of text, outside the held-out fold: in a fixed hash order, each row that still fits in the bytes left, whole. That
bounds what the driver holds; scoring reads every byte of every document.

Defined results: null and empty texts are one chunk of padding and get a score like any other;
rows that repeat a doc_id are scored by their own texts; labels with a null or unknown value teach
nothing; without both classes in the sample the score is the sample's share of label 1 (0.5 if
empty); an empty table gives an empty result; extra columns are left alone.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import hash_order, map_texts, replace_texts, table

FILTERS = 16
WIDTH = 5
CHUNK = 512
STRIDE = 448
SAMPLE = 4000
SAMPLE_BYTES = 24 << 20
EPOCHS = 8
THRESHOLD = 0.3


def chunked(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The chunks of each text as rows of bytes (with the filters' overhang, padded by zeros) and
    the index of each text's first chunk, the number of chunks at the end."""
    n = [max(1, -(-max(len(t) - (CHUNK - STRIDE), 1) // STRIDE)) for t in texts]
    buf = np.frombuffer(b"".join(t.ljust(k * STRIDE + CHUNK + WIDTH, b"\0") for t, k in zip(texts, n)), np.uint8)
    at = np.concatenate(([0], np.cumsum([k * STRIDE + CHUNK + WIDTH for k in n])))
    starts = np.concatenate([at[i] + np.arange(k) * STRIDE for i, k in enumerate(n)]) if n else np.zeros(0, np.int64)
    first = np.concatenate(([0], np.cumsum(n))).astype(np.int64)
    return np.lib.stride_tricks.sliding_window_view(buf, CHUNK + WIDTH - 1)[starts] if n else np.zeros((0, CHUNK + WIDTH - 1), np.uint8), first


def activations(x: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Filter responses at every position of every chunk."""
    z = tables[0][x[:, :CHUNK]]
    for k in range(1, WIDTH):
        z += tables[k][x[:, k:k + CHUNK]]
    return z


def pooled(x: np.ndarray, model: dict, block: int = 16) -> np.ndarray:
    out = np.empty((len(x), FILTERS), np.float32)
    for i in range(0, len(x), block):
        out[i:i + block] = activations(x[i:i + block], model["tables"]).max(1)
    return np.maximum(out + model["bias"], 0)


def combine(pool: np.ndarray, first: np.ndarray) -> np.ndarray:
    n = np.diff(first)[:, None].astype(np.float32)
    return np.concatenate([np.maximum.reduceat(pool, first[:-1]), np.add.reduceat(pool, first[:-1]) / n], 1)


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def score(texts: list[bytes], model: dict) -> np.ndarray:
    if model["tables"] is None:
        return np.full(len(texts), model["prior"])
    x, first = chunked(texts)
    v = combine(pooled(x, model), first)
    return logistic(v.astype(np.float64) @ model["weights"] + model["shift"])


def fit(chunks: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> dict:
    """The network for documents given as chunk matrices and labels 0 or 1."""
    prior = float(y.mean()) if len(y) else 0.5
    if not 0 < y.sum() < len(y):
        return {"tables": None, "prior": prior}
    rng = np.random.default_rng(seed)
    p = {"tables": rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32), "bias": np.zeros(FILTERS, np.float32),
         "weights": rng.normal(0, 0.1, 2 * FILTERS), "shift": np.array(np.log(prior / (1 - prior)))}
    m1, m2 = ({k: np.zeros_like(v, np.float64) for k, v in p.items()} for _ in range(2))
    step, size = 0, 32
    for epoch in range(epochs):
        rate = 0.02 * (1 - epoch / epochs) + 0.002
        order = rng.permutation(len(y))
        for i in range(0, len(order), size):
            pick = order[i:i + size]
            x = np.concatenate([chunks[j] for j in pick])
            first = np.concatenate(([0], np.cumsum([len(chunks[j]) for j in pick])))
            where = np.empty((len(x), FILTERS), np.int64)
            top = np.empty((len(x), FILTERS), np.float32)
            for a in range(0, len(x), 16):
                z = activations(x[a:a + 16], p["tables"])
                where[a:a + 16] = w = z.argmax(1)
                top[a:a + 16] = np.take_along_axis(z, w[:, None], 1)[:, 0]
            pool = np.maximum(top + p["bias"], 0)
            v = combine(pool, first).astype(np.float64)
            error = (logistic(v @ p["weights"] + p["shift"]) - y[pick]) / len(pick)
            gv = error[:, None] * p["weights"]
            doc = np.repeat(np.arange(len(pick)), np.diff(first))
            best = pool == np.maximum.reduceat(pool, first[:-1])[doc]
            ties = np.add.reduceat(best.astype(float), first[:-1])[doc]
            gp = gv[doc, :FILTERS] * best / ties + gv[doc, FILTERS:] / np.diff(first)[doc][:, None]
            gp *= pool > 0
            grad = {"weights": v.T @ error + 1e-4 * p["weights"], "shift": error.sum(), "bias": gp.sum(0)}
            gt = np.zeros_like(p["tables"], np.float64)
            column = np.arange(FILTERS)
            for k in range(WIDTH):
                np.add.at(gt[k], (np.take_along_axis(x, where + k, 1), column), gp)
            grad["tables"] = gt
            step += 1
            for k, g in grad.items():
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.999 * m2[k] + 0.001 * g * g
                p[k] = (p[k] - rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(p[k].dtype)
    return p | {"prior": prior}


def held_out(doc_id="doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, epochs: int = EPOCHS) -> dict:
    """The network, trained on the bounded sample of ``labels`` (doc_id, quality)."""
    rows = (labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("__y"))
                  .filter(F.col("__id").isNotNull() & F.col("__y").isin(0, 1) & ~held_out("__id"))
                  .orderBy(hash_order("__id", "cnn"), "__id", "__y").limit(sample))  # broadcast: `sample` rows at most
    labelled = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(rows), F.col("doc_id") == F.col("__id"))
    order = [hash_order("doc_id", "cnn"), "doc_id", "__y", "key"]
    keyed = labelled.withColumn("key", F.xxhash64("text"))
    taken, left = [], sample_bytes
    for r in keyed.select("doc_id", "__y", "key", F.octet_length("text").alias("n")).orderBy(*order).limit(sample).collect():
        if r["n"] <= left:
            taken.append((r["doc_id"], r["__y"], r["key"]))
            left -= r["n"]
    if not taken:
        return fit([], np.zeros(0), epochs)
    chosen = F.broadcast(docs.sparkSession.createDataFrame(sorted(set(taken)), keyed.select("doc_id", "__y", "key").schema))
    got = keyed.join(chosen, ["doc_id", "__y", "key"]).orderBy(*order).select("text", "__y").limit(len(taken)).collect()
    return fit([chunked([r["text"].encode()])[0] for r in got], np.array([r["__y"] for r in got], float), epochs)


def classify(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): held_out, score, predicted."""
    scored = map_texts(docs, ["doc_id"], lambda texts: (None, {"score": score(texts, model)}), "score double", limit=2 << 20)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the network predicts to be good, whole."""
    def run(texts):
        rows = np.flatnonzero(score(texts, model) >= threshold)
        return rows, [texts[i] for i in rows]

    return replace_texts(docs, run, limit=2 << 20)


def op7_byte_cnn(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classify(docs, train(docs, table(spark, sf_dir, "labels")))
