"""Connected components of a link table by alternating large and small stars, and streaming over
sorted groups inside tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import kept


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: long): component is its least node.

    Each round hangs a node's larger neighbours, then its smaller ones, on the least node it knows
    (groupBy and join; nothing but two counters reaches the driver) and is written to the shared
    checkpoint folder. It ends when a round changes nothing."""
    edges = kept(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = print_of(edges)
    for _ in range(rounds):
        if not state[0]:
            break
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .unionAll(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        edges = kept(small, "links")
        before, state = state, print_of(edges)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
                 .unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def print_of(edges: DataFrame):
    """Number of links and an order-free hash of them."""
    return tuple(edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())


def sorted_groups(batches, keys: list[str]):
    """The runs of equal ``keys`` of a task's sorted Arrow batches, each as one Arrow table; a run may
    span batches. Only the current run and batch are held."""
    import pyarrow as pa
    open_key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cut = np.concatenate(([0], np.flatnonzero(change), [batch.num_rows]))
        for a, z in zip(cut[:-1].tolist(), cut[1:].tolist()):
            key = tuple(int(c[a]) for c in columns)
            if held and key != open_key:
                yield open_key, pa.Table.from_batches(held)
                held = []
            open_key = key
            held.append(batch.slice(a, z - a))
    if held:
        yield open_key, pa.Table.from_batches(held)


def without_repeats(batches, keys: list[str]):
    """Sorted Arrow batches without the rows whose ``keys`` equal those of the row before."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        new[0] = last != tuple(int(c[0]) for c in columns)
        last = tuple(int(c[-1]) for c in columns)
        yield batch if new.all() else batch.take(np.flatnonzero(new))


def local_labels(n: int, a: np.ndarray, b: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The least name among each node's component of the links a-b within one task."""
    label = names.copy()
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == label).all():
            break
        label = new
    return label
