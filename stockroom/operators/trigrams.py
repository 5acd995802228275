"""A text index for substring search (O01): which rows hold which three characters in a row.

``build`` writes, beside a tab, its postings in ``SHARDS`` folders by the gram's hash, sorted by gram, and the number
of rows of each gram. A posting is a gram with the ids of its rows in one block of ``BLOCK_ROWS`` rows: tasks make the blocks
from the rows they read, so lists are shuffled, not one row for each character of the tab. ``candidates`` reads the postings of a needle's rarest grams - only their shards, and in them only row
groups that hold the grams - and keeps the rows that have them all. A row that contains the needle has all its grams, so
candidates lose nothing; the caller checks the text itself. Needles of fewer than three characters, and needles
whose rarest gram is in more than ``SCAN_SHARE`` of the rows, are better scanned: ``candidates`` then gives None.

Nulls count as empty texts; a text shorter than three characters has no gram and is found by scans only, as no needle of
three characters is in it. ``row_id`` must tell rows apart and be the same on every read of the tab. The driver holds the grams of one needle.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of the library

GRAM = 3
BLOCK_ROWS = 16384
POSTINGS = "gram string, n int, rows array<bigint>"
SHARDS = 64
RAREST = 4
SCAN_SHARE = 0.2


def haystack(cols: list[str]) -> Column:
    """The text of a row that a search looks through."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))


def shard(gram) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(SHARDS)).cast("int")


@dataclass(frozen=True)
class TextIndex:
    path: str
    cols: tuple[str, ...]
    row_id: str
    rows: int


def block_lists(ids, texts: list[str]):
    """(gram, n, rows) of one block as an Arrow batch: each gram of the texts once, with the ids of the rows that hold it."""
    import numpy as np
    import pyarrow as pa
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    code, row = (chars[:-2] << 42) | (chars[1:-1] << 21) | chars[2:], np.where(row[:-2] == row[2:], row[:-2], -1)
    code, row = code[row >= 0], row[row >= 0]
    order = np.argsort(code, kind="stable")  # rows stay ascending within a gram
    code, row = code[order], row[order]
    new = np.ones(len(code), dtype=bool)
    new[1:] = (code[1:] != code[:-1]) | (row[1:] != row[:-1])
    code, row = code[new], row[new]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, dtype=np.int64)
    at = np.append(first, len(code)).astype(np.int32)
    grams = code[first]
    spelt = np.stack([grams >> 42, (grams >> 21) & 0x1FFFFF, grams & 0x1FFFFF], axis=1).astype("<u4").tobytes().decode("utf-32-le")
    return pa.RecordBatch.from_arrays(
        [pa.array([spelt[i:i + GRAM] for i in range(0, len(spelt), GRAM)], pa.string()), pa.array(np.diff(at), pa.int32()),
         pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.asarray(ids)[row], pa.int64()))], names=["gram", "n", "rows"])


def _blocks(batches: Iterator) -> Iterator:
    """The postings of the (row, hay) rows of a task, block by block."""
    import numpy as np
    ids, texts = [], []
    for b in batches:
        for at in range(0, b.num_rows, BLOCK_ROWS):
            part = b.slice(at, BLOCK_ROWS)
            ids.append(part.column(0).to_numpy(zero_copy_only=False))
            texts += [t.decode("utf-8", "replace") for t in part.column(1).to_pylist()]
            if len(texts) >= BLOCK_ROWS:
                yield block_lists(np.concatenate(ids), texts)
                ids, texts = [], []
    if texts:
        yield block_lists(np.concatenate(ids), texts)


def build(tab: DataFrame, cols: list[str], row_id: str, path: str | None = None) -> TextIndex:
    """Index ``cols`` of ``tab``. The postings of a gram that most rows hold are many lists, split over tasks."""
    spark = tab.sparkSession
    path = path or os.path.join(checkpoint_dir(spark), "text-index", uuid.uuid4().hex[:12])
    texts = tab.filter(F.col(row_id).isNotNull()).select(F.col(row_id).cast("bigint").alias("row"), haystack(cols).cast("binary").alias("hay"))
    posted = texts.mapInArrow(_blocks, POSTINGS).withColumn("shard", shard("gram"))
    (posted.hint("rebalance", "shard").sortWithinPartitions("shard", "gram").write.mode("overwrite").partitionBy("shard").parquet(f"{path}/postings"))
    posted = _postings(spark, path)
    (posted.groupBy("gram").agg(F.sum("n").alias("n")).repartitionByRange("gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{path}/counts"))
    return TextIndex(path, tuple(cols), row_id, tab.count())


def _postings(spark, path: str) -> DataFrame:
    return spark.read.schema(f"{POSTINGS}, shard int").parquet(f"{path}/postings")


def rarest(index: TextIndex, spark, needle: str) -> list[tuple[int, str]] | None:
    """(rows, gram) of the needle's rarest grams; None if it is better scanned."""
    grams = sorted({needle[i:i + GRAM] for i in range(len(needle) - GRAM + 1)})
    if not grams:
        return None
    counts = spark.read.schema("gram string, n bigint").parquet(f"{index.path}/counts")
    found = {r["gram"]: r["n"] for r in counts.filter(F.col("gram").isin(grams)).collect()}  # at most the needle's length
    best = sorted((found.get(g, 0), g) for g in grams)[:RAREST]
    return None if best[0][0] > SCAN_SHARE * index.rows else best


def candidates(index: TextIndex, spark, needle: str) -> DataFrame | None:
    """Rows (``row_id``) that hold all of the needle's rarest grams, or None if it is better scanned. Grams that are in more than
    ``SCAN_SHARE`` of the rows are not asked beside rarer ones."""
    best = rarest(index, spark, needle)
    if best is None:
        return None
    grams = [g for n, g in best if n <= SCAN_SHARE * index.rows]
    shards = [r[0] for r in spark.createDataFrame([(g,) for g in grams], "gram string").select(shard("gram")).collect()]
    hits = _postings(spark, index.path).filter(F.col("shard").isin(shards) & F.col("gram").isin(grams))
    hits = hits.select(F.explode("rows").alias("row"))
    return (hits.groupBy("row").agg(F.count("*").alias("n")).filter(F.col("n") == len(grams)).select(F.col("row").alias(index.row_id)))


def search(tab: DataFrame, cols: list[str], needle: str, index: TextIndex | None = None) -> DataFrame:
    """Rows of ``tab`` whose text contains ``needle`` in any case: all of a scan, through the index where it helps."""
    needle = (needle or "").strip().lower()
    if not needle:
        return tab
    exact = F.instr(haystack(cols), F.lit(needle)) > 0
    some = candidates(index, tab.sparkSession, needle) if index is not None and tuple(cols) == index.cols else None
    return tab.filter(exact) if some is None else tab.join(some, index.row_id, "left_semi").filter(exact)
