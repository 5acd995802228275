"""Token-id store: raw id payloads in shards, found by key through a minimal perfect hash index.

A store is a folder on storage that all executors reach:

* ``shard-<part>-<attempt>``: 16 bytes of header (magic, bytes an id takes), then the ids of the part's documents, one
  after the other, little-endian and unsigned: 16-bit where the whole vocabulary fits, else 32-bit; parts follow each other
  in ascending key order;
* ``index-<bucket>-<attempt>``: keys are dealt into buckets by the CRC-32 of the key, about ``BUCKET_KEYS`` each. A bucket
  holds a minimal perfect hash function and one slot for each key: fingerprint, part, offset, number of ids;
* ``parts``, ``buckets``, ``keys``: Parquet tables that name the files in force (one row for each part and bucket) and the
  keys in order. A file that no row names was left by a task that was run again and counts for nothing.

The function is a cascade of bit arrays: on each level a key hashes to a bit, keys alone on their bit stay there (the bit is
set), the others go on to the next, smaller level. A key's slot is the number of set bits before its own. So a lookup reads a
few words, one slot and one stretch of payload, however large the store is. The slot's 64-bit fingerprint tells a key that is
not in the store (it passes with probability 2^-64).

Documents with equal ids are told apart by their occurrence, 0, 1, ..., in the order of their texts' hashes; the key is the id
with it. Null ids come last and are one such id. The id's text form is hashed, so any type that Spark can order and cast to
text will do.

Writing sorts the documents by range partitioning (ties and repeated rows too are split, by text hash and row number) and
encodes them in the sorted partitions, so ids are written once, where they are made. The driver holds one row a part and one
a bucket.

Defined results: null and empty texts have just the end id; an empty table gives a store without files and an empty
result; repeated rows are documents of their own; texts of any length are encoded whole; extra columns are left out.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid
import zlib
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.session import checkpoint_dir

from .components import sorted_groups
from .shared import kept, table
from .tokens import U64, blob, mix, text_parts
from .vocabulary import Encoder

END = 2
VOCABULARY = "word_bpe_49k.json"
BUCKET_KEYS = 1 << 16
#: Bits of a level for each key that reaches it.
GAMMA = 2.0
LEVELS = 64
SHARD, INDEX = "<8sII", "<8sQII"
SHARD_SIZE, INDEX_SIZE = struct.calcsize(SHARD), struct.calcsize(INDEX)
SHARD_MAGIC, INDEX_MAGIC = b"TOKSHRD1", b"TOKINDX1"
SLOT = np.dtype([("fingerprint", "<u8"), ("part", "<u4"), ("n", "<u4"), ("offset", "<u8")])


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def filesystem(base: str):
    """(pyarrow file system, path) of a folder given as a path or URI."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", base))


# --- the minimal perfect hash function ---

def halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def bit_of(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(high + mix(low + U64(level + 1) * U64(0x9E3779B97F4A7C15))) % U64(size)).astype(np.int64)


class Hashing:
    """A minimal perfect hash function of 128-bit keys: set bits of all levels, and set bits before each word."""

    def __init__(self, sizes: list[int], words: np.ndarray, before: np.ndarray):
        self.sizes, self.words, self.before = sizes, words, before

    @classmethod
    def of(cls, high: np.ndarray, low: np.ndarray) -> Hashing:
        sizes, bits, left = [], [], np.arange(len(high))
        while len(left):
            if len(sizes) == LEVELS:
                raise ValueError("a key occurs twice")
            size = -(-int(GAMMA * len(left)) // 64) * 64
            at = bit_of(high[left], low[left], len(sizes), size)
            n = np.bincount(at, minlength=size)
            sizes.append(size), bits.append(n == 1)
            left = left[n[at] != 1]
        words = np.packbits(np.concatenate(bits), bitorder="little").view("<u8") if bits else np.zeros(0, "<u8")
        n = np.bitwise_count(words).astype(np.uint32)
        return cls(sizes, words, np.cumsum(n, dtype=np.uint32) - n)

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level has its bit (then it is no key of the function)."""
        out, left, first = np.full(len(high), -1), np.arange(len(high)), 0
        for level, size in enumerate(self.sizes):
            at = first + bit_of(high[left], low[left], level, size)
            word, shift = self.words[at >> 6], (at & 63).astype(U64)
            here = (word >> shift) & U64(1) == 1
            below = word & ((U64(1) << shift) - U64(1))
            out[left[here]] = self.before[at[here] >> 6] + np.bitwise_count(below[here])
            left, first = left[~here], first + size
        return out


def index_bytes(keys: list[bytes], part: np.ndarray, offset: np.ndarray, n: np.ndarray) -> bytes:
    """An index file: header, level sizes, words, ranks, slots."""
    high, low = halves(keys)
    h = Hashing.of(high, low)
    slots = np.zeros(len(keys), SLOT)
    at = h.slots(high, low)
    for name, values in (("fingerprint", low), ("part", part), ("n", n), ("offset", offset)):
        slots[name][at] = values
    return b"".join([struct.pack(INDEX, INDEX_MAGIC, len(keys), len(h.sizes), len(h.words)), np.array(h.sizes, "<u8").tobytes(),
                     h.words.astype("<u8").tobytes(), h.before.astype("<u4").tobytes(), slots.tobytes()])


class Index:
    """An index file opened for lookups: the function is held, slots are read where asked for."""

    def __init__(self, file):
        self.file = file
        magic, self.n, levels, words = struct.unpack(INDEX, file.read_at(INDEX_SIZE, 0))
        if magic != INDEX_MAGIC:
            raise ValueError("not an index file")
        head = file.read_at(8 * levels + 12 * words, INDEX_SIZE)
        self.hashing = Hashing(np.frombuffer(head, "<u8", levels).astype(int).tolist(), np.frombuffer(head, "<u8", words, 8 * levels),
                               np.frombuffer(head, "<u4", words, 8 * (levels + words)))
        self.at = INDEX_SIZE + len(head)

    def find(self, keys: list[bytes], whole: bool = True) -> np.ndarray:
        """Slots of the keys, with n = 0 for a key that is not there. ``whole`` reads all slots in one go."""
        high, low = halves(keys)
        at = self.hashing.slots(high, low)
        out = np.zeros(len(keys), SLOT)
        if whole:
            slots = np.frombuffer(self.file.read_at(SLOT.itemsize * self.n, self.at), SLOT)
            out[at >= 0] = slots[at[at >= 0]]
        else:
            for i in np.flatnonzero(at >= 0).tolist():
                out[i] = np.frombuffer(self.file.read_at(SLOT.itemsize, self.at + SLOT.itemsize * int(at[i])), SLOT)[0]
        out[(at < 0) | (out["fingerprint"] != low)] = np.zeros((), SLOT)
        return out


# --- keys ---

def key_text(doc_id="doc_id", occurrence="occurrence"):
    """The text form of a key as a column; ``key_of`` in Python."""
    name = F.col(doc_id).cast("string")
    return F.concat(F.when(name.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), name)), F.lit(":"), F.col(occurrence).cast("string"))


def key_of(doc_id, occurrence: int = 0) -> bytes:
    return f"{'n' if doc_id is None else f'v{doc_id}'}:{occurrence}".encode()


def addressed(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` (doc_id, occurrence, ...) with the bucket and the hash of their key."""
    text = key_text()
    return rows.withColumn("bucket", (F.crc32(text.cast("binary")) % buckets).cast("int")).withColumn("hash", F.unhex(F.md5(text.cast("binary"))))


# --- writing ---

def shard_writer(base: str, path: str, end: int, limit: int):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, encoder, file, name = TaskContext.get().partitionId(), None, None, None
        offset = row = occurrence = 0
        last = None
        try:
            for batch in batches:
                for i, j, held in text_parts(batch.column(1), limit):
                    if file is None:
                        encoder = Encoder(path)
                        width = 2 if max(encoder.whole.get_vocab_size(), end + 1) <= 1 << 16 else 4
                        where, folder = filesystem(base)
                        name = f"shard-{part:08d}-{uuid.uuid4().hex[:12]}"
                        file = where.open_output_stream(f"{folder}/{name}")
                        file.write(struct.pack(SHARD, SHARD_MAGIC, width, 0))
                    ids = batch.column(0).slice(i, j - i)
                    out = [np.append(x, np.uint32(end)).astype(f"<u{width}") for x in encoder.encode([blob(t) for t in held])]
                    file.write(np.concatenate(out).tobytes())
                    n = np.fromiter(map(len, out), np.int64, len(out))
                    seen = []
                    for x in ids.to_pylist():
                        occurrence = occurrence + 1 if row + len(seen) and x == last else 0
                        last = x
                        seen.append(occurrence)
                    rows = np.arange(row, row + len(out))
                    at = offset + np.cumsum(n) - n
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(np.full(len(out), part), pa.int32()), pa.array([name] * len(out), pa.string()), pa.array(rows),
                         pa.array(seen, pa.int64()), pa.array(at), pa.array(n)],
                        names=["doc_id", "part", "file", "row", "seen", "offset", "n"])
                    offset, row = offset + int(n.sum()), row + len(out)
        finally:
            if file is not None:
                file.close()

    return run


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text as bytes) in ascending doc_id order over the partitions; no id or row is bound to one of them."""
    keys = [F.col("doc_id").asc_nulls_last(), F.col("__hash"), F.col("__row")]
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).withColumns(
        {"__hash": F.xxhash64("text"), "__row": F.monotonically_increasing_id()})
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")


def index_writer(base: str):
    def run(group):
        import pyarrow as pa
        bucket = group["bucket"][0].as_py()
        where, folder = filesystem(base)
        name = f"index-{bucket:08d}-{uuid.uuid4().hex[:12]}"
        with where.open_output_stream(f"{folder}/{name}") as f:
            f.write(index_bytes(group["hash"].to_pylist(), *(group[c].to_numpy() for c in ("part", "offset", "n"))))
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "file": [name], "n_keys": pa.array([group.num_rows], pa.int64())})

    return run


def write_store(docs: DataFrame, base: str, *, path: str | None = None, end: int = END, bucket_keys: int = BUCKET_KEYS, limit: int = 2 << 20) -> str:
    """Encode ``docs`` (doc_id, text) into a new store at ``base`` (a shared folder); returns ``base``."""
    spark = docs.sparkSession
    where, folder = filesystem(base)
    where.create_dir(folder, recursive=True)
    ordered = in_order(docs)
    schema = f"doc_id {ordered.schema['doc_id'].dataType.simpleString()}, part int, file string, row long, seen long, offset long, n long"
    entries = kept(ordered.mapInArrow(shard_writer(base, path or tokenizer_path(), end, limit), schema), "token-entries")
    parts = sorted(entries.groupBy("part").agg(  # one row for each task that wrote a shard
        F.min("file").alias("file"), F.sum("n").alias("n_ids"), F.count("*").alias("n_docs"), F.min_by("doc_id", "row").alias("first"),
        F.max_by("doc_id", "row").alias("last"), F.max_by("seen", "row").alias("seen")).collect(), key=lambda r: r["part"])
    made, start, before, carry = [], 0, None, 0
    for k, r in enumerate(parts):
        lead = carry if k and r["first"] == before else 0  # occurrences of this part's first id in the parts before
        made.append((r["part"], r["file"], r["n_ids"], r["n_docs"], start, lead))
        start += r["n_ids"]
        carry = r["seen"] + 1 + (lead if r["seen"] + 1 == r["n_docs"] else 0)
        before = r["last"]
    shards = spark.createDataFrame(made, "part int, file string, n_ids long, n_docs long, start long, lead long")
    shards.coalesce(1).write.parquet(f"{base}/parts")
    first_id = F.when(F.col("seen") == F.col("row"), F.col("lead")).otherwise(F.lit(0))
    keys = entries.join(F.broadcast(shards.select("part", "lead")), "part").withColumn("occurrence", F.col("seen") + first_id)
    buckets = max(1, -(-sum(r[3] for r in made) // bucket_keys))
    named = addressed(keys, buckets).select("bucket", "hash", "part", "offset", "n").groupBy("bucket").applyInArrow(
        index_writer(base), "bucket int, file string, n_keys long")
    named.write.parquet(f"{base}/buckets")
    keys.select("doc_id", "occurrence").write.parquet(f"{base}/keys")
    return base


# --- reading ---

def locate(keys: DataFrame, base: str) -> DataFrame:
    """``keys`` (doc_id, occurrence) with part, offset and n from the index; rows without a document have n = 0."""
    spark = keys.sparkSession
    files = {r["bucket"]: r["file"] for r in spark.read.parquet(f"{base}/buckets").collect()}  # one row for each bucket
    buckets = store_buckets(spark, base)
    schema = f"doc_id {keys.schema['doc_id'].dataType.simpleString()}, occurrence long, part int, offset long, n long"

    def run(batches):
        import pyarrow as pa
        where, folder = filesystem(base)
        for (bucket,), group in sorted_groups(batches, ["bucket"]):
            slots = np.zeros(group.num_rows, SLOT)
            if bucket in files:
                with where.open_input_file(f"{folder}/{files[bucket]}") as f:
                    slots = Index(f).find(group["hash"].to_pylist())
            yield from pa.table([group["doc_id"], group["occurrence"], pa.array(slots["part"].astype(np.int32)), pa.array(slots["offset"].astype(np.int64)),
                                 pa.array(slots["n"].astype(np.int64))], names=["doc_id", "occurrence", "part", "offset", "n"]).to_batches()

    asked = addressed(keys.select("doc_id", F.col("occurrence").cast("long").alias("occurrence")), buckets)
    return asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def store_buckets(spark: SparkSession, base: str) -> int:
    return max((r["bucket"] + 1 for r in spark.read.parquet(f"{base}/buckets").collect()), default=1)


def id_width(file) -> int:
    """Bytes of an id in an opened shard."""
    magic, width, _ = struct.unpack(SHARD, file.read_at(SHARD_SIZE, 0))
    if magic != SHARD_MAGIC:
        raise ValueError("not a shard file")
    return width


def stored_ids(file, width: int, offset: int, n: int) -> np.ndarray:
    """``n`` ids from ``offset`` on, as little-endian unsigned 32-bit integers."""
    return np.frombuffer(file.read_at(width * n, SHARD_SIZE + width * offset), f"<u{width}").astype("<u4")


def read_ids(found: DataFrame, base: str, *, ids: bool = False, limit: int = 8 << 20) -> DataFrame:
    """doc_id, occurrence, part, offset, n, ids_crc32 (and ids) of the documents that ``locate`` found, from the shards."""
    spark = found.sparkSession
    files = {r["part"]: r["file"] for r in spark.read.parquet(f"{base}/parts").select("part", "file").collect()}
    schema = f"doc_id {found.schema['doc_id'].dataType.simpleString()}, occurrence long, part int, offset long, n long, ids_crc32 long" + ", ids array<long>" * ids

    def run(batches):
        import pyarrow as pa
        where, folder = filesystem(base)
        opened, file, width = None, None, 4
        for batch in batches:
            part, offset, n = (batch.column(k).to_numpy() for k in (2, 3, 4))
            crc, held = np.zeros(len(part), np.int64), []
            i = 0
            while i < len(part):
                if part[i] != opened:
                    if file is not None:
                        file.close()
                    opened, file = part[i], where.open_input_file(f"{folder}/{files[int(part[i])]}")
                    width = id_width(file)
                # rows come by part and offset: neighbours within one stretch of the file are read together
                j = i + 1
                while j < len(part) and part[j] == part[i] and width * (offset[j] + n[j] - offset[i]) <= limit:
                    j += 1
                first = int(offset[i])
                stretch = stored_ids(file, width, first, int((offset[i:j] + n[i:j]).max()) - first)
                for k in range(i, j):
                    mine = stretch[int(offset[k]) - first:int(offset[k] + n[k]) - first]
                    crc[k] = zlib.crc32(mine)
                    if ids:
                        held.append(mine.astype(np.int64))
                i = j
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(crc), *([pa.array(held, pa.list_(pa.int64()))] if ids else [])],
                                             names=[*batch.schema.names, "ids_crc32", *(["ids"] if ids else [])])
        if file is not None:
            file.close()

    return found.filter("n > 0").repartition("part").sortWithinPartitions("part", "offset").mapInArrow(run, schema)


def lookup(keys: DataFrame, base: str, *, ids: bool = False) -> DataFrame:
    """The documents of a store that ``keys`` (doc_id, occurrence) name: doc_id, occurrence, start (ids of all documents
    before it), n_tokens, ids_crc32 (and ids). Keys that are not in the store give no row."""
    spark = keys.sparkSession
    shards = F.broadcast(spark.read.parquet(f"{base}/parts").select("part", F.col("start").alias("__start")))
    return (read_ids(locate(keys, base), base, ids=ids).join(shards, "part")
            .select("doc_id", "occurrence", (F.col("__start") + F.col("offset")).alias("start"), F.col("n").alias("n_tokens"), "ids_crc32", *["ids"] * ids))


def read_store(spark: SparkSession, base: str, *, ids: bool = False) -> DataFrame:
    """All documents of a store, each found by its key."""
    return lookup(spark.read.parquet(f"{base}/keys"), base, ids=ids)


class Reader:
    """Keyed access to a store without Spark: each ``get`` reads one slot and one stretch of payload."""

    def __init__(self, base: str):
        self.where, self.folder = filesystem(base)
        self.opened: dict[str, object] = {}

    def named(self, table_name: str, key: str) -> dict[int, str]:
        import pyarrow.parquet as pq
        got = pq.read_table(f"{self.folder}/{table_name}", filesystem=self.where)
        return dict(zip(got[key].to_pylist(), got["file"].to_pylist()))

    @cached_property
    def parts(self) -> dict[int, str]:
        return self.named("parts", "part")

    @cached_property
    def buckets(self) -> dict[int, str]:
        return self.named("buckets", "bucket")

    def get(self, doc_id, occurrence: int = 0) -> np.ndarray | None:
        """The ids of a document, or None if it is not in the store."""
        key = key_of(doc_id, occurrence)
        name = self.buckets.get(zlib.crc32(key) % (max(self.buckets, default=0) + 1))
        if name is None:
            return None
        if name not in self.opened:
            self.opened[name] = Index(self.where.open_input_file(f"{self.folder}/{name}"))
        slot = self.opened[name].find([hashlib.md5(key).digest()], whole=False)[0]
        if not slot["n"]:
            return None
        shard = self.parts[int(slot["part"])]
        if shard not in self.opened:
            file = self.where.open_input_file(f"{self.folder}/{shard}")
            self.opened[shard] = (file, id_width(file))
        return stored_ids(*self.opened[shard], int(slot["offset"]), int(slot["n"]))


def op11_token_store(spark, sf_dir: str) -> DataFrame:
    base = os.path.join(checkpoint_dir(spark), f"token-store-{uuid.uuid4().hex[:12]}")
    return read_store(spark, write_store(table(spark, sf_dir, "documents"), base)).select("doc_id", "start", "n_tokens", "ids_crc32")
