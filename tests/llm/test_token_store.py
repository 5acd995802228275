"""Token store: ids and places against the tokenizer, the hash function, keyed access, odd rows."""

import os
import uuid
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from stockroom.llm import token_store as T
from stockroom.llm.shared import table
from stockroom.session import checkpoint_dir

SF = "/root/testdata/sf0.01"


def new_base(spark):
    return os.path.join(checkpoint_dir(spark), f"test-store-{uuid.uuid4().hex}")


def encoded(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(T.tokenizer_path())
    return [np.array(e.ids + [T.END], "<u4") for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_table_round_trip(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect())
    want, start = {}, 0
    for (doc_id, _), ids in zip(rows, encoded([t for _, t in rows])):
        want[doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    got = T.op11_token_store(spark, SF).collect()
    assert len(got) == len(want) and {r["doc_id"]: tuple(r)[1:] for r in got} == want


def odd_rows():
    rows = [*enumerate(brute.ODD), *[(None, f"null id {i % 7}") for i in range(60)], *[(4, "same id and text")] * 40, (4, "same id, other text"),
            (-5, "negative"), (2**62, "large"), (None, None), *[(100 + i, "w " * (i % 9)) for i in range(300)]]
    return [rows[i] for i in np.random.default_rng(3).permutation(len(rows))]


@pytest.mark.parametrize("bucket_keys, limit", [(T.BUCKET_KEYS, 2 << 20), (16, 40)])
def test_odd_rows(spark, bucket_keys, limit):
    rows = odd_rows()
    docs = brute.documents(spark, rows).withColumn("part", F.lit("clash")).withColumn("occurrence", F.lit(1)).repartition(5)
    base = T.write_store(docs, new_base(spark), bucket_keys=bucket_keys, limit=limit)
    got = sorted(T.read_store(spark, base, ids=True).collect(), key=lambda r: r["start"])
    at = 0
    for r in got:  # the documents lie end to end
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    order = [(r["doc_id"] is None, r["doc_id"] or 0) for r in got]
    assert order == sorted(order)
    want = sorted((str(i), ids.tolist()) for (i, _), ids in zip(rows, encoded([t for _, t in rows])))
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == want
    seen = {}
    for r in got:
        assert r["occurrence"] == seen.get(r["doc_id"], 0)
        seen[r["doc_id"]] = r["occurrence"] + 1
    reader = T.Reader(base)
    for r in got:
        assert reader.get(r["doc_id"], r["occurrence"]).tolist() == r["ids"]
    assert reader.get(4, 42) is None and reader.get(99_999) is None and reader.get("4 ") is None


def test_only_known_keys_are_found(spark):
    base = T.write_store(brute.documents(spark, [(i, f"text {i}") for i in range(50)]), new_base(spark), bucket_keys=8)
    keys = spark.createDataFrame([(i, k) for i in range(-20, 80) for k in (0, 1)], "doc_id long, occurrence int")
    assert sorted(r["doc_id"] for r in T.lookup(keys, base).collect()) == list(range(50))


def test_ids_of_other_types(spark):
    docs = spark.createDataFrame([("b", "two"), ("a", "one"), ("a:0", "three"), (None, "four")], "doc_id string, text string")
    got = T.read_store(spark, T.write_store(docs, new_base(spark))).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == ["a", "a:0", "b", None]


def test_large_vocabularies_take_four_bytes(spark):
    docs = brute.documents(spark, [(1, "one two"), (2, "three")])
    for end, width in ((2, 2), (65_535, 2), (65_536, 4), (2**32 - 1, 4)):
        base = T.write_store(docs, new_base(spark), end=end)
        reader = T.Reader(base)
        got = {r["doc_id"]: r["ids"] for r in T.read_store(spark, base, ids=True).collect()}
        assert got == {i: reader.get(i).tolist() for i in (1, 2)} and got[1][-1] == end
        assert {w for _, w in (x for x in reader.opened.values() if isinstance(x, tuple))} == {width}


def test_empty_table(spark):
    base = T.write_store(brute.documents(spark, []), new_base(spark))
    assert T.read_store(spark, base).count() == 0 and T.Reader(base).get(1) is None


def test_files_of_lost_attempts_count_for_nothing(spark):
    base = T.write_store(brute.documents(spark, [(1, "one"), (2, "two")]), new_base(spark))
    where, folder = T.filesystem(base)
    for name in ("shard-00000000-orphan", "index-00000000-orphan"):
        with where.open_output_stream(f"{folder}/{name}") as f:
            f.write(b"half a fi")
    assert T.read_store(spark, base).count() == 2 and T.Reader(base).get(2) is not None


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 70_000])
def test_function_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    high, low = rng.integers(0, 2**63, (2, n)).astype(np.uint64)
    h = T.Hashing.of(high, low)
    assert sorted(h.slots(high, low).tolist()) == list(range(n))
    if n >= 1000:
        assert 64 * len(h.words) < 4.5 * n and len(h.sizes) < 40
    other = h.slots(*rng.integers(0, 2**63, (2, 100)).astype(np.uint64))
    assert ((other >= -1) & (other < max(n, 1))).all()


def test_a_key_twice_is_an_error():
    with pytest.raises(ValueError):
        T.Hashing.of(np.array([7, 7], np.uint64), np.array([1, 1], np.uint64))
