"""The pipeline's stages against plain versions, each on its own input."""

import collections
import re

import brute
import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from stockroom.llm import byte_cnn, mixing, packing
from stockroom.llm.shared import kept, table

SF = "/root/testdata/sf0.01"


def rows_of(df):
    return collections.Counter((r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect())


def test_each_stage(spark):
    docs = table(spark, SF, "documents")
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["quality_classifier", "ngram_jaccard_join", "pii", "mixing", "best_fit_packing"]
    ins = [docs]
    for _, stage in pipeline.STAGES:
        ins.append(kept(stage(spark, ins[-1], SF), "test-stage"))
    for out in ins[1:-1]:
        assert out.columns == docs.columns

    scored = {r["doc_id"]: r["predicted"] for r in byte_cnn.classify(docs, byte_cnn.train(docs, table(spark, SF, "labels"))).collect()}
    assert rows_of(ins[1]) == collections.Counter({k: n for k, n in rows_of(docs).items() if scored[k[0]]})
    good = table(spark, SF, "labels").filter("quality = 1").join(docs, "doc_id").count()
    assert table(spark, SF, "labels").filter("quality = 1").join(ins[1], "doc_id").count() >= 0.98 * good

    rows = [(r["doc_id"], r["text"]) for r in ins[1].collect()]
    links = brute.jaccard_links(rows)
    stay = {links[k][1] if brute.words(t) else i for k, (i, t) in enumerate(rows)}
    assert {r["doc_id"] for r in ins[2].collect()} == stay and ins[2].count() == len(stay)

    before = {r["doc_id"]: r["text"] for r in ins[2].collect()}
    after = {r["doc_id"]: r for r in ins[3].collect()}
    assert before.keys() == after.keys()
    for i, t in before.items():
        joined, n = brute.spans(t, brute.PERSONAL)
        if not joined:
            assert len(after[i]["text"]) >= 0.9 * len(t)
        else:
            assert not any(brute.spans(after[i]["text"], brute.PERSONAL)[1].values())
            assert re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", after[i]["text"])
        assert after[i]["n_chars"] == len(after[i]["text"])

    plan = {r["doc_id"]: r["copies"] for r in mixing.plan(ins[3]).collect()}
    assert {k[0]: n for k, n in rows_of(ins[4]).items()} == {i: n for i, n in plan.items() if n}

    packed = ins[5].collect()
    assert sum(r["piece"] == 0 for r in packed) == ins[4].count()
    tokens = packing.pieces(ins[4]).agg(F.sum("length")).first()[0]
    assert sum(r["length"] for r in packed) == tokens
    assert len({r["sequence_id"] for r in packed}) <= -(-tokens // 4096) + 2


def test_run_and_odd_rows(spark, tmp_path):
    rows = list(enumerate(brute.ODD)) + [(None, "mail me at a@b.com please, thank you all"), (7, brute.ODD[7]), (7, brute.ODD[7])]
    docs = brute.documents(spark, rows).withColumn("score", F.lit(1)).withColumn("rate", F.lit("r")).withColumn("__new", F.lit(2))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} <= {i for i, _ in rows}
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "none" / "labels.parquet"))
    assert pipeline.run(spark, str(tmp_path / "none")).count() == 0
