"""The pipeline's stages on the smallest tables and on odd rows, each against what its operator says of its input."""

import collections
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lacunar.llm import mixing, simhash, toxicity
from lacunar.llm.queries import tokenizer_path
from lacunar.llm.scratch import materialize
from lacunar.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"


def rows(df):
    return df.collect()


def stage_inputs(spark, docs, sf_dir):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], sf_dir), f"test-{name}"))
    return out


def check(spark, stages, sf_dir):
    docs, clean, one, cut, mixed, packed = stages
    assert all(d.columns == docs.columns for d in (clean, one, cut, mixed))
    bad = toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))).where("predicted = 1")
    assert docs.count() - clean.count() == bad.count()
    near = rows(simhash.near_duplicates(clean))
    assert sorted(str(r["doc_id"]) for r in rows(one)) == sorted([*{str(r["component_id"]) for r in near if r["component_id"] is not None}, *["None" for r in near if r["doc_id"] is None]])
    seen, want = set(), {}
    for r in sorted(rows(one), key=lambda r: (r["doc_id"] is None, r["doc_id"])):
        w = (r["text"] or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            key = tuple(w[k : k + 20])
            gone[k : k + 20] = [True] * 20 if key in seen else gone[k : k + 20]
            seen.add(key)
        want[r["doc_id"]] = b" ".join(x for x, g in zip(w, gone) if not g)
    for r in rows(cut):
        assert b" ".join((r["text"] or "").encode().split()) == want[r["doc_id"]] and r["n_chars"] == (len(r["text"]) if r["text"] is not None else None)
    taken = {r["doc_id"]: r["taken"] for r in rows(mixing.mix(cut)) if r["taken"]}
    got = collections.Counter()
    for r in rows(mixed):
        got[r["doc_id"]] += len(r["text"].encode().split())
    assert got == collections.Counter(taken)
    tk = Encoder.of(tokenizer_path("byte_bpe_50k.json")).tokenizer
    ids = sum(len(tk.encode(r["text"], add_special_tokens=False).ids) + 1 for r in rows(mixed))
    assert packed.agg(F.sum("length")).first()[0] == ids
    used = np.array([r[0] for r in packed.groupBy("sequence_id").agg(F.sum("length")).select(F.col("sum(length)")).collect()])
    assert used.max() <= 2048 and (used < 2048).sum() <= 8


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_smallest_tables(spark):
    stages = stage_inputs(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    check(spark, stages, SF)
    assert corpus_pipeline.run(spark, SF).count() == stages[-1].count()


def test_odd_rows(spark, tmp_path):
    texts = [None, "", " \n", "one", "a b c d e f g " * 9, "héllo wörld " * 300, *(f"w{i} " * 3 + "p q r s " * 12 for i in range(9))]
    data = [(i, t, "en", ("s", "t", None)[i % 3], 5) for i, t in enumerate(texts)]
    data += [(3, "one", "en", "t", 5), (3, "two of id three", "en", "t", 5), (None, "no id here", None, None, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    check(spark, stage_inputs(spark, docs, str(tmp_path)), str(tmp_path))
    empty = docs.where("false")
    assert all(d.count() == 0 for d in stage_inputs(spark, empty, str(tmp_path)))
