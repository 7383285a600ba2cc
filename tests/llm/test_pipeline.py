"""The pipeline against its stages done by hand on the smallest tables."""

import corpus_pipeline
from test_dedup_leaks import brute_classes

from gaitmill.llm import decontaminate, pii, toxicity

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "decontamination", "pii", "packing"]
    scores = {
        r["doc_id"]: r["score"]
        for r in toxicity.score_documents(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    }
    kept = {r["doc_id"]: r["text"] for r in docs.collect() if scores[r["doc_id"]] < 0.5}
    stage = docs
    run = dict(corpus_pipeline.STAGES)

    stage = run["toxicity"](spark, stage, SF).cache()
    assert {r["doc_id"]: r["text"] for r in stage.collect()} == kept and stage.columns == docs.columns

    numbered = sorted(kept.items())
    order = dict(enumerate(i for i, _ in numbered))
    roots = {order[root] for _, root, _ in brute_classes([(k, t) for k, (_, t) in enumerate(numbered)])}
    stage = run["near_dedup"](spark, stage, SF).cache()
    assert {r["doc_id"] for r in stage.collect()} == roots and stage.columns == docs.columns

    items = [decontaminate.normalised(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {d for d in roots if any(i in decontaminate.normalised(kept[d]) for i in items)}
    stage = run["decontamination"](spark, stage, SF).cache()
    assert {r["doc_id"] for r in stage.collect()} == roots - leaks

    stage = run["pii"](spark, stage, SF).cache()
    assert stage.schema == docs.schema
    for r in stage.collect():
        assert not pii.strict_spans(r["text"]) and r["n_chars"] == len(r["text"])

    packed = run["packing"](spark, stage, SF).collect()
    assert {r["doc_id"] for r in packed} == roots - leaks
    whole = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length", "ids_crc32")
    assert sorted(map(tuple, whole.collect())) == sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in packed)
