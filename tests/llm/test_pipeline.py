"""The pipeline's stages, and its result against the stages' own promises."""

from collections import Counter

import pyarrow as pa

import corpus_pipeline
from rasterloom.llm import langid, mixing, packing, secrets, simhash

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, columns = [docs], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept[-1], SF)
        out.write.parquet(str(tmp_path / name))
        kept.append(spark.read.parquet(str(tmp_path / name)))
    assert all(set(k.columns) == set(columns) for k in kept[:-1])
    first, second, third, fourth, last = kept[1:]
    assert first.count() == docs.where("text is not null").count() - langid.predicted(docs, langid.fit(docs)).where("lang_pred = 'und'").count()
    groups = simhash.near_duplicates(first).select("component_id").distinct().count()
    assert second.count() == groups
    want = {r.doc_id: secrets.masked(r.text, secrets.merged(*secrets.spans(r.text))) for r in second.collect()}
    assert {r.doc_id: r.text for r in third.collect()} == want
    taken = {r.doc_id: r.taken for r in mixing.Mix(third).summary().collect()}
    words = Counter()
    for r in fourth.collect():
        words[r.doc_id] += len(r.text.encode().split())
    assert words == +Counter(taken)
    table = packing.word_ids(packing.default_tokenizer())
    tokens = Counter()
    for r in fourth.collect():
        tokens[r.doc_id] += len(table.ids(r.text)) // 4 + 1
    packed = Counter()
    for r in last.collect():
        packed[r.doc_id] += r.length
    assert packed == tokens
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).drop("sequence_id").collect())) == Counter(map(tuple, last.drop("sequence_id").collect()))


def test_registered():
    import __spark_entry__

    found = __spark_entry__.queries()
    assert "pipeline" in found and all(any(n.startswith(f"op{k}_") for n in found) for k in range(1, 11))


def test_stages_use_small_batches(spark):
    """Whole texts reach Python by few megabytes at a time in every stage; a whole run leaves the session as it was."""
    before = {key: spark.conf.get(key) for key in corpus_pipeline.BATCHES}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.selectExpr("repeat('x', 3000) as text").crossJoin(spark.range(100)).coalesce(1)
    try:
        for _, stage in corpus_pipeline.STAGES:
            for key, value in before.items():
                spark.conf.set(key, value)
            stage(spark, docs, "/root/testdata/sf0.001")
            found = rows.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long")
            assert found.agg({"n": "max"}).first()[0] < 7 << 20
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {key: spark.conf.get(key) for key in before} == before
