import random

import corpus_pipeline


def test_every_stage_takes_effect(spark, documents_of, tmp_path):
    rng = random.Random(0)
    word = lambda: "".join(rng.choices("abcdefghijkl", k=rng.randint(2, 8)))
    clean = [" ".join(word() for _ in range(120)) + "." for _ in range(24)]
    passage, item = " ".join(word() for _ in range(60)), " ".join(word() for _ in range(25))
    junk = [" ".join(f"{word().upper()}!!" for _ in range(60)) for _ in range(24)]
    rows = list(enumerate(clean)) + [(100 + i, t) for i, t in enumerate(junk)]
    rows += [(200, clean[0] + " extra"), (201, clean[0]), (300, clean[1][:300] + passage), (301, passage + clean[2][:280]), (400, item + " " + clean[3][:200]), (500, None)]
    docs = documents_of(rows)
    path = tmp_path / "sf"
    spark.createDataFrame([(i, int(i < 100), 0) for i, _ in rows if i < 124], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    docs.write.parquet(f"{path}/documents.parquet")
    left, names = {}, [name for name, _ in corpus_pipeline.STAGES]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left[name] = {r.doc_id: r.text for r in docs.collect()}
    assert names == ["quality_classifier", "jaccard_join", "suffix_dedup", "benchmark_decontamination", "sentencepiece"]
    assert not any(100 <= i < 124 for i in left[names[0]]) and set(range(24)) <= set(left[names[0]])
    assert set(range(24)) <= set(left[names[1]]) and not {200, 201} & set(left[names[1]])
    assert all(passage not in (t or "") for t in left[names[2]].values()) and left[names[2]][5] == clean[5]
    assert 400 in left[names[2]] and 400 not in left[names[3]] and set(range(24)) <= set(left[names[3]])
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(path)).collect()
    assert {r.doc_id for r in last} == set(left[names[3]]) and all(r.round_trip for r in last)
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(path)).collect()} == {r.doc_id for r in last}
