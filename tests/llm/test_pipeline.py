import corpus_pipeline
from leafmill.llm import queries
from tests.llm.common import awkward, docs, prose


def test_stages_chain(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        sizes.append(docs.count())
        assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns, name
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3]
    kept = spark.read.parquet(str(tmp_path / "2"))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    first = {r.doc_id for r in spark.read.parquet(str(tmp_path / "0")).collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in first for d in good) >= 0.98 * len(good)
    packed = docs.collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in kept.collect()}
    assert sum(r.length for r in packed) == sum({r.doc_id: r.doc_tokens for r in packed}.values())


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def test_stages_on_awkward_rows_and_an_empty_table(spark, tmp_path):
    """Nulls, empty and long texts, repeats and columns whose names clash; then no rows at all."""
    rows = awkward() + [(100 + i, prose(100 + i, 60) + f" token = tk{i}Qz81Lm4Vx9RtB2w") for i in range(20)]
    labels = spark.createDataFrame([(d, int(d % 4 > 0), 0) for d, _ in rows if d is not None], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for k, own in enumerate((rows, [])):
        stage_docs = docs(spark, own)
        columns, dtypes = stage_docs.columns, stage_docs.dtypes
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = stage_docs.count()
            out = str(tmp_path / f"{k}-{name.replace(' ', '-')}")
            stage(spark, stage_docs, str(tmp_path)).write.parquet(out)
            stage_docs = spark.read.parquet(out)
            assert stage_docs.columns == columns and stage_docs.dtypes == dtypes and stage_docs.count() <= before, name
        packed = corpus_pipeline.STAGES[-1][1](spark, stage_docs, str(tmp_path)).collect()
        assert sorted({str(r.doc_id) for r in packed}) == sorted({str(r.doc_id) for r in stage_docs.collect()})
        if not own:
            assert not packed


def test_run_is_the_stages_in_a_row(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs_now = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs_now, sf_dir).write.parquet(str(tmp_path / str(k)))
        docs_now = spark.read.parquet(str(tmp_path / str(k)))
    want = {(r.doc_id, r.n_chars) for r in docs_now.collect()}
    ids = {}
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        ids[r.doc_id] = ids.get(r.doc_id, 0) + r.length
    assert set(ids) == {d for d, _ in want} and all(ids[d] > 0 for d in ids)
