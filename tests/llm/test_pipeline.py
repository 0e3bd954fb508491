import corpus_pipeline
from tickwell.llm import decontaminate, suffix_dedup
from tickwell.session import materialize

SF_DIR = "/root/testdata/sf0.001"


def stages(spark, docs):
    made = [docs]
    for name, stage in corpus_pipeline.STAGES:
        made.append(materialize(stage(spark, made[-1], SF_DIR), name))
    return made


def test_each_stage_takes_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    made = stages(spark, docs)
    for table in made[1:-1]:
        assert table.columns == docs.columns
        assert {r.doc_id for r in table.select("doc_id").collect()} <= {r.doc_id for r in docs.select("doc_id").collect()}
    texts = {r.doc_id: r.text for r in made[2].collect()}
    assert len(set(texts.values())) == len(texts)  # no exact copies left
    assert suffix_dedup.dedup(made[3], corpus_pipeline.REPEATED_BYTES).agg({"n_removed": "sum"}).first()[0] < 2000
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert decontaminate.contaminated(made[4], benchmark).isEmpty()
    assert made[5].count() == made[4].count()
    ran = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "ids_sha256")
    assert sorted(map(tuple, ran.collect())) == sorted(map(tuple, made[5].select("doc_id", "ids_sha256").collect()))


def test_awkward_rows(spark, awkward):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, t, None, None, None) for i, t in awkward] + [(30, "plain words of one tongue", "en", "s", 3), (31, "mots de la langue", "fr", "s", 3)]
    made = stages(spark, spark.createDataFrame(rows, schema))
    assert {r.doc_id for r in made[-1].collect()} <= {i for i, *_ in rows}
    empty = stages(spark, spark.createDataFrame([], schema))
    assert all(t.isEmpty() for t in empty[1:])


def test_one_document_of_each_group_stays(spark):
    words = "one text of quite a few words that stand in no other text of this small table at all"
    other = "another text with words of its own so that no fingerprint of it is near to the first one"
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row map<string,int>"
    rows = [(4, words), (2, words.upper()), (2, words.upper()), (3, other), (4, other), (9, None), (8, ""), (None, words), (None, words)]
    table = spark.createDataFrame([(i, t, "en", "s", 1, {"a": 1}) for i, t in rows], schema)
    kept = corpus_pipeline.drop_near_duplicates(spark, table, SF_DIR)
    assert kept.columns == table.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted([(2, words.upper()), (3, other), (8, ""), (0, words)])
