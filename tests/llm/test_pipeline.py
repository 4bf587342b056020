import regex
from pyspark.sql import functions as F

import corpus_pipeline
from nightledger.llm.common import written
from tests.llm import test_jaccard_join, test_secret_models, test_winnow
from tests.llm.fixtures import PROSE, documents, odd_rows


def bench(spark, tmp_path, items):
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def rows_of(df):
    return sorted((str(r.doc_id), str(r.text)) for r in df.select("doc_id", "text").collect())


def test_language_goes_only_without_one(spark):
    docs = documents(spark, [*odd_rows(), (50, "1 2 3"), (51, "12.5 % !!")])
    out = corpus_pipeline.language(spark, docs, "")
    assert out.schema == docs.schema
    want = [r for r in rows_of(docs) if regex.search(r"\p{L}", r[1]) and r[1] != "None"]
    assert rows_of(out) == want


def test_least_score_follows_the_number_of_languages():
    for k in (2, 4, 100):
        assert 1 / k < corpus_pipeline.least_score(k) < 1.5 / k
    assert corpus_pipeline.least_score(1) <= 1


def test_nothing_goes_where_no_language_is_learned(spark):
    docs = documents(spark, [(1, PROSE), (2, "one"), (3, None)]).withColumn("lang", F.lit(None).cast("string"))
    assert rows_of(corpus_pipeline.language(spark, docs, "")) == rows_of(docs)


def test_one_of_each_group_stays(spark):
    docs = documents(spark, odd_rows())
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    assert out.schema == docs.schema
    kept = rows_of(out)
    # null, 1, 2 and 2 again are copies; of id 6 the menu stays alone, and the other text is a near copy
    assert [k for k in kept if k[1].startswith("The harbour")] == [("None", PROSE)]
    assert len(kept) == len(set(kept))
    gone = {i for i, t in rows_of(docs)} - {i for i, _ in kept}
    assert gone == {"1", "2"}
    assert test_jaccard_join.got(spark, [(i if i != "None" else None, t) for i, t in [(int(a) if a != "None" else None, b) for a, b in kept if b != "None"]])


def test_only_contaminated_documents_go(spark, tmp_path):
    items = [(1, PROSE[30:200]), (2, "alpha beta gamma")]
    docs = documents(spark, [*odd_rows(), (60, "x Alpha, beta; GAMMA y")])
    out = corpus_pipeline.decontamination(spark, docs, bench(spark, tmp_path, items))
    assert out.schema == docs.schema
    want = sorted((str(i), str(t)) for i, t in [*odd_rows(), (60, "x Alpha, beta; GAMMA y")] if not test_winnow.brute(t, items)[-1])
    assert rows_of(out) == want


def test_secrets_are_replaced(spark):
    docs = documents(spark, odd_rows())
    out = corpus_pipeline.secrets(spark, docs, "")
    assert [f.name for f in out.schema] == [f.name for f in docs.schema]
    for r in out.collect():
        assert not test_secret_models.brute(r.text)
        assert r.n_chars == (None if r.text is None else len(r.text))
    assert {i for i, _ in rows_of(out)} == {i for i, _ in rows_of(docs)}
    plain = [r for r in rows_of(docs) if not test_secret_models.brute(r[1])]
    assert set(plain) <= set(rows_of(out))


def test_run_applies_the_stages_in_turn(spark, tmp_path):
    folder = bench(spark, tmp_path, [(1, "one two three four five six seven eight nine ten eleven")])
    rows = [(i, f"{PROSE} {i} " + " ".join(f"w{i}x{j}" for j in range(30 * i))) for i in range(12)] + [(90, None), (91, "5 5"), (92, "one two three four five six seven eight nine ten eleven")]
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, folder), "s")
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "k_id", "h", "length"]
    got = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in got.collect()} == {r.doc_id for r in docs.collect()}
    assert 90 not in {r.doc_id for r in got.collect()} and 92 not in {r.doc_id for r in got.collect()}


def test_empty_tables(spark, tmp_path):
    folder = bench(spark, tmp_path, [])
    documents(spark, []).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
