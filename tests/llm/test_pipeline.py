import corpus_pipeline
import pyarrow as pa
import pytest
from cases import clashing, documents, empty, words

from clicksieve.llm import language_id
from clicksieve.llm.common import table
from clicksieve.session import BATCH_SETTINGS

DOCUMENT_STAGES = corpus_pipeline.STAGES[:-1]


@pytest.mark.parametrize("name, stage", DOCUMENT_STAGES, ids=[n for n, _ in DOCUMENT_STAGES])
def test_stages_return_the_columns_of_documents(spark, data, name, stage):
    for docs in (documents(spark), clashing(spark), empty(spark)):
        kept = stage(spark, docs, data("0.001"))
        assert kept.columns == docs.columns
        assert kept.count() <= 2 * docs.count()


def test_last_stage(spark, data):
    _, stage = corpus_pipeline.STAGES[-1]
    assert stage(spark, empty(spark), data("0.001")).count() == 0
    rows = stage(spark, clashing(spark), data("0.001")).collect()
    assert len(rows) == documents(spark).count()
    assert all(r["n_tokens"] == len(r["ids"]) for r in rows)


def test_stages_against_plain_versions(spark, data):
    """Stage by stage on real documents: what goes, and what is left alone."""
    from test_personal_data import plain_base
    from test_shingle_join import plain_components

    folder = data("0.001")
    docs = table(spark, folder, "documents")
    first = corpus_pipeline.known_language(spark, docs, folder)
    all_ids, kept = {r["doc_id"] for r in docs.collect()}, {r["doc_id"]: r for r in first.collect()}
    unclear = {r["doc_id"] for r in language_id.identify(docs).where(f"lang_pred = 'und' OR score < {corpus_pipeline.LEAST_SCORE}").collect()}
    assert set(kept) == all_ids - unclear and len(unclear) <= 2
    second = corpus_pipeline.one_of_each_group(spark, first, folder)
    found = plain_components([(d, r["text"]) for d, r in kept.items()])
    assert {r["doc_id"] for r in second.collect()} == {d for d, c in found.items() if d == c}
    third = {r["doc_id"]: r["text"] for r in corpus_pipeline.masked(spark, second, folder).collect()}
    for row in second.collect():
        if not plain_base(row["text"]):
            assert third[row["doc_id"]] == row["text"]
        else:
            assert not plain_base(third[row["doc_id"]])
    fourth = corpus_pipeline.mixed(spark, second, folder).collect()
    total = sum(len(words(r["text"])) for r in second.collect())
    assert sum(len(words(r["text"])) for r in fourth) == pytest.approx(1.5 * total, rel=0.05)


def test_run_is_all_stages(spark, data):
    assert corpus_pipeline.run(spark, data("0.001")).columns == ["doc_id", "lang", "source", "n_tokens", "ids"]


@pytest.mark.parametrize("place", [0, 1, 4])
def test_long_texts_go_to_python_a_few_at_a_time(spark, data, place):
    for name in BATCH_SETTINGS:
        spark.conf.unset(name)
    corpus_pipeline.STAGES[place][1](spark, empty(spark), data("0.001"))

    def rows_in(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    texts = spark.range(0, 200, 1, 1).selectExpr("repeat('x', 100000) AS text")
    found = [r["n"] for r in texts.mapInArrow(rows_in, "n long").collect()]
    assert sum(found) == 200 and max(found) <= 42
