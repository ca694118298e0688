import pytest

from ledgerfold.plans import queries


@pytest.fixture
def tables(spark, tmp_path):
    rows = [(n, f"the text of the number {n} and more", "en", f"src{n % 3}", 30) for n in range(40)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_stored_labels_are_not_made_again(spark, tables, monkeypatch):
    """The copies are planned by the classifications that the other figures use."""

    def refuse(*_):
        raise AssertionError("classified a second time")

    monkeypatch.setattr(queries, "_labelled", refuse)
    checks = {r.check: r for r in queries.recon_checks(spark, tables).collect()}
    assert {r.ok for r in checks.values()} == {"match"}
    assert checks["times kept = times compared"].left_value == 3 * 41


def test_one_classification_serves_plan_and_check(spark, tables, monkeypatch):
    made, labelled = [], queries._labelled
    monkeypatch.setattr(queries, "_labelled", lambda *given: made.append(1) or labelled(*given))
    verdicts = queries.crossref_verify(spark, tables)
    assert len(made) == 1
    assert [tuple(r) for r in verdicts.groupBy("verdict").count().collect()] == [("ok", 3 * 41)]
