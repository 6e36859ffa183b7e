"""Jobs drop what they store, and keep what they return."""

import os

import pytest

from profilematch import fit_index, search
from profilematch.operators.term_layout import lay_out
from profilematch.session import drop_job, job, materialize, materialize_by, shared_folder


def left(spark):
    folder = os.path.join(shared_folder(spark), "profilematch")
    return set(os.listdir(folder) if os.path.exists(folder) else []), {t.name for t in spark.catalog.listTables()}


@pytest.fixture
def before(spark):
    return left(spark)


def test_search_in_a_job_leaves_its_result_only(spark, corpus, before):
    asked = spark.createDataFrame([(1, "java cloud"), (2, "python")], "request_id long, query_text string")
    plain = sorted(map(tuple, search(fit_index(corpus, "id", "tokens", "log2").stored(), asked, 3, "A").collect()))
    seen = left(spark)
    with job(spark) as running:
        index = fit_index(corpus, "id", "tokens", "log2").stored()
        lay_out(index)
        assert left(spark)[1] - seen[1] and os.path.isdir(os.path.join(shared_folder(spark), "profilematch", running.name))
        found = running.keep(search(index, asked, 3, "A"))
    folders, tables = left(spark)
    assert tables == seen[1]
    assert [f.rsplit("-", 1)[0] for f in folders - seen[0]] == ["result"]
    assert sorted(map(tuple, found.collect())) == plain


def test_failure_and_nesting(spark, before):
    with pytest.raises(ZeroDivisionError), job(spark):
        materialize_by(spark.range(5), "step", "id")
        1 / 0
    assert left(spark) == before
    with job(spark):
        with job(spark) as inner:
            materialize(spark.range(9), "step")
            kept = inner.keep(spark.range(3))
        assert kept.count() == 3
    assert left(spark) == before


def test_steps_of_a_lost_driver(spark, before):
    running = job(spark)
    name = running.__enter__().name
    materialize_by(spark.range(5), "step", "id")
    assert left(spark) != before
    drop_job(spark, name)
    assert left(spark) == before
    running.__exit__(None, None, None)  # dropping again does nothing
    for wrong in ("", "*", "job_1", "../x"):
        with pytest.raises(ValueError):
            drop_job(spark, wrong)
