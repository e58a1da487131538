"""Every registered query against the same answer in SQL, straight from the source tables."""

import pytest

from stemmata import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, sf_dir, duck, same, name):
    same(catalogue.QUERIES[name](spark, sf_dir), duck.execute(catalogue.ORACLE_SQL[name]))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_vocabulary_takes_files_once_and_filters_push_down(spark, sf_dir):
    plan = catalogue.QUERIES["vocab_genre_filter"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert "lang" in plan.split("ReadSchema")[-1] and "n_chars" not in plan.split("ReadSchema")[-1]


def test_reports_make_facts_once(spark, sf_dir):
    plan = catalogue.QUERIES["reference_report"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
