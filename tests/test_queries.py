import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import difference, twin

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return twin(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_its_sql_twin(spark, sql, name):
    made = queries()[name](spark, SF).toPandas()
    assert difference(made, sql.execute(oracle_sql()[name]).df()) == ""
    assert len(made) > 0


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_has_rows(spark, name):
    assert not queries()[name](spark, SF).isEmpty()


def test_entry(spark):
    rows = entry(spark).collect()
    assert [r.n for r in rows] == sorted((r.n for r in rows), reverse=True)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["text_lines", "word_explode", "sentence_split", "sentence_index", "empty_sentences", "sliding_windows_bytes"])
def test_map_only_queries_shuffle_nothing_but_a_small_scan(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    assert plan.count("Exchange") == plan.count("REPARTITION_BY_NUM") == 1


@pytest.mark.parametrize("name", ["sentence_token_ids", "reject_bad_tokens", "vector_add", "embedding_merge", "neighbour_top3"])
def test_no_cross_join(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_word_count_sums_before_the_shuffle(spark):
    plan = plan_of(queries()["word_count"](spark, SF))
    assert "partial_count" in plan


@pytest.mark.parametrize("name", ["encode_bytes", "decode_bytes", "sliding_windows_bytes"])
def test_bytes_need_no_python(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    assert "Python" not in plan and "Arrow" not in plan


def test_repeats_collapse_without_a_sort(spark):
    plan = plan_of(queries()["samples_dedup"](spark, SF))
    assert "SortAggregate" not in plan


def test_good_and_rejected_words_are_all_words(spark):
    kinds = ("accept_good_tokens", "reject_bad_tokens", "word_count")
    good, bad, all_ = (queries()[name](spark, SF).count() for name in kinds)
    assert good + bad == all_
