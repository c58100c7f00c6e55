import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_decontam import expected as leaks_of
from tests.llm.test_jaccard_join import expected as components_of
from tests.llm.test_quality_rules import base
from wordloom.llm import mixing, pii_crf, quality_rules

SF = "/root/testdata/sf0.001"


def prose(k):
    return "".join(" ".join(f"t{k}s{j}w{i}" for i in range(12)) + ". " for j in range(8))


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage made of the smallest table, and what went into it."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.toPandas()]
    for _, stage in corpus_pipeline.STAGES:
        frame = spark.createDataFrame(out[-1], docs.schema)
        out.append(stage(spark, frame, SF).toPandas())
    return out


def test_stages_are_the_five_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "personal data", "mixing"]


def test_quality_keeps_what_the_rules_keep(spark, stages):
    before, after = stages[:2]
    judged = quality_rules.quality_rules(spark.createDataFrame(before[["doc_id", "text"]])).toPandas().set_index("doc_id")
    assert set(after.doc_id) == set(judged[judged.kept].index)
    assert not any(base(t)[5] for t in before.set_index("doc_id").text[after.doc_id])
    assert list(after.set_index("doc_id").text) == list(judged.clean_text[after.doc_id])
    assert (after.n_chars == after.text.str.len()).all()


def test_one_document_of_each_group_stays(stages):
    before, after = stages[1:3]
    found = components_of(list(zip(before.doc_id.tolist(), before.text, strict=True)), 5, 80)
    assert sorted(after.doc_id) == sorted({c for _, _, c in found})
    kept = before.set_index("doc_id").loc[after.doc_id].reset_index()
    assert kept[list(after.columns)].equals(after.reset_index(drop=True))


def test_leaks_go_and_clean_documents_stay(spark, stages):
    before, after = stages[2:4]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    leaks = {d for d, *_ in leaks_of(list(zip(before.doc_id.tolist(), before.text, strict=True)), items)}
    assert set(after.doc_id) == set(before.doc_id) - leaks


def test_personal_data_is_masked_and_all_documents_stay(spark, stages):
    before, after = stages[3:5]
    assert sorted(after.doc_id) == sorted(before.doc_id)
    model = pii_crf.train(pii_crf.labelled_examples(spark))
    texts = before.set_index("doc_id").text[after.doc_id].tolist()
    assert after.text.tolist() == [pii_crf.mask(t, s) for t, s in zip(texts, pii_crf.find_spans(texts, model), strict=True)]
    assert not any(pii_crf.base_spans(t) for t in after.text)


def test_the_mix_holds_all_documents(stages):
    before, after = stages[4:6]
    assert sorted(after.doc_id) == sorted(before.doc_id)
    for _, group in after.groupby("source"):
        assert abs(group.taken.sum() - group.target.iloc[0]) <= max(1, 0.01 * group.target.iloc[0])


def test_run_equals_the_stages(spark, stages):
    made = corpus_pipeline.run(spark, SF).toPandas()
    columns = sorted(stages[-1].columns)
    assert made[columns].sort_values("doc_id").reset_index(drop=True).equals(stages[-1][columns].sort_values("doc_id").reset_index(drop=True))


@pytest.mark.parametrize("k", range(5))
def test_odd_rows_and_empty_tables(spark, k):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, prose(3), "en", "s", 1), (3, prose(3), "en", "s", 1), (4, prose(3), "en", None, 1), (5, prose(5) + "\n" + "long words here. " * 20000, "en", "s", 1), (None, prose(6), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("size", F.lit(1))
    stage = corpus_pipeline.STAGES[k][1]
    made = stage(spark, docs, SF)
    if k < 4:
        assert made.columns == list(corpus_pipeline.COLUMNS)
    ids = sorted((r.doc_id for r in made.collect()), key=str)
    assert ids == {0: [3, 3, 4, None], 1: [1, 2, 3, 5, None], 2: [1, 2, 3, 3, 4, 5, None], 3: [1, 2, 3, 3, 4, 5, None], 4: [1, 2, 3, 3, 4, 5, None]}[k]
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_rows_of_one_id_or_none_are_judged_by_their_own_texts(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [
        (1, prose(1)), (1, prose(2)), (1, prose(2)), (None, prose(3)), (None, prose(4)), (None, prose(4)), (7, prose(4)), (8, prose(8)), (8, prose(8)),
        (9, prose(9) + item), (9, prose(10)), (None, prose(11) + item), (None, prose(12)),
    ]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    once = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()), key=str)
    wanted = [*rows[:2], rows[3], (7, prose(4)), (8, prose(8)), *rows[9:]]
    assert once == sorted(wanted, key=str)
    clean = sorted(((r.doc_id, r.text) for r in corpus_pipeline.decontaminate(spark, docs, SF).collect()), key=str)
    assert clean == sorted((r for r in rows if item not in r[1]), key=str)


def test_the_last_stage_names_its_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "s")], "doc_id bigint, text string, source string")
    assert mixing.mix(docs).columns == ["doc_id", "source", "size", "source_size", "target", "repeats", "taken"]
