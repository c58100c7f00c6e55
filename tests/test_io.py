import bz2
import gzip
import os
from urllib.parse import unquote

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from wordloom.operators import samples, sharding
from wordloom.session import checkpoint_dir, spread, stage_table, staging
from wordloom.sources import readers, versions, writers

BOM = b"\xef\xbb\xbf"


def offsets_of(content):
    """Byte offset and text of each line, by hand."""
    found, start = {}, 0
    for raw in content.splitlines(keepends=True) if content else []:
        text = raw.rstrip(b"\r\n")
        found[start] = (text[3:] if start == 0 and text.startswith(BOM) else text).decode()
        start += len(raw)
    return found


@pytest.mark.parametrize("split_bytes", [400, 1 << 27])
def test_offsets(spark, tmp_path, split_bytes):
    long = "".join(f"line {i} é™\n" for i in range(200)).encode()
    contents = {
        "shard_0": BOM + b"first\r\n\r\nthird \tx\r\nlast without end",
        "shard_1": long,
        "shard_2": BOM + long,
        "shard_3": b"one\n",
        "shard_4": b"",
        "shard_5": b"old\rstyle\r\r\nmixed\r\n\r\rend\r",
        "shard_6": b"\r\n\r\n",
        "other": b"not read\n",
    }
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        rows = readers.text_files_with_offset(spark, str(tmp_path), "shard_").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    found = {}
    for row in rows:
        found.setdefault(os.path.basename(row.file), {})[row.offset] = row.line
    assert found == {n: offsets_of(c) for n, c in contents.items() if n.startswith("shard_") and c}


def test_plain_lines_and_prefix(spark, tmp_path):
    (tmp_path / "shard_0").write_bytes(BOM + b"a\r\n\r\nb c ")
    (tmp_path / "noise").write_text("no")
    assert sorted(r.line for r in readers.text_files(spark, str(tmp_path), "shard_").collect()) == ["", "a", "b c "]
    assert readers.text_files(spark, str(tmp_path)).count() == 4


def test_missing_input(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        readers.text_files(spark, str(tmp_path / "none")).collect()
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        readers.table(spark, str(tmp_path / "none.parquet"), "x")


def test_only_asked_columns_are_read(spark):
    plan = readers.table(spark, "/root/testdata/sf0.001/documents.parquet", "doc_id", "text")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


WORDS = [("word,", 2, [1, 2]), ('say "hi"', 1, []), ("", 3, [5]), (" a ", 1, [7]), ("back\\slash", 1, [8])]


def test_csv_round_trip(spark, frame, tmp_path):
    rows = frame(WORDS, "word string, n long, token_ids array<int>")
    writers.write_table(rows, str(tmp_path / "out"), "csv")
    back = spark.read.csv(str(tmp_path / "out"), schema="word string, n long, ids string", escape='"', emptyValue="", nullValue="\0")
    expected = {(w, n, ";".join(map(str, ids))) for w, n, ids in WORDS}
    assert {(r.word or "", r.n, r.ids or "") for r in back.collect()} == expected


def test_csv_quotes_only_what_needs_it(spark, frame, tmp_path):
    rows = frame([*WORDS, ("#c", 1, [9])], "word string, n long, token_ids array<int>").select("word", "n")
    writers.write_table(rows, str(tmp_path / "out"), "csv")
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
    assert lines == sorted(['"word,",2', '"say ""hi""",1', ",3", " a ,1", "back\\slash,1", "#c,1"])


@pytest.mark.parametrize("form", ["parquet", "csv"])
def test_a_failing_write_leaves_the_old_table(spark, frame, tmp_path, form):
    path = str(tmp_path / "out")
    writers.write_table(frame([(k,) for k in range(5)], "id int"), path, form)
    bad = frame([(k,) for k in range(5)], "id int").select(F.when(F.col("id") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("int").alias("id"))
    with pytest.raises(Exception, match="no"):
        writers.write_table(bad, path, form)
    assert spark.read.format(form).load(path).count() == 5
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("out")] == ["out"]


def test_a_table_may_be_replaced_by_what_was_read_from_it(spark, frame, tmp_path):
    path = str(tmp_path / "out")
    writers.write_table(frame([(1,), (2,)], "id int"), path)
    writers.write_table(spark.read.parquet(path).where("id = 2"), path)
    assert [r.id for r in spark.read.parquet(path).collect()] == [2]


@pytest.mark.parametrize("pack, end", [(gzip.compress, ".gz"), (bz2.compress, ".bz2")])
def test_offsets_of_compressed_files_are_those_of_their_content(spark, tmp_path, pack, end):
    long = "".join(f"line {i} é\n" for i in range(300)).encode()
    contents = {"a b": BOM + b"one\r\ntwo\rthree", "plain": long, "marked": BOM + long, "empty": b"", "short": b"x\n"}
    for name, content in contents.items():
        (tmp_path / f"{name}{end}").write_bytes(pack(content))
    (tmp_path / "as it is").write_bytes(contents["marked"])
    found = {}
    for r in readers.text_files_with_offset(spark, str(tmp_path)).collect():
        found.setdefault(unquote(os.path.basename(r.file)), {})[r.offset] = r.line
    wanted = {f"{name}{end}": offsets_of(content) for name, content in contents.items() if content}
    assert found == wanted | {"as it is": offsets_of(contents["marked"])}


@pytest.mark.parametrize("failing", [0, 1])
def test_a_rename_that_fails_leaves_the_old_table(spark, frame, tmp_path, monkeypatch, failing):
    path = str(tmp_path / "out")
    writers.write_table(frame([(1,)], "id int"), path)
    calls, moved = [], writers._moved

    def fails_once(*args):
        calls.append(args)
        return len(calls) - 1 != failing and moved(*args)

    monkeypatch.setattr(writers, "_moved", fails_once)
    with pytest.raises(OSError, match="can't be moved"):
        writers.write_table(frame([(2,)], "id int"), path)
    assert len(calls) == (1, 3)[failing] and [r.id for r in spark.read.parquet(path).collect()] == [1]


def ids(table):
    return sorted(r.id for r in table.collect())


def test_versions_follow_their_commits(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.current(spark, path)
    for k in range(4):
        folder = versions.write_version(frame([(k,)], "id int"), path)
        assert versions.current(spark, path) == folder and ids(versions.read_version(spark, path)) == [k]
    assert ids(versions.read_version(spark, path, 2)) == [1]
    assert versions.roll_back(spark, path, 1) == 5 and ids(versions.read_version(spark, path)) == [0]
    assert versions.remove_old(spark, path) == 2 and ids(versions.read_version(spark, path)) == [0]
    assert sorted(versions.commits(spark, path)) == [1, 4, 5]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("version-")]) == 2


def test_the_old_version_stays_at_each_failing_step(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.write_version(frame([(1,)], "id int"), path)
    bad = frame([(2,)], "id int").select(F.raise_error(F.lit("no")).cast("int").alias("id"))
    with pytest.raises(Exception, match="no"):
        versions.write_version(bad, path)
    with monkeypatch.context() as m:
        m.setattr(versions, "_commit", lambda *args: (_ for _ in ()).throw(OSError("no commit")))
        with pytest.raises(OSError):
            versions.write_version(frame([(3,)], "id int"), path)
    (tmp_path / "t" / "_commits" / "0000000002").write_text("version-cut-o")  # a writer that died in its commit
    assert ids(versions.read_version(spark, path)) == [1]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("version-")]) == 1
    versions.write_version(frame([(4,)], "id int"), path)
    assert ids(versions.read_version(spark, path)) == [4] and sorted(versions.commits(spark, path)) == [1, 3]


def test_unreadable_lines_are_rejected_with_their_place(spark, tmp_path):
    lines = ["k1\t1;2.0", "k2\t-3.5 4e1", "", "no tab", "k\t1;x", "\t1;2", "k\t", "k\t1;;2", "k\t1\t2", "k\t1;2;3"]
    (tmp_path / "s").write_text("\n".join(lines) + "\n")
    scanned = readers.text_files_with_offset(spark, str(tmp_path))
    good, bad = samples.scan_text(scanned, 2)
    assert sorted((r.sample_key, r.n_tokens, r.vec) for r in good.collect()) == [("k1", 2, [1.0, 2.0]), ("k2", 2, [-3.5, 40.0])]
    rows = sorted(bad.collect(), key=lambda r: r.offset)
    assert [r.line for r in rows] == lines[2:] and [r.offset for r in rows] == [sum(len(x) + 1 for x in lines[:k]) for k in range(2, len(lines))]
    assert [r.reason for r in rows] == ["not a key and a vector"] * 2 + ["not a number", "no key", "no vector", "not a number", "not a key and a vector", "wrong length"]
    assert samples.scan_text(scanned)[1].count() == 7


def test_shards_of_equal_bytes(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 7)
    sizes = [3, 0, 50, 1, 1, 1, 9, 0, 0, 120, 4, 4, 4, None, 30, 2, 2, 8, 16, 5] * 4
    rows = spark.createDataFrame(list(enumerate(sizes)), "id long, n int").repartition(5)
    total, before, wanted = sum(s or 0 for s in sizes), 0, {}
    for k, s in enumerate(sizes):
        wanted[k] = min(2, before * 3 // total)
        before += s or 0
    made = sharding.shard_by_bytes(rows, ["id"], F.col("n"), 3)
    assert made.columns == ["id", "n", "shard_id"] and {r.id: r.shard_id for r in made.collect()} == wanted
    held = [sum(sizes[k] or 0 for k, s in wanted.items() if s == shard) for shard in range(3)]
    assert all(abs(h - total / 3) <= 120 for h in held)
    assert [r.shard_id for r in sharding.shard_by_bytes(rows.where("id = 1"), ["id"], F.col("n"), 3).collect()] == [0]
    assert sharding.shard_by_bytes(rows.limit(0), ["id"], F.col("n"), 3).count() == 0


def test_offsets_do_not_depend_on_the_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "MAX_SPLIT_BYTES", 0)
    (tmp_path / "a").write_bytes(BOM + b"one\ntwo\r\nthree")
    rows = {r.offset: r.line for r in readers.text_files_with_offset(spark, str(tmp_path)).collect()}
    assert rows == offsets_of(BOM + b"one\ntwo\r\nthree")


def test_tsv_parquet_and_overwrite(spark, frame, tmp_path):
    path = str(tmp_path / "out")
    rows = frame([("k1", [1.0, 2.5])], "key string, vec array<float>")
    writers.write_table(rows, path, "tsv")
    assert spark.read.text(path).first()[0] == "k1\t1.0;2.5"
    writers.write_table(rows, path)
    assert spark.read.parquet(path).first() == rows.first()
    writers.write_table(rows.where("false"), path)
    assert spark.read.parquet(path).isEmpty()
    with pytest.raises(ValueError):
        writers.write_table(rows, path, "xml")


@pytest.mark.parametrize("single, files", [(True, 1), (False, None)])
def test_publish_in_order(spark, tmp_path, single, files):
    path = tmp_path / "out"
    rows = spark.range(0, 500, 1, 7).select((499 - F.col("id")).alias("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.publish(rows, str(path), ["id"], single_file=single)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    assert len(parts) == files if files else len(parts) > 1
    read = [r.id for p in parts for r in spark.read.parquet(str(path / p)).collect()]
    assert read == list(range(500))


def test_stage_table_and_checkpoint_folder(spark, frame):
    rows = frame([(1, "a"), (2, "b")], "shard_id int, w string")
    staged = stage_table(rows, "t", ["shard_id"])
    assert sorted(map(tuple, staged.select("shard_id", "w").collect())) == [(1, "a"), (2, "b")]
    assert spark.conf.get("spark.checkpoint.dir") in checkpoint_dir(spark)


def test_only_small_scans_are_spread(spark):
    assert spread(spark.range(0, 10, 1, 1), "id").rdd.getNumPartitions() > 1
    large = spark.range(0, 10, 1, 64)
    assert spread(large, "id") is large


def test_staged_tables_go_with_their_work(spark, frame):
    rows = frame([(1,)], "id int")
    before = set(os.listdir(checkpoint_dir(spark).removeprefix("file:")))
    with staging(spark):
        assert stage_table(rows, "inside").count() == 1
    assert set(os.listdir(checkpoint_dir(spark).removeprefix("file:"))) == before
