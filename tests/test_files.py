import pytest
from pyspark.sql import functions as F

from lexirank.sources import sinks, tables


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_rows_that_do_not_fit_are_errors(spark, tmp_path):
    for name, row in (("long", "1,a,N,x"), ("short", "1,a")):
        with pytest.raises(Exception, match="does not fit"):
            tables.read_csv(spark, put(tmp_path / f"{name}.csv", f"word_id,word,type\n{row}\n")).collect()


def test_base_keeps_repetitions_and_checks_cells(spark, tmp_path):
    good = put(tmp_path / "b.csv", 'word_id,word,type\n2,"a ""q""\nb",N\n\n2,c,N\n')
    assert sorted(r.word for r in tables.read_base(spark, good).collect()) == ['a "q"\nb', "c"]
    with pytest.raises(Exception, match="word_id is no long"):
        tables.read_base(spark, put(tmp_path / "c.csv", "word_id,word,type\nx,a,N\n")).collect()
    with pytest.raises(Exception, match="word is no text"):
        tables.read_base(spark, put(tmp_path / "d.csv", 'word_id,word,type\n1,"  ",N\n')).collect()


def test_run_last_wins_and_ranges(spark, tmp_path):
    head = "word_id,word,type,rarity_level,confidence\n"
    run = tables.read_run(spark, put(tmp_path / "r.csv", head + "1,om,N,3,0.3\n1,om,N,1,0.9\n")).collect()
    assert [(r.rarity_level, r.confidence) for r in run] == [(1, 0.9)]
    assert tables.read_run(spark, str(tmp_path / "none.csv")).count() == 0
    for row in ("1,om,N,6,0.3", "1,om,N,3,1.5"):
        with pytest.raises(Exception):
            tables.read_run(spark, put(tmp_path / "bad.csv", head + row + "\n")).collect()


def test_final_level_comes_first(spark, tmp_path):
    path = put(tmp_path / "f.csv", "word_id,word,type,rarity_level,final_level\n1,om,N,5,1\n2,casă,N,4,2\n")
    assert {r.word_id: r.level for r in tables.read_final_levels(spark, path).collect()} == {1: 1, 2: 2}


def test_csv_can_replace_what_it_reads(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, 'q"x\ny'), (2, "")], "word_id int, word string")
    sinks.write_csv(df, path)
    sinks.write_csv(tables.read_csv(spark, path).withColumn("word", F.concat("word", F.lit("!"))), path)
    assert sorted((r.word_id, r.word) for r in tables.read_csv(spark, path).collect()) == [("1", 'q"x\ny!'), ("2", "!")]


def test_appended_runs_keep_the_first_columns(spark, tmp_path):
    path = str(tmp_path / "run")
    sinks.append_run(spark.createDataFrame([(1, "a")], "word_id long, tag string"), path, 1)
    sinks.append_run(spark.createDataFrame([(2, "x")], "word_id long, other string"), path, 2)
    assert sorted((r.word_id, r.tag, r.seq) for r in spark.read.parquet(path).collect()) == [(1, "a", 1), (2, None, 2)]


def test_state_and_lock(tmp_path):
    path = str(tmp_path / "s.tsv")
    sinks.write_tsv_state(path, {"last_completed_step": "3", "current_csv": "x"})
    assert sinks.read_tsv_state(path)["last_completed_step"] == "3"
    (tmp_path / "t.tsv").write_text("no tab\n")
    with pytest.raises(ValueError):
        sinks.read_tsv_state(str(tmp_path / "t.tsv"))
    with sinks.output_lock(path):
        with pytest.raises(RuntimeError):
            with sinks.output_lock(path):
                pass


def test_a_stopped_replace_loses_nothing(spark, tmp_path):
    table = str(tmp_path / "latest")
    write = lambda *rows: sinks.write_csv(spark.createDataFrame(rows, "word_id int, level int"), table)
    write((1, 2), (2, 3))
    (tmp_path / "latest").rename(tmp_path / "latest.old-abc")  # as between the two renames
    sinks.recover(spark, table)
    assert sorted(r.level for r in tables.read_csv(spark, table).collect()) == ["2", "3"]
    write((1, 2), (2, 4))
    (tmp_path / "latest.old-def").mkdir()  # as after them
    sinks.recover(spark, table)
    assert not [p for p in tmp_path.iterdir() if ".old-" in p.name] and tables.read_csv(spark, table).count() == 2


def test_words_of_a_database(spark, tmp_path):
    """An embedded database: ids far from zero are dealt over the ranges that there are."""
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    options = {"url": url, "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = spark.range(5_000_000_000, 5_000_000_400).selectExpr("id as ID", "'w' as WORD", "'N' as TYPE", "3 as RARITY_LEVEL")
    rows.write.format("jdbc").options(dbtable="words", **options).save()
    got = tables.read_words_table(spark, options, ("id", "rarity_level"), partitions=4)
    sizes = [len(x) for x in got.rdd.glom().collect()]
    assert sorted(got.columns) == ["rarity_level", "word_id"] and sum(sizes) == 400 and max(sizes) <= 110


@pytest.mark.parametrize("n,far", [(1000, 2**40), (3, 2**40), (0, None)])
def test_words_with_gaps_are_read_in_even_parts(spark, tmp_path, n, far):
    """Ids from 1 on and one very far from them: parts hold as many rows each; few or no rows are read as well."""
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    options = {"url": url, "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = spark.range(n).selectExpr("id + 1 as ID").union(spark.createDataFrame([(far,)] if far else [], "ID long"))
    rows.selectExpr("ID", "'w' as WORD", "'N' as TYPE").write.format("jdbc").options(dbtable="words", **options).save()
    got = tables.read_words_table(spark, options, partitions=8)
    sizes = [len(x) for x in got.rdd.glom().collect()]
    assert sum(sizes) == n + bool(far) and max(sizes) <= n // 8 + 2
    assert {r.word_id for r in got.collect()} == {*range(1, n + 1), *([far] if far else [])}
