import functools
import sqlite3

import pytest

from lexirank.sources import uploads
from lexirank.sources.uploads import Database, upload_words, uploaded


@pytest.fixture
def words(tmp_path):
    """A table of words that logs each change of a level."""
    path = str(tmp_path / "words.db")
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE words (id INTEGER PRIMARY KEY, rarity_level INTEGER)")
        c.execute("CREATE TABLE changes (id INTEGER, level INTEGER)")
        c.execute("CREATE TRIGGER logged AFTER UPDATE ON words BEGIN INSERT INTO changes VALUES (new.id, new.rarity_level); END")
        c.executemany("INSERT INTO words VALUES (?, 5)", [(i,) for i in range(1000)])
    return path


def ask(path, sql):
    with sqlite3.connect(path) as c:
        return c.execute(sql).fetchall()


class Stops(sqlite3.Connection):
    """A connection that ends the run at a statement, the first time a file tells it to."""

    def cursor(self, *a):
        return super().cursor(Stopping)


class Stopping(sqlite3.Cursor):
    def execute(self, sql, *a):
        out = super().execute(sql, *a)
        self.stop(sql)
        return out

    def executemany(self, sql, *a):
        out = super().executemany(sql, *a)
        self.stop(sql)
        return out

    def stop(self, sql):
        import os

        path = self.connection.execute("PRAGMA database_list").fetchone()[2] + ".stop"
        if os.path.exists(path) and sql.startswith(open(path).read()):
            os.rename(path, path + "ped")
            raise RuntimeError("stopped here")


@pytest.fixture
def levels(spark):
    return spark.createDataFrame([(i, i % 5 + 1) for i in range(500)] + [(9999, 1)], "word_id long, rarity_level int").repartition(5)


def test_levels_are_staged_by_tasks_and_change_once(words, levels):
    database = Database(functools.partial(sqlite3.connect, words, timeout=60), "?")
    assert uploaded(database, "t1") is None
    assert upload_words(levels, database, "t1") == 501
    assert dict(ask(words, "SELECT id, rarity_level FROM words")) == {i: i % 5 + 1 if i < 500 else 5 for i in range(1000)}
    assert upload_words(levels, database, "t1") == 501 == uploaded(database, "t1")
    assert len(ask(words, "SELECT * FROM changes")) == 500
    assert ask(words, "SELECT count(*) FROM words_staged") == [(0,)]
    assert upload_words(levels.limit(0), database, "t2") == 0
    assert upload_words(levels.filter("word_id = 3").selectExpr("word_id", "2 as rarity_level"), database, "t3") == 1
    assert ask(words, "SELECT rarity_level FROM words WHERE id = 3") == [(2,)]


@pytest.mark.parametrize("at", ["INSERT INTO words_staged", "INSERT INTO words_uploads", "INSERT INTO words_attempts", "UPDATE words", "DELETE FROM words_staged"])
def test_a_run_stopped_anywhere_changes_levels_once(words, levels, tmp_path, at):
    """While rows are staged, in the take-over before and after the change, and after its commit."""
    database = Database(functools.partial(sqlite3.connect, words, timeout=60, factory=Stops), "?")
    (tmp_path / "words.db.stop").write_text(at)
    with pytest.raises(Exception, match="stopped here"):
        upload_words(levels, database, "t")
    assert (tmp_path / "words.db.stopped").exists()
    before = len(ask(words, "SELECT * FROM changes"))
    assert before == (500 if at.startswith("DELETE") else 0)
    assert upload_words(levels, database, "t") == 501
    assert len(ask(words, "SELECT * FROM changes")) == 500
    assert dict(ask(words, "SELECT id, rarity_level FROM words WHERE id < 500")) == {i: i % 5 + 1 for i in range(500)}
    assert ask(words, "SELECT (SELECT count(*) FROM words_staged) + (SELECT count(*) FROM words_attempts)") == [(0,)]


def test_rows_of_attempts_that_do_not_count_are_not_taken(words, levels):
    database = Database(functools.partial(sqlite3.connect, words, timeout=60), "?")
    uploaded(database, "t")
    with sqlite3.connect(words) as c:
        c.executemany("INSERT INTO words_staged VALUES ('t', ?, 77, ?, 4)", [(p, i) for p in range(5) for i in range(1000)])
    upload_words(levels, database, "t")
    assert dict(ask(words, "SELECT id, rarity_level FROM words")) == {i: i % 5 + 1 if i < 500 else 5 for i in range(1000)}
    assert "?" not in Database(None).sql(uploads.TAKE_OVER)
