"""Levels into a database from the executors: staged side by side under a run's token, taken over in one transaction.

Each task stages its rows under its attempt's number; the job's result tells which attempts count. The take-over records
the token with the change itself, so a run that was stopped anywhere is begun again with the same token, and levels
change once. No rows pass through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import closing

import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows of one insert.
CHUNK = 5000

# The table that is written to, and those that uploads keep beside it.
TABLES = (
    "CREATE TABLE IF NOT EXISTS words_staged (token VARCHAR(64), part INTEGER, attempt BIGINT, word_id BIGINT, rarity_level INTEGER)",
    "CREATE TABLE IF NOT EXISTS words_attempts (token VARCHAR(64), part INTEGER, attempt BIGINT, PRIMARY KEY (token, part))",
    "CREATE TABLE IF NOT EXISTS words_uploads (token VARCHAR(64) PRIMARY KEY, staged_rows BIGINT)",
)
TAKE_OVER = (
    "UPDATE words SET rarity_level = s.rarity_level FROM words_staged s "
    "JOIN words_attempts a ON a.token = s.token AND a.part = s.part AND a.attempt = s.attempt WHERE s.token = ? AND words.id = s.word_id"
)


class Database:
    """How to connect (a function that can be sent to executors, giving a DB-API connection), and the driver's mark of a parameter."""

    def __init__(self, connect: Callable, mark: str = "%s") -> None:
        self.connect, self.mark = connect, mark

    def sql(self, text: str) -> str:
        return text.replace("?", self.mark)

    def run(self, connection, text: str, values: tuple = ()) -> list:
        with closing(connection.cursor()) as cursor:
            cursor.execute(self.sql(text), values)
            return cursor.fetchall() if cursor.description else []


def _stage(database: Database, token: str):
    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        part, attempt, n = (task.partitionId(), task.taskAttemptId(), 0) if task else (0, 0, 0)
        insert = database.sql("INSERT INTO words_staged (token, part, attempt, word_id, rarity_level) VALUES (?, ?, ?, ?, ?)")
        connection = None
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, CHUNK):
                    rows = batch.slice(at, CHUNK)
                    connection = connection or database.connect()
                    with closing(connection.cursor()) as cursor:
                        cursor.executemany(insert, [(token, part, attempt, i, level) for i, level in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist())])
                    connection.commit()
                    n += rows.num_rows
        finally:
            if connection is not None:
                connection.close()
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([attempt], pa.int64()), pa.array([n], pa.int64())], names=["part", "attempt", "n"])

    return stage


def uploaded(database: Database, token: str) -> int | None:
    """How many rows the upload of a token staged, if it took place."""
    with closing(database.connect()) as connection:
        for statement in TABLES:
            database.run(connection, statement)
        found = database.run(connection, "SELECT staged_rows FROM words_uploads WHERE token = ?", (token,))
        connection.commit()
    return found[0][0] if found else None


def upload_words(rows: DataFrame, database: Database, token: str) -> int:
    """Levels of rows (word_id, rarity_level; one for each id) into the table words; the number of rows.

    An upload whose token the database knows has taken place: nothing is staged or changed. What earlier attempts
    staged under the token doesn't count, and goes with the rest at the end. Ids that the table lacks change nothing.
    """
    n = uploaded(database, token)
    if n is None:
        staged = rows.select("word_id", "rarity_level").mapInArrow(_stage(database, token), "part int, attempt long, n long").collect()  # one for each task
        n = sum(r.n for r in staged)
        with closing(database.connect()) as connection:
            try:
                database.run(connection, "INSERT INTO words_uploads (token, staged_rows) VALUES (?, ?)", (token, n))  # of two runs with a token one waits, and fails
                database.run(connection, "DELETE FROM words_attempts WHERE token = ?", (token,))
                for r in staged:
                    database.run(connection, "INSERT INTO words_attempts (token, part, attempt) VALUES (?, ?, ?)", (token, r.part, r.attempt))
                database.run(connection, TAKE_OVER, (token,))
                connection.commit()
            except BaseException:
                connection.rollback()
                raise
    clear(database, token)
    return n


def clear(database: Database, token: str) -> None:
    """Delete what an upload that took place had staged."""
    with closing(database.connect()) as connection:
        for name in ("words_staged", "words_attempts"):
            database.run(connection, f"DELETE FROM {name} WHERE token = ?", (token,))
        connection.commit()
