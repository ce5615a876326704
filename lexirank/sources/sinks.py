"""Sinks: CSV, JSON lines, run logs, state documents, databases; and the layout of what a run leaves."""

from __future__ import annotations

import contextlib
import fcntl
import json
import os
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CSV = {"header": "true", "quoteAll": "true", "escape": '"', "nullValue": "", "emptyValue": ""}

# Folders under the output root.
LAYOUT = ("runs", "failed_batches", "rebalance/runs", "rebalance/failed_batches", "rebalance/switched_words", "rebalance/checkpoints", "rebalance/progress")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def recover(spark: SparkSession, path: str) -> None:
    """What a replace() that was stopped left: between its two renames the old folder is put back, after them it goes.

    For writers, of whom there is one at a time: each calls it before it reads what it will replace.
    """
    place, fs = _fs(spark, path)
    if not fs.exists(place.getParent()):
        return
    aside = [x for x in fs.listStatus(place.getParent()) if x.getPath().getName().startswith(f"{place.getName()}.old-")]
    aside.sort(key=lambda x: x.getModificationTime())
    if aside and not fs.exists(place):
        fs.rename(aside.pop().getPath(), place)
    for x in aside:
        fs.delete(x.getPath(), True)


def replace(spark: SparkSession, staged: str, path: str) -> None:
    """Put a staged folder in the place of another, which is renamed away first: a reader in between finds none, and recover() puts it back."""
    recover(spark, path)
    new, fs = _fs(spark, staged)
    old = spark._jvm.org.apache.hadoop.fs.Path(path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.old-{uuid.uuid4().hex}")
    there = fs.exists(old)
    if there:
        fs.rename(old, aside)
    fs.mkdirs(old.getParent())
    if not fs.rename(new, old):
        if there:
            fs.rename(aside, old)
        raise OSError(f"cannot write {path}")
    if there:
        fs.delete(aside, True)


def write_csv(df: DataFrame, path: str) -> None:
    """All cells quoted, with a header; staged, then put in place, so that df may read what it replaces.

    A file from each task: their names follow the order of a sorted df, in which read_in_order() gives its rows back.
    """
    replace(df.sparkSession, stage_csv(df, path), path)


def stage_csv(df: DataFrame, path: str) -> str:
    """CSV files beside where they belong, for replace()."""
    staged = f"{path}.tmp-{uuid.uuid4().hex}"
    df.write.options(**_CSV).csv(staged)
    return staged


def append_run(df: DataFrame, path: str, seq: int) -> None:
    """Rows for a run's log, in its columns where it exists: unknown ones are dropped, absent ones null. seq orders appends."""
    spark = df.sparkSession
    rows = df.withColumn("seq", F.lit(seq).cast("long"))
    p, fs = _fs(spark, path)
    if fs.exists(p):
        columns = spark.read.parquet(path).schema
        rows = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in columns])
    rows.write.mode("append").parquet(path)


def append_json(df: DataFrame, path: str, key: str = "") -> None:
    """One JSON object a row, appended. With a key the rows take the place of those appended under it before, so that a step that is done again leaves none twice."""
    rows = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    if not key:
        rows.write.mode("append").text(path)
        return
    staged = f"{path}/.{key}-{uuid.uuid4().hex}"  # hidden from readers of the folder
    rows.write.text(staged)
    place, fs = _fs(df.sparkSession, path)
    new, _ = _fs(df.sparkSession, staged)
    for s in fs.listStatus(place):
        if s.getPath().getName().startswith(f"{key}-"):
            fs.delete(s.getPath(), False)
    parts = sorted(s.getPath().getName() for s in fs.listStatus(new) if s.getPath().getName().startswith("part-"))
    for n, name in enumerate(parts):
        fs.rename(df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{staged}/{name}"), df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{path}/{key}-{n:05d}.txt"))
    fs.delete(new, True)


def append_labels(df: DataFrame, path: str) -> None:
    """Review labels, confidence with six decimals, appended."""
    rows = df.withColumn("predicted_confidence", F.format_string("%.6f", F.col("predicted_confidence").cast("double")))
    rows.write.mode("append").options(header="true", escape='"').csv(path)


def layout(root: str) -> dict[str, str]:
    return {name: f"{root.rstrip('/')}/{name}" for name in LAYOUT}


def write_state(path: str, state: dict) -> None:
    """A run's state document, replaced whole. Driver-side."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(f"{path}.tmp", "w", encoding="utf-8") as f:
        json.dump(state, f, ensure_ascii=False, indent=2)
    os.replace(f"{path}.tmp", path)


def write_tsv_state(path: str, state: dict[str, str]) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(f"{path}.tmp", "w", encoding="utf-8") as f:
        f.writelines(f"{k}\t{v}\n" for k, v in state.items())
    os.replace(f"{path}.tmp", path)


def read_tsv_state(path: str, required: tuple[str, ...] = ("last_completed_step", "current_csv")) -> dict[str, str]:
    """Key and value of each line with a tab; an error if a required key is absent."""
    with open(path, encoding="utf-8") as f:
        state = dict(line.rstrip("\n").split("\t", 1) for line in f if "\t" in line)
    if missing := [k for k in required if k not in state]:
        raise ValueError(f"{path}: no {', '.join(missing)}")
    return state


@contextlib.contextmanager
def output_lock(path: str) -> Iterator[None]:
    """Only one run writes an output: an exclusive lock beside it, or an error at once."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(f"{path}.lock", "w") as f:
        try:
            fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except OSError as x:
            raise RuntimeError(f"another run writes {path}") from x
        yield
