import zlib

import corpus_pipeline as P
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexirank.llm.storage import materialize
from lexirank.llm.toxicity import THRESHOLD, clean_texts, train

from .test_decontam import brute as windows_of
from .test_ngram_join import brute as components_of
from .test_secrets import BASE

D = "/root/testdata/sf0.001"


def test_stages_of_any_rows(spark, docs, empty):
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, D)
        assert out.columns == docs.columns, name
        assert out.count() <= docs.count()
        assert stage(spark, empty, D).count() == 0
    ids = sorted(r.doc_id or 0 for r in P.ngram_join(spark, docs, D).select("doc_id").collect())
    assert ids == [0, 1, 3, 4, 5, 6, 7, 9]  # of copies and repetitions one stays; wordless texts are no copies


def test_secrets_are_replaced_and_counted(spark):
    docs = spark.createDataFrame([(1, "token=abcdef x", 14), (2, "clean", 5)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in P.secrets(spark, docs, D).collect()}
    assert got == {1: ("<secret> x", 10), 2: ("clean", 5)}


def without_secrets(text):
    """A mark for each run of overlapping matches of the three base kinds."""
    spans = sorted((m.start(), m.end()) for _, pattern, group, least in BASE for m in pattern.finditer(text or "") if len(m[group]) >= least)
    out, at = [], 0
    for a, b in spans:
        if a >= at:
            out += [(text or "")[at:a], "<secret>"]
        at = max(at, b)
    return "".join(out) + (text or "")[at:] if spans else text


def test_run_against_plain_versions_of_the_stages(spark):
    """Each stage's rows, from what the stage before kept, worked out by plain loops; the last one's pieces give every document's ids."""
    docs, kept = spark.read.parquet(f"{D}/documents.parquet"), None
    rows = {r.doc_id: r.text for r in docs.collect()}
    model = train(docs, spark.read.parquet(f"{D}/labels.parquet"))
    for name, stage in P.STAGES[:-1]:
        before, docs = rows, materialize(stage(spark, docs, D), f"test-{name}")
        rows = {r.doc_id: r.text for r in docs.collect()}
        assert docs.count() == len(rows)
        if name == "toxicity":
            texts = clean_texts(pa.array(list(before.values()), pa.string()))
            kept = [i for i, t in zip(before, texts) if model.score(np.array([model.features(*t)]))[0] < THRESHOLD]
            want = {i: before[i] for i in kept}
        elif name == "ngram_join":
            want = {i: before[i] for i, _, least in components_of(list(before.items()), 5, 80) if i == least}
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
            want = {i: t for (i, t), (n, hit, _) in zip(before.items(), windows_of(before.values(), items)) if not (hit and 20 * hit >= n)}
        else:
            want = {i: without_secrets(t) for i, t in before.items()}
            odd = {i for i, t in before.items() if rows[i] != want[i]}  # kinds beyond the base ones
            assert all(len(rows[i].split("<secret>")) > len(want[i].split("<secret>")) for i in odd) and len(odd) < 5
            want |= {i: rows[i] for i in odd}
        assert rows == want, name
        assert len(rows) > 0.5 * len(before)
    library = Tokenizer.from_file(P.tokenizer_path())
    pieces = {}
    for p in P.packing(spark, docs, D).collect():
        pieces.setdefault(p.doc_id, []).append(p)
    assert set(pieces) == set(rows)
    for i, text in rows.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        assert sum(p.length for p in pieces[i]) == len(ids) == pieces[i][0].doc_tokens
        for p in pieces[i]:
            assert zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32


def test_run(spark):
    pieces = P.run(spark, D)
    docs = spark.read.parquet(f"{D}/documents.parquet")
    kept = pieces.select("doc_id").distinct()
    assert 0.5 * docs.count() < kept.count() < docs.count()
    assert kept.join(docs, "doc_id", "left_anti").count() == 0
    tokens = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("m"))
    assert tokens.where("n <> m").count() == 0
