import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lexirank.llm import queries
from lexirank.llm.toxicity import ToxicityModel, clean_texts, fit, score, train, windows


def test_clean_texts_and_windows_keep_every_word():
    texts = ["Hello,  World!\nÉté 3x", "", None, "?!", " ".join(f"w{i}" for i in range(20))]
    got = list(clean_texts(pa.array(texts, pa.string())))
    assert [t for t, _ in got][:4] == [" hello world Été 3x ".encode(), b"", b"", b""]
    parts = windows(*got[4])
    assert [len(p.split()) for p in parts] == [8, 8, 4] and all(p[:1] == p[-1:] == b" " for p in parts)
    assert windows(*got[1]) == [] or windows(*got[1]) == [b""]


def corpus(n, seed):
    rng = random.Random(seed)
    syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(n):
        text = [word() for _ in range(rng.randint(5, 150))]
        label = int(rng.random() < 0.3)
        for _ in range(rng.randint(2, 6) if label else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["grumbo", "fizzlewit", "blortish", "snarkel"]))
        rows.append((i, " ".join(text), label))
    return rows


def test_one_short_word_shortens_a_window():
    short = ["ass", "damn", "scum", "loser", "clown"]
    clean = [t for _, t, y in corpus(400, 9) if y == 0]
    model = ToxicityModel(" ".join(["", *short * 20, ""]).encode(), "".join(f" {t} " for t in clean[:100]).encode()[-8192:])
    top = lambda text: next(model.features(*c)[0] for c in clean_texts(pa.array([text])))
    cut = [t.split()[:7] for t in clean[100:]]
    assert sum(top(" ".join(w)) > 0 for w in cut) == 0
    for word in short:
        share = np.mean([top(" ".join([*w[:3], word, *w[3:]])) > 0 for w in cut])
        assert share > (0.4 if len(word) == 3 else 0.8), word


def test_held_out_accuracy(spark):
    rows = corpus(900, 4)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    got = {r.doc.doc_id: r.score for r in score(docs, train(docs, labels, ~held)).collect()}
    test = [(got[i], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    hits = np.mean([(s >= 0.7) == (y == 1) for s, y in test])
    assert hits > 0.95 and all(0 <= s <= 1 for s in got.values())


def test_phrases_tell_and_shared_passages_do_not():
    clean = [t.split() for _, t, y in corpus(900, 5) if y == 0]
    fixed, plain = "you snarkel lot".split(), [clean[0][0], clean[1][1], clean[2][2], clean[3][3], clean[4][4]]
    shared = clean[5][:20] + [f"licence{i}" for i in range(20)]
    rows = []
    for i, w in enumerate(clean[6:]):
        label, at = int(i % 3 == 0), i % (len(w) + 1)
        put = (fixed, plain)[i // 3 % 2] * 2 if label else []
        rows.append((w[:at] + put + w[at:] + (shared if i % 4 == 0 else []), label))
    model = fit([(zlib.crc32(str(i).encode()), " ".join(w), y) for i, (w, y) in enumerate(rows) if i % 5], {0: 400, 1: 200})
    assert b" snarkel " in model.toxic and b"licence" not in model.toxic
    held = [(w, y) for i, (w, y) in enumerate(rows) if i % 5 == 0]
    scores = model.score(np.array([model.features(*c) for c in clean_texts(pa.array([" ".join(w) for w, _ in held]))]))
    labels = np.array([y for _, y in held])
    assert scores[labels == 1].min() > 0.7 > scores[labels == 0].max()


def test_sample_table_held_out_accuracy(spark):
    r = queries.op4_toxicity(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out").toPandas()
    a, b = r.score[r.toxic == 1].values, r.score[r.toxic == 0].values
    assert (a[:, None] > b[None, :]).mean() + 0.5 * (a[:, None] == b[None, :]).mean() > 0.85
    assert (r.predicted == (r.score >= 0.7)).all() and (r.predicted[r.toxic == 0].mean()) < 0.02


def test_any_rows(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 7)], "doc_id long, toxic int")
    for labels in (none, odd):
        scores = score(docs, train(docs, labels)).collect()
        assert len(scores) == docs.count() and {r.score for r in scores} == {0.0}
    one_kind = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert {r.score for r in score(docs, train(docs, one_kind)).collect()} == {1.0}
    model = fit([(i, t, y) for i, t, y in corpus(60, 1)], {0: 42, 1: 18})
    rows = score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.doc.text or "", r.score) == r.score
    assert score(empty, ToxicityModel(prior=0.5)).count() == 0


def test_against_lengths_taken_one_by_one():
    """Windows, lengths and features of a model, worked out again from the two dictionaries alone."""
    import zstandard as z

    model = fit([(zlib.crc32(str(i).encode()), t, y) for i, t, y in corpus(600, 11)], {0: 420, 1: 180})
    texts = [t for _, t, _ in corpus(40, 12)] + ["", "one"]

    def lengths(content, parts):
        how = dict(window_log=16, hash_log=13, chain_log=14, search_log=6, target_length=64, strategy=z.STRATEGY_LAZY2, min_match=4, write_content_size=1, write_checksum=0, write_dict_id=0, format=z.FORMAT_ZSTD1_MAGICLESS)
        anchor = bytes(range(1, 17))
        out = []
        for part in parts:
            p = z.ZstdCompressionParameters(**how)
            d = z.ZstdCompressionDict(content + anchor, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=p)
            out.append(len(z.ZstdCompressor(dict_data=d, compression_params=p).compress(anchor + part)))
        return np.array(out)

    for text, (clean, spaces) in zip(texts, clean_texts(pa.array(texts))):
        w = text.lower().split()
        parts = [" ".join(["", *w[i : i + 8], ""]).encode() for i in range(0, len(w), 8)] or [b""]
        assert (windows(clean, spaces) or [b""]) == parts
        gains = lengths(model.ordinary, parts) - lengths(model.toxic + model.ordinary, parts)
        top = np.sort(gains)[-3:]
        want = [top[-1], top.sum(), np.log1p(100 * np.maximum(gains, 0).mean()), np.log1p((gains >= 3).sum()), np.log1p((gains >= 6).sum()), np.log1p(len(gains)), gains.mean()]
        assert np.allclose(model.features(clean, spaces), want)


def test_documents_and_labels_that_repeat_count_once(spark):
    rows = corpus(300, 13)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    once, often = train(docs, labels), train(docs.unionByName(docs).unionByName(docs), labels.unionByName(labels))
    assert once.toxic == often.toxic and once.ordinary == often.ordinary and once.weights == often.weights
