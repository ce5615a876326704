"""Quality by co-training: a classifier of the text and one of the page's metadata teach each other."""

from __future__ import annotations

import base64
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import materialize
from .textbytes import ALNUM, SPACED, words

ROUNDS, STEPS = 3, 5
#: A view's pseudo-label counts when its probability of a label is so high, and as so much of a label at most.
CONFIDENT, PSEUDO_WEIGHT = 0.95, 0.25
#: The penalty on the weight of a slot of words, where that of any other feature is 1: they are many, and each tells little.
WORD_RIDGE = 30.0
#: Slots that words, sources and languages are hashed to.
WORD_SLOTS, SOURCE_SLOTS, LANG_SLOTS = 64, 32, 8

_MARKS = np.zeros(256, dtype=bool)
_MARKS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"()?-"]] = True

SHAPES = 14
TEXT_FEATURES = SHAPES + WORD_SLOTS + 1


def text_features(texts: pa.Array) -> np.ndarray:
    """Content and shape of each text: the roots of the shares of its words in each slot, after SHAPES numbers, of which one without words has the last alone."""
    out = []
    for block in words(texts, SPACED):
        n = block.counts()
        size = np.maximum(np.diff(block.base), 1)
        per = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[block.base])
        data = block.data
        h, doc = block.hashes(), block.doc()
        order = np.lexsort((h, doc))
        fresh = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])]) if len(h) else np.zeros(0, bool)
        distinct = np.bincount(doc[order][fresh], minlength=block.docs)
        run = np.diff(np.concatenate([np.flatnonzero(fresh), [len(h)]])) if len(h) else np.zeros(0, int)
        most = np.zeros(block.docs)
        if len(h):
            np.maximum.at(most, doc[order][fresh], run)
        words_ = np.maximum(n, 1)
        length = block.ends - block.starts
        total = np.bincount(doc, weights=length, minlength=block.docs)
        square = np.bincount(doc, weights=length.astype(float) ** 2, minlength=block.docs)
        last = data[block.ends - 1] if len(h) else np.zeros(0, np.uint8)
        marked = np.bincount(doc, weights=_MARKS[last], minlength=block.docs)
        lone = np.bincount(doc, weights=(length == 1) & ~ALNUM[last], minlength=block.docs)
        slot = (h % np.uint64(WORD_SLOTS)).astype(np.int64)
        content = np.sqrt(np.bincount(doc * WORD_SLOTS + slot, minlength=block.docs * WORD_SLOTS).reshape(block.docs, WORD_SLOTS) / words_[:, None])
        shape = (
            np.stack(
                [
                    np.log1p(n), total / words_, np.sqrt(np.maximum(square / words_ - (total / words_) ** 2, 0)), distinct / words_, most / words_,
                    per(data == 10) / words_, per(_MARKS[data]) / size, per((data >= 48) & (data < 58)) / size, per(data >= 128) / size,
                    marked / words_, lone / words_, per((data == 46) | (data == 44)) / words_, per(data == 33) / words_, np.where(n == 0, 1.0, 0.0),
                ],
                axis=1,
            )
        )
        out.append(np.hstack([shape, content]))
    return np.concatenate(out) if out else np.zeros((0, TEXT_FEATURES - 1))


def upper_share(texts: list[str | None]) -> np.ndarray:
    """Of each text's letters, the part in upper case, by what lower-casing changes."""
    out = []
    for t in texts:
        raw = np.frombuffer((t or "").encode(), dtype=np.uint8)
        out.append(float(((raw >= 65) & (raw <= 90)).sum()) / max(1, int(ALNUM[raw].sum())))
    return np.array(out)


def _featurer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        x = np.hstack([text_features(texts), upper_share(texts.to_pylist())[:, None]])
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel().astype(np.float32)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], flat], names=[*batch.schema.names[:-1], "x_text"])


def metadata_vector(source: Column, lang: Column, size: Column) -> Column:
    """Source and language in hashed slots, and size: a null has a slot as any value."""
    slot = lambda c, n: F.pmod(F.xxhash64(F.coalesce(c.cast("string"), F.lit("\0"))), F.lit(n))
    one = lambda c, n: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (slot(c, n) == i).cast("double"))
    log = F.log1p(F.coalesce(size.cast("double"), F.lit(0.0)))
    return F.concat(one(source, SOURCE_SLOTS), one(lang, LANG_SLOTS), F.array(log, log * log / 10))


@dataclass
class Views:
    """Weights of both views over standardized features, bias first; of each view's calibration, and of their combination."""

    mean: np.ndarray
    scale: np.ndarray
    text: np.ndarray
    meta: np.ndarray
    text_line: np.ndarray
    meta_line: np.ndarray
    both: np.ndarray

    def logits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.split(x)
        return a @ self.text, b @ self.meta

    def calibrated(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.logits(x)
        return self.text_line[0] + self.text_line[1] * a, self.meta_line[0] + self.meta_line[1] * b

    def split(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = (x - self.mean) / self.scale
        one = np.ones((len(x), 1))
        k = len(self.text) - 1
        return np.hstack([one, z[:, :k]]), np.hstack([one, z[:, k:]])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _features(batch: pa.RecordBatch) -> np.ndarray:
    parts = [batch.column(batch.schema.names.index(c)) for c in ("x_text", "x_meta")]
    return np.hstack([c.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(c), -1) for c in parts])


def _sums(packed: str, job: str):
    """Of each task: one row of summed numbers, as (i, x)."""

    def sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        views, teacher = pickle.loads(base64.b64decode(packed))
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _features(batch)
            if job == "moments":
                found = np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])
            else:
                y = batch.column(batch.schema.names.index("y")).to_numpy(zero_copy_only=False).astype(float)
                fold = batch.column(batch.schema.names.index("fold")).to_numpy(zero_copy_only=False)
                a, b = views.split(x)
                at, one = ((fold == 2) & ~np.isnan(y)).astype(float), np.ones(len(x))
                if job == "views":
                    other = [None, None] if teacher is None else [_sigmoid(b @ teacher.meta), _sigmoid(a @ teacher.text)]
                    known, found = (fold == 1) & ~np.isnan(y), []
                    for design, w, p in ((a, views.text, other[0]), (b, views.meta, other[1])):
                        sure = [np.zeros(len(x), bool)] * 2 if p is None else [~known & (p <= 1 - CONFIDENT), ~known & (p >= CONFIDENT)]
                        found.append(np.array([(known & (y < 0.5)).sum(), (known & (y >= 0.5)).sum(), sure[0].sum(), sure[1].sum()], float))
                        for at, target in ((known, y), (sure[0], np.zeros(len(x))), (sure[1], one)):
                            d, t = design[at], target[at]
                            p_own = _sigmoid(d @ w)
                            found += [d.T @ (t - p_own), (d.T @ (d * (p_own * (1 - p_own))[:, None])).ravel()]
                    total = np.concatenate(found) if total is None else total + np.concatenate(found)
                    continue
                if job == "lines":
                    sides = [(np.stack([one, z], 1), w, y, at) for z, w in zip(views.logits(x), (views.text_line, views.meta_line))]
                else:
                    sides = [(np.stack([one, *views.calibrated(x)], 1), views.both, y, at)]
                found = []
                for design, w, target, weight in sides:
                    p = _sigmoid(design @ w)
                    target = np.where(weight > 0, target, 0.0)
                    found += [design.T @ (weight * (target - p)), (design.T @ (design * (weight * p * (1 - p))[:, None])).ravel()]
                found = np.concatenate(found)
            total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "x"])

    return sum_batches


def _total(rows: DataFrame, job: str, size: int, state) -> np.ndarray:
    packed = base64.b64encode(pickle.dumps(state)).decode()
    found = rows.mapInArrow(_sums(packed, job), "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).toArrow()
    out = np.zeros(size)
    out[found["i"].to_numpy()] = found["x"].to_numpy()
    return out


def weighed(sums: np.ndarray, d: int) -> np.ndarray:
    """Gradient and curvature of a view of d weights: of its labels, and of its pseudo-labels in the labels' proportion.

    A pseudo-label of the kind that is scarcer by this measure counts as PSEUDO_WEIGHT of a label, one of the other kind
    as less; while there are none of one kind, those of the other would only teach that all is of that kind, and don't count.
    """
    labels, pseudo, (known, zero, one) = sums[:2], sums[2:4], sums[4:].reshape(3, d + d * d)
    share = min((n / k for n, k in zip(pseudo, labels) if k), default=0.0)
    weights = [PSEUDO_WEIGHT * share * k / n if n else 0.0 for n, k in zip(pseudo, labels)]
    return known + weights[0] * zero + weights[1] * one


def ridge_of_text() -> np.ndarray:
    """The text view's penalties, bias first."""
    return np.array([1e-6, *[1.0] * SHAPES, *[WORD_RIDGE] * WORD_SLOTS, 1.0])


def _step(w: np.ndarray, part: np.ndarray, towards: float | np.ndarray = 0.0, ridge: np.ndarray | None = None) -> np.ndarray:
    """Newton's step with a ridge towards a value, shortened where it is long, as where a view parts the labels entirely."""
    d = len(w)
    ridge = np.diag(np.array([1e-6] + [1.0] * (d - 1)) if ridge is None else ridge)
    step = np.linalg.solve(part[d:].reshape(d, d) + ridge, part[:d] - ridge @ (w - towards))
    return step * min(1.0, 1.5 / max(np.abs(step).max(), 1e-12))


def _scorer(packed: str):
    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        views: Views = pickle.loads(base64.b64decode(packed))
        for batch in batches:
            if batch.num_rows:
                za, zb = views.calibrated(_features(batch))
                both = views.both[0] + views.both[1] * za + views.both[2] * zb
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(_sigmoid(z)) for z in (za, zb, both))], names=["doc_id", "held_out", "text_score", "meta_score", "score"])

    return score_batches


def cotrain_scores(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", source_col: str = "source", lang_col: str = "lang", size_col: str = "n_chars", rounds: int = ROUNDS
) -> DataFrame:
    """doc_id, held_out, text_score, meta_score, score of every document: probabilities of label 1.

    Folds by crc32 of the id modulo 5: labels of 3 are held out, those of 4 calibrate each view and fit the combination
    of the calibrated views, the others fit both views. The text view sees words, in hashed slots, and the text's shape;
    the other source, language and size. In each round the views' sums of gradients and curvatures are taken over all
    documents: labelled ones, and, from the second round on, for each view those that the other view of the round
    before is CONFIDENT of, both kinds in the labels' proportion. So what a task sends is of fixed size, and no document is sampled. A document counts with the
    mean of its labels, if it has several; without labels all scores are equal. Null texts, sources, languages
    and sizes have values of their own; a null id has no label and is joined with nothing.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    key = docs[id_col].cast("long")
    meta = metadata_vector(docs[source_col], docs[lang_col], docs[size_col])
    plain = docs.select(key.alias("doc_id"), meta.alias("x_meta"), text.alias("text"))
    shaped = lambda rows: rows.mapInArrow(_featurer, "doc_id long, x_meta array<double>, x_text array<float>")
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y")).filter("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.avg("y").alias("y"))
    known = materialize(known, "labels")
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5, F.lit(0))
    nameless = shaped(plain.filter("doc_id is null")).withColumn("y", F.lit(None).cast("double"))
    rows = shaped(plain.filter("doc_id is not null")).join(known, "doc_id", "left").unionByName(nameless)
    rows = rows.withColumn("fold", F.when(fold == 3, 3).when(fold == 4, 2).otherwise(1)).withColumn("held_out", fold == 3)
    rows = materialize(rows.select("doc_id", "held_out", "x_text", "x_meta", "y", "fold"), "features")
    dt, dm = TEXT_FEATURES, SOURCE_SLOTS + LANG_SLOTS + 2
    moments = _total(rows, "moments", 1 + 2 * (dt + dm), (None, None))
    n = max(moments[0], 1.0)
    mean = moments[1 : 1 + dt + dm] / n
    scale = np.sqrt(np.maximum(moments[1 + dt + dm :] / n - mean**2, 0)) + 1e-6
    line = np.array([0.0, 1.0])
    views, teacher = Views(mean, scale, np.zeros(dt + 1), np.zeros(dm + 1), line, line, np.array([0.0, 1.0, 0.0])), None
    cut = 4 + 3 * (dt + 1) * (dt + 2)
    for _ in range(rounds):
        for _ in range(STEPS):
            found = _total(rows, "views", cut + 4 + 3 * (dm + 1) * (dm + 2), (views, teacher))
            views.text = views.text + _step(views.text, weighed(found[:cut], dt + 1), ridge=ridge_of_text())
            views.meta = views.meta + _step(views.meta, weighed(found[cut:], dm + 1))
        teacher = replace(views, text=views.text.copy(), meta=views.meta.copy())
    for _ in range(STEPS):
        found = _total(rows, "lines", 12, (views, None))
        views.text_line, views.meta_line = views.text_line + _step(views.text_line, found[:6], line), views.meta_line + _step(views.meta_line, found[6:], line)
    for _ in range(STEPS):
        views.both = views.both + _step(views.both, _total(rows, "both", 12, (views, None)))
    packed = base64.b64encode(pickle.dumps(views)).decode()
    return rows.select("doc_id", "held_out", "x_text", "x_meta").mapInArrow(_scorer(packed), "doc_id long, held_out boolean, text_score double, meta_score double, score double")
