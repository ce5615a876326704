"""Toxicity by compression distance: window lengths under a dictionary of toxic and one of ordinary text."""

from __future__ import annotations

import base64
import math
import pickle
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textbytes import ALNUM, mix, words

#: Words in a window.
WINDOW_WORDS = 8
#: Bytes of the trained dictionaries.
TOXIC_BYTES, ORDINARY_BYTES = 4096, 8192
#: The labelled rows that a model is fitted to: so many of each label at most, by the order of a hash of the
#: id, and of those texts of up to so many characters, until they have so many together, by the order of the id's crc.
TOXIC_ROWS, ORDINARY_ROWS, ROW_CHARS, FIT_CHARS = 3000, 7000, 100_000, 80_000_000
#: Windows of ordinary texts that the ordinary dictionary is trained on, at most: every nth of all of them.
TRAINED_WINDOWS = 200_000
#: A run of words tells toxic text when it is in so many toxic texts that, at its rate in ordinary text, one in a
#: hundred times any run of its size at all would be in so many by chance. Runs have up to so many words.
CHANCE, RUN_WORDS = 0.01, WINDOW_WORDS
THRESHOLD = 0.7
#: What ends both dictionaries and is put before every window: no text holds it, so it is the first match under both,
#: and what a compressed block costs by itself hides no later match.
ANCHOR = bytes(range(1, 17))


def clean_texts(texts: pa.Array) -> Iterator[tuple[bytes, np.ndarray]]:
    """Of each text: its words in lower case, each after one space, and where each word's space is; then one space."""
    for block in words(texts, ALNUM, 1 << 20):
        inside = ALNUM[block.data]
        size = block.ends - block.starts + 1
        at = np.cumsum(size) - size
        data = np.empty(int(size.sum()), dtype=np.uint8)
        letters = np.ones(len(data), dtype=bool)
        letters[at] = False
        data[at], data[letters] = 32, block.data[inside]
        raw = data.tobytes()
        for a, b in zip(block.bounds[:-1], block.bounds[1:]):
            if a == b:
                yield b"", at[:0]
            else:
                end = int(at[b - 1] + size[b - 1])
                yield raw[at[a] : end] + b" ", (at[a:b] - at[a]).astype(np.int32)


def windows(text: bytes, spaces: np.ndarray) -> list[bytes]:
    """Windows of WINDOW_WORDS words, one after the other, with the spaces around them."""
    cut = [*spaces[::WINDOW_WORDS].tolist(), len(text) - 1]
    return [text[a : b + 1] for a, b in zip(cut[:-1], cut[1:])]


def _apart(texts: list[tuple[bytes, np.ndarray]]) -> list[tuple[bytes, np.ndarray]]:
    """Without copies and near copies, so that a group of copies tells nothing by its number: no two with one of 32 minima of shingle hashes alike."""
    odd = np.random.default_rng(7).integers(1, 2**62, 32, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    seen: list[set[int]] = [set() for _ in odd]
    out = []
    for text, spaces in texts:
        w = text.split()
        grams = np.array([zlib.crc32(b" ".join(w[i : i + 3])) for i in range(max(1, len(w) - 2))], dtype=np.uint64)
        least = [int(mix(grams * m).min()) for m in odd]
        if not any(x in s for x, s in zip(least, seen)):
            out.append((text, spaces))
        for x, s in zip(least, seen):
            s.add(x)
    return out


def _runs(text: bytes, apart: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each size up to RUN_WORDS: where a text's runs of so many words start, and their hashes; none that holds a word set apart."""
    own = np.fromiter((zlib.crc32(w) for w in text.split()), dtype=np.uint64)
    free = np.ones(len(own), dtype=bool) if apart is None else ~apart
    hashes, whole = np.zeros(len(own), dtype=np.uint64), np.ones(len(own), dtype=bool)
    for n in range(1, min(RUN_WORDS, len(own)) + 1):
        count = len(own) - n + 1
        hashes = mix(hashes[:count] * np.uint64(0x9E3779B97F4A7C15) + own[n - 1 :] + np.uint64(1))
        whole = whole[:count] & free[n - 1 :]
        at = np.flatnonzero(whole)
        yield n, at, hashes[at]


def _counted(texts: Iterable[Iterator[tuple[int, np.ndarray, np.ndarray]]], sizes: range, among: dict[int, np.ndarray] | None = None) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By size the hashes of runs, sorted, and in how many texts each is; only those among the given ones, if any are."""
    found: dict[int, list[np.ndarray]] = {n: [] for n in sizes}
    for runs in texts:
        for n, _, h in runs:
            if n in found:
                h = np.unique(h)
                found[n].append(h if among is None else h[np.isin(h, among[n], assume_unique=True)])
    return {n: np.unique(np.concatenate(h or [np.zeros(0, np.uint64)]), return_counts=True) for n, h in found.items()}


def _telling(toxic: list[tuple[bytes, np.ndarray]], ordinary: list[tuple[bytes, np.ndarray]]) -> list[bytes]:
    """Runs of words that tell toxic text, the most telling first: words, and phrases of whatever words.

    A run is telling by how many toxic and how many ordinary texts hold it. Passages, runs of RUN_WORDS words that
    stand in another text as well and don't tell by themselves, are set apart first: what texts share tells nothing.
    """

    def by_chance(sizes: range, apart: list[np.ndarray] | None = None):
        """By size: the runs in two toxic texts or more, whether each tells, and how well: the less, the better."""
        counts = _counted((_runs(t, a) for (t, _), a in zip(toxic, apart or [None] * len(toxic))), sizes)
        more = {n: (h[c > 1], c[c > 1]) for n, (h, c) in counts.items()}
        other = _counted((_runs(t) for t, _ in ordinary), sizes, {n: h for n, (h, _) in more.items()})
        for n, (h, c) in more.items():
            inside = np.zeros(len(h))
            inside[np.searchsorted(h, other[n][0])] = other[n][1]
            mu = (inside + 0.5) * len(toxic) / len(ordinary)
            # of a Poisson variable, about
            tail = np.where(c > 2 * mu, c * np.log(mu) - mu - np.array([math.lgamma(x + 1) for x in c.tolist()]), 0.0)
            yield n, h, tail < math.log(CHANCE / max(1, len(counts[n][0]))), tail

    size = range(RUN_WORDS, RUN_WORDS + 1)
    _, often, tells, _ = next(by_chance(size))
    known = _counted((_runs(t) for t, _ in toxic), size)[RUN_WORDS][0]
    passages = np.union1d(often, _counted((_runs(t) for t, _ in ordinary), size, {RUN_WORDS: known})[RUN_WORDS][0])
    passages = np.setdiff1d(passages, often[tells])
    apart = []
    for text, spaces in toxic:
        marks = np.zeros(len(spaces), dtype=bool)
        for n, at, h in _runs(text):
            if n == RUN_WORDS:
                for i in at[np.isin(h, passages)].tolist():
                    marks[i : i + n] = True
        apart.append(marks)
    best = {n: dict(zip(h[tells].tolist(), tail[tells].tolist())) for n, h, tells, tail in by_chance(range(1, RUN_WORDS + 1), apart)}
    found: dict[bytes, float] = {}
    for (text, _), marks in zip(toxic, apart):
        w = text.split()
        for n, at, h in _runs(text, marks):
            for i, x in zip(at.tolist(), h.tolist()):
                if x in best[n]:
                    found[b" ".join(w[i : i + n])] = best[n][x]
    return sorted(found, key=lambda run: (found[run], -len(run), run))


def _passages(texts: list[tuple[bytes, np.ndarray]], runs: list[bytes]) -> Iterator[bytes]:
    """Every place where a text holds one of the runs, with the spaces around it."""
    known = set(runs)
    for text, _ in texts:
        w = text.split()
        for n in range(1, RUN_WORDS + 1):
            for i in range(len(w) - n + 1):
                run = b" ".join(w[i : i + n])
                if run in known:
                    yield b" " + run + b" "


#: What a dictionary's content may be preceded by, in bytes: the tables of its format.
_TABLES = 1500


def _trained(samples: list[bytes], size: int, **how: int) -> bytes:
    """The content that the library's trainer picks; of too little text to train on, the text itself."""
    import zstandard

    try:
        return zstandard.train_dictionary(size + _TABLES, samples, **how).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


@dataclass
class ToxicityModel:
    """Two dictionaries, each trained on text of its own kind, and the weights of a document's features.

    A window's toxic length is that with the toxic dictionary before the ordinary one, so that a window which
    holds nothing of the former has the same length under both.
    """

    toxic: bytes = b""
    ordinary: bytes = b""
    weights: list[float] = field(default_factory=list)
    centre: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)
    prior: float = 0.0

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_pair"}

    def _compressors(self):
        import zstandard as z

        if not hasattr(self, "_pair"):
            self._pair = []
            for content in (self.ordinary + ANCHOR, self.toxic + self.ordinary + ANCHOR):
                p = z.ZstdCompressionParameters(
                    window_log=16, hash_log=13, chain_log=14, search_log=6, target_length=64, strategy=z.STRATEGY_LAZY2, min_match=4,
                    write_content_size=1, write_checksum=0, write_dict_id=0, format=z.FORMAT_ZSTD1_MAGICLESS,
                )
                d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(compression_params=p)
                self._pair.append(z.ZstdCompressor(dict_data=d, compression_params=p).compress)
        return self._pair

    def gains(self, parts: list[bytes]) -> np.ndarray:
        """By how many bytes the toxic dictionary makes each window shorter."""
        by_ordinary, by_toxic = self._compressors()
        return np.array([len(by_ordinary(w)) - len(by_toxic(w)) for w in (ANCHOR + p for p in parts)], dtype=np.int64)

    def features(self, text: bytes, spaces: np.ndarray) -> list[float]:
        """What the gains of a text's windows, in bytes, come to."""
        gains = self.gains(windows(text, spaces) or [b""])
        top = np.sort(gains)[-3:]
        up = np.maximum(gains, 0)
        more = [float(np.log1p((gains >= least).sum())) for least in (3, 6)]
        return [float(top[-1]), float(top.sum()), float(np.log1p(100 * up.mean())), *more, float(np.log1p(len(gains))), float(gains.mean())]

    def score(self, features: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(features), self.prior)
        z = (features - self.centre) / self.scale @ np.array(self.weights[1:]) + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(rows: Iterable[tuple[int, str, int]], counts: dict[int, int]) -> ToxicityModel:
    """A model from (crc, text, label) rows: dictionaries from two thirds of them by crc, weights from the others.

    counts: how many labels of each kind there are, to which the sample's are weighted. With only one kind of
    label every score is that kind's share. The toxic dictionary is trained on those passages of toxic texts that tell
    them from ordinary ones: trained on all their windows, which are ordinary ones mostly, it tells little.
    """
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.0
    rows, cleaned = iter(rows), []
    while part := list(islice(rows, 256)):  # texts stay in one form only
        texts = clean_texts(pa.array([r[1] for r in part], type=pa.string()))
        cleaned += [(r[0] // 3 % 3 != 0, r[2], c) for r, c in zip(part, texts)]
    toxic = _apart([c for own, label, c in cleaned if own and label == 1])
    ordinary = _apart([c for own, label, c in cleaned if own and label == 0])
    if not toxic or not ordinary:
        return ToxicityModel(prior=prior)
    nth = -(-sum(-(-len(spaces) // WINDOW_WORDS) for _, spaces in ordinary) // TRAINED_WINDOWS) or 1
    model = ToxicityModel(
        _trained(list(_passages(toxic, _telling(toxic, ordinary))), TOXIC_BYTES, k=64, d=8),
        _trained(list(islice((w for t in ordinary for w in windows(*t)), 0, None, nth)), ORDINARY_BYTES),
        prior=prior,
    )
    held = [(label, c) for own, label, c in cleaned if not own] or [(label, c) for _, label, c in cleaned]
    x, y = np.array([model.features(*c) for _, c in held]), np.array([label for label, _ in held], dtype=float)
    if y.min() == y.max():
        return ToxicityModel(prior=prior)
    model.centre, model.scale = x.mean(0).tolist(), (x.std(0) + 1e-6).tolist()
    design = np.hstack([np.ones((len(x), 1)), (x - model.centre) / model.scale])
    weight = np.where(y == 1, counts[1] / y.sum(), counts[0] / (1 - y).sum())
    weight /= weight.mean()
    w, ridge = np.zeros(design.shape[1]), np.diag([1e-3] + [1.0] * x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -40, 40)))
        step = np.linalg.solve(design.T @ (design * (weight * p * (1 - p))[:, None]) + ridge, design.T @ (weight * (y - p)) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    model.weights = w.tolist()
    return model


def crc_of(id_col: Column) -> Column:
    return F.crc32(id_col.cast("long").cast("string").cast("binary"))


def train(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """A model from labelled documents; may_learn (of doc_id) tells which labels may be seen.

    Rows with a null id or label, or a label that isn't 0 or 1, tell nothing; a null text is the empty one. Of
    documents with one id the one with the least hash counts; labels that repeat count once.
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter("doc_id is not null and label in (0, 1)").distinct()
    known = known.filter(may_learn) if may_learn is not None else known
    counts = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    picked = None
    for label, most in ((1, TOXIC_ROWS), (0, ORDINARY_ROWS)):
        some = known.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picked = some if picked is None else picked.unionByName(some)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).filter(F.length("text") <= ROW_CHARS)
    found = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    found = found.select(crc_of(F.col("doc_id")).alias("crc"), "text", "label", "doc_id").orderBy("crc", "doc_id", "label")

    def within() -> Iterator[tuple[int, str, int]]:
        chars = 0
        for crc, text, label, _ in found.toLocalIterator():
            chars += len(text)
            if chars > FIT_CHARS:
                return
            yield crc, text, label

    model = fit(within(), counts)
    pa.default_memory_pool().release_unused()
    return model


def _scorer(packed: str):
    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: ToxicityModel = pickle.loads(base64.b64decode(packed))
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            features = np.array([model.features(*t) for t in clean_texts(texts)], dtype=float).reshape(len(texts), -1)
            arrays = [*batch.columns[:-1], pa.array(model.score(features), pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:-1], "score"])

    return score_batches


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """doc (a struct of the row's columns) and score, 0 to 1, higher where toxic is likelier.

    All windows of a text count, whatever its length; a null or empty text has a score as well. Only the text
    goes into it. Equal texts have equal scores; nothing is shuffled.
    """
    packed = base64.b64encode(pickle.dumps(model)).decode()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_text"))
    return rows.mapInArrow(_scorer(packed), T.StructType([rows.schema.fields[0], T.StructField("score", T.DoubleType())]))
