"""LM scoring: a hidden Markov model of word classes, trained by Baum-Welch counts summed over all partitions."""

from __future__ import annotations

import base64
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hmm import Hmm
from .storage import materialize
from .textbytes import SPACED, Words, mix, words

STATES, ROUNDS = 8, 7
#: Words with a class of their own; classes that other words share by their last two bytes; words whose counts every task holds.
OWN_CLASSES, SHARED_CLASSES, HELD_WORDS = 4096, 1024, 1 << 19
#: Distinct words that a counting task holds before it gives out what it has.
COUNTED = 2_000_000

END = 0x5E4D_0E0F_7E87_E11D


def _tokens(block: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and shared classes of all tokens of a block, each text's end included, and bounds."""
    h = block.hashes()
    last = block.data[block.ends - 1].astype(np.uint64)
    before = np.where(block.ends - block.starts > 1, block.data[np.maximum(block.ends - 2, 0)], 0).astype(np.uint64)
    shared = (mix(last * np.uint64(256) + before) % np.uint64(SHARED_CLASSES)).astype(np.int64)
    bounds = block.bounds + np.arange(block.docs + 1)
    keep = np.ones(bounds[-1], dtype=bool)
    keep[bounds[1:] - 1] = False
    hashes, classes = np.full(bounds[-1], END, dtype=np.uint64), np.zeros(bounds[-1], dtype=np.int64)
    hashes[keep], classes[keep] = h, shared
    return hashes, classes, bounds


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def summed(parts):
        h, c, s = (np.concatenate([p[i] for p in parts]) for i in range(3))
        u, first, at = np.unique(h, return_index=True, return_inverse=True)
        return u, np.bincount(at, weights=c, minlength=len(u)).astype(np.int64), s[first]

    def rows(h, c, s):
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c), pa.array(s.astype(np.int32))], names=["h", "c", "s"])

    for batch in batches:
        for block in words(batch.column(0), SPACED):
            h, s, _ = _tokens(block)
            u, first, c = np.unique(h, return_index=True, return_counts=True)
            held.append((u, c, s[first]))
            size += len(u)
            if size > COUNTED:
                held = [summed(held)]
                size = len(held[0][0])
                if size > COUNTED // 2:
                    yield rows(*held[0])
                    held, size = [], 0
    if held:
        yield rows(*summed(held))


@dataclass
class Lexicon:
    """Counts of the most frequent training words, by hash, with their classes (-1: shared), and of the shared classes."""

    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    total: int
    distinct: int
    shared_log: np.ndarray  # log10 of what a shared class's words divide, by class


@dataclass
class Model:
    hmm: Hmm
    lexicon: Lexicon


CODED = "doc_id long, learn boolean, n_tokens long, n_known long, base_part double, word_part double, classes binary, rare array<long>, times array<long>"


def _coder(lexicon: Lexicon):
    def code_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = lexicon.value
        for batch in batches:
            done = 0
            for block in words(batch.column(2), SPACED):
                h, shared, bounds = _tokens(block)
                doc = np.repeat(np.arange(block.docs), np.diff(bounds))
                at = np.minimum(np.searchsorted(lex.hashes, h), max(len(lex.hashes) - 1, 0))
                held = lex.hashes[at] == h if len(lex.hashes) else np.zeros(len(h), dtype=bool)
                log_count = np.where(held, np.log10(lex.counts[at] + 1.0), 0.0) if len(lex.hashes) else np.zeros(len(h))
                own = np.where(held, lex.classes[at], -1) if len(lex.hashes) else np.full(len(h), -1)
                own = np.where(h == np.uint64(END), 0, own)
                classes = np.where(own >= 0, own, OWN_CLASSES + shared).astype("<u2")
                in_class = np.where(own >= 0, 0.0, log_count - lex.shared_log[shared])
                total = lambda x: np.bincount(doc, weights=x, minlength=block.docs)
                rare_at = np.flatnonzero(~held)
                order = rare_at[np.lexsort((h[rare_at], doc[rare_at]))]  # each word once for a text, with how often it stands there
                first = np.flatnonzero(np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])])) if len(order) else order
                times = np.diff(np.append(first, len(order)))
                rare_at = order[first]
                rare_bounds = pa.array(np.searchsorted(doc[rare_at], np.arange(block.docs + 1)).astype(np.int32))
                raw = classes.tobytes()
                arrays = [
                    batch.column(0).slice(done, block.docs), batch.column(1).slice(done, block.docs), pa.array(np.diff(bounds)),
                    pa.array(total(held).astype(np.int64)), pa.array(total(log_count)), pa.array(total(in_class)),
                    pa.array([raw[2 * a : 2 * b] for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()),
                    pa.ListArray.from_arrays(rare_bounds, pa.array(h[rare_at].view(np.int64))), pa.ListArray.from_arrays(rare_bounds, pa.array(times.astype(np.int64))),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in CODED.split(", ")])
                done += block.docs

    return code_batches


def _sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), dtype="<u2"), np.concatenate([[0], np.cumsum([len(p) // 2 for p in parts])]).astype(np.int64)


def _expecter(packed: str):
    def expect_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hmm: Hmm = pickle.loads(base64.b64decode(packed))
        total = None
        for batch in batches:
            if batch.num_rows:
                found = np.concatenate([x.ravel() for x in hmm.expect(*_sequences(batch.column(0)))])
                total = found if total is None else total + found
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["i", "x"])

    return expect_batches


def _pack(x) -> str:
    return base64.b64encode(pickle.dumps(x)).decode()


def baum_welch(coded: DataFrame, share: np.ndarray, states: int, rounds: int, seed: int) -> Hmm:
    """Rounds over all sequences: each task's expected counts, summed by Spark, are the next model's frequencies."""
    hmm = Hmm.begin(share, states, seed)
    for _ in range(rounds):
        rows = coded.mapInArrow(_expecter(_pack(hmm)), "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).toArrow()
        flat = np.zeros(states + states * states + len(share) * states)
        flat[rows["i"].to_numpy()] = rows["x"].to_numpy()
        start, moves, emits = np.split(flat, [states, states + states * states])
        hmm = Hmm.of_counts(start, moves.reshape(states, states), emits.reshape(len(share), states), share)
    return hmm


def _scorer(packed: str):
    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hmm: Hmm = pickle.loads(base64.b64decode(packed))
        for batch in batches:
            if batch.num_rows:
                scores = hmm.log10(*_sequences(batch.column(batch.num_columns - 1)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], names=[*batch.schema.names[:-1], "class_part"])

    return score_batches


def score_documents(
    docs: DataFrame, learn: Column, *, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, rounds: int = ROUNDS, seed: int = 5
) -> DataFrame:
    """doc_id, learn, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities) of every document.

    The model learns from the documents for which `learn` holds. Tokens are words between ASCII white space,
    A-Z lower-cased, and one end. The OWN_CLASSES - 1 most frequent and the end have classes of their own, others
    share one of SHARED_CLASSES by their last bytes. A document's probability is that of its class sequence under
    the hidden Markov model, by the forward recursion over the whole text, times each word's within its class,
    (c + 1) / (tokens + words + 1), where c is 0 for a word not learned: as in the base score, one more word stands
    for all of those.

    Counts cover all training text. Every task holds the HELD_WORDS most frequent words; the counts of others come by a
    join on the word, for each text once. A null text is the empty one: only an end. A null id
    is kept. Rows that repeat are scored, and learned from, each. With nothing to learn from all classes are alike.
    """
    spark = docs.sparkSession
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(learn, F.lit(True)).alias("learn"), text.alias("text"))
    counted = rows.filter("learn").select("text").mapInArrow(_counter, "h long, c long, s int")
    vocabulary = materialize(counted.groupBy("h").agg(F.sum("c").alias("c"), F.first("s").alias("s")), "vocabulary")

    total, distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    steps = vocabulary.groupBy(F.floor(F.log2("c") * 64).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).orderBy(F.desc("b")).collect()
    least, n = 1 << 62, 0
    for step in steps:
        n += step["n"]
        if n > HELD_WORDS:
            break
        least = step["c"]
    held = vocabulary.filter(F.col("c") >= least).toArrow()
    order = np.lexsort((held["h"].to_numpy(), -held["c"].to_numpy()))
    hashes, counts, shared = held["h"].to_numpy()[order].view(np.uint64), held["c"].to_numpy()[order], held["s"].to_numpy()[order]
    classes = np.full(len(hashes), -1, dtype=np.int64)
    own = np.flatnonzero(hashes != np.uint64(END))[: OWN_CLASSES - 1]
    classes[own] = np.arange(1, len(own) + 1)
    classes[hashes == np.uint64(END)] = 0
    by_shared = vocabulary.filter(F.col("h") != F.lit(np.array([END], dtype=np.uint64).view(np.int64)[0].item())).groupBy("s").agg(F.sum("c"), F.count(F.lit(1))).collect()
    mass, kinds = np.zeros(SHARED_CLASSES), np.zeros(SHARED_CLASSES)
    for s, c, k in by_shared:
        mass[s], kinds[s] = c, k
    mass -= np.bincount(shared[own], weights=counts[own], minlength=SHARED_CLASSES)
    kinds -= np.bincount(shared[own], minlength=SHARED_CLASSES)
    share = np.zeros(OWN_CLASSES + SHARED_CLASSES)
    share[classes[classes >= 0]] = counts[classes >= 0]
    share[OWN_CLASSES:] = mass
    share = (share + 1) / (share + 1).sum()
    by_hash = np.argsort(hashes)
    lexicon = spark.sparkContext.broadcast(Lexicon(hashes[by_hash], counts[by_hash], classes[by_hash], total, distinct, np.log10(mass + kinds + 1)))

    coded = materialize(rows.mapInArrow(_coder(lexicon), CODED).withColumn("row", F.monotonically_increasing_id()), "coded")
    hmm = baum_welch(coded.filter("learn").select("classes"), share, states, rounds, seed)

    rare = coded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("h"), F.col("w.times").alias("n"))
    rare = rare.join(vocabulary.select("h", "c").filter(F.col("c") < least).hint("merge"), "h")  # both plain shuffles: AQE can split a word that very many texts have
    rare = rare.groupBy("row").agg(F.sum("n").alias("rare_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("rare_log"))
    columns = ["row", "doc_id", "learn", "n_tokens", "n_known", "base_part", "word_part", "classes"]
    schema = "row long, doc_id long, learn boolean, n_tokens long, n_known long, base_part double, word_part double, class_part double"
    scored = coded.select(*columns).mapInArrow(_scorer(_pack(hmm)), schema).join(rare, "row", "left")
    more = F.coalesce("rare_log", F.lit(0.0))
    return scored.select(
        "doc_id",
        "learn",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base_part") + more - F.col("n_tokens") * math.log10(total + distinct + 1)).alias("base_score"),
        (F.col("class_part") + F.col("word_part") + more).alias("score"),
    )
