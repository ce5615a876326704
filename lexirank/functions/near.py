"""Words at an edit distance of two at most, by the pieces they have in common.

A word cut into three pieces has one of them whole in any word at a distance of two, at a place that the pieces before it
and after it bound. So one side keeps its pieces, the other asks for its parts at these places, and only words with a
piece in common are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import FOLDED_FROM, FOLDED_TO, matches, normalize

REACH = 2
PIECES = REACH + 1
_FOLD = str.maketrans(FOLDED_FROM, FOLDED_TO)


def shifts(piece: int, longer: int) -> range:
    """How far from its place piece 1, 2 or 3 may stand in a word that has so many letters more than the one it is of.

    At most piece - 1 changes are before it and PIECES - piece after it, if no piece before it is whole.
    """
    return range(max(1 - piece, longer - (PIECES - piece)), min(piece - 1, longer + PIECES - piece) + 1)


def cut(length, piece: int):
    """Start and length of a piece of a word, of numbers or columns: the last ones take the letters that are over."""
    if isinstance(length, Column):
        base, short = F.floor(length / PIECES).cast("int"), F.lit(PIECES) - length % PIECES
        return (piece - 1) * base + F.greatest(F.lit(0), F.lit(piece - 1) - short), base + (F.lit(piece) > short).cast("int")
    base, short = length // PIECES, PIECES - length % PIECES
    return (piece - 1) * base + max(0, piece - 1 - short), base + (piece > short)


def kept_pieces(word: Column) -> Column:
    """The pieces of a word: (length of the word, number of the piece, piece)."""
    n = F.length(word)
    out = []
    for i in range(1, PIECES + 1):
        start, size = cut(n, i)
        out.append(F.struct(n.alias("length"), F.lit(i).alias("number"), F.substring(word, start + 1, size).alias("piece")))
    return F.array(*out)


def asked_pieces(word: Column) -> Column:
    """The pieces of words at a distance of two that a word may have."""
    n = F.length(word)
    out = []
    for longer in range(-REACH, REACH + 1):
        for i in range(1, PIECES + 1):
            start, size = cut(n - longer, i)
            for by in shifts(i, longer):
                inside = (n >= longer) & (start + by >= 0) & (start + by + size <= n)
                out.append(F.when(inside, F.struct((n - longer).alias("length"), F.lit(i).alias("number"), F.substring(word, start + by + 1, size).alias("piece"))))
    return F.array_compact(F.array(*out))


def near_pairs(left: DataFrame, right: DataFrame, on: list[str], left_word: str, right_word: str) -> DataFrame:
    """Rows of both, equal in `on`, whose words nearly match, at least once each: an equi join on pieces, then the test of the pair.

    The two tables have no other columns in common. Words with null match nothing.
    """
    key = ("length", "number", "piece")
    pieces = lambda df, made: df.withColumn("_key", F.explode(made)).select(*df.columns, *[F.col(f"_key.{k}").alias(f"_{k}") for k in key])
    kept = pieces(left, kept_pieces(normalize(F.col(left_word))))
    asked = pieces(right, asked_pieces(normalize(F.col(right_word))))
    pairs = kept.join(asked, [*on, *[f"_{k}" for k in key]]).drop(*[f"_{k}" for k in key])
    return pairs.where((F.abs(F.length(left_word) - F.length(right_word)) <= REACH) & matches(F.col(left_word), F.col(right_word)))


def folded(word: str) -> str:
    return word.translate(_FOLD).lower()


def within_reach(a: str, b: str) -> bool:
    """Whether two folded words are at a distance of two at most; rows of the table hold what can still matter."""
    if abs(len(a) - len(b)) > REACH:
        return False
    row = {j: j for j in range(min(REACH, len(b)) + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - REACH), min(len(b), i + REACH) + 1):
            best = row.get(j, 9) + 1
            if j:
                best = min(best, new.get(j - 1, 9) + 1, row.get(j - 1, 9) + (x != b[j - 1]))
            new[j] = best
        if min(new.values()) > REACH:
            return False
        row = new
    return row.get(len(b), 9) <= REACH


class NearWords:
    """Words of one batch, by their pieces, in the order in which they were put."""

    def __init__(self) -> None:
        self.by_piece: dict[tuple, list[int]] = {}
        self.words: list[str] = []

    def put(self, group: str, word: str) -> None:
        """The next word, that is compared with words of its group alone."""
        text = folded(word)
        for i in range(1, PIECES + 1):
            start, size = cut(len(text), i)
            self.by_piece.setdefault((group, len(text), i, text[start : start + size]), []).append(len(self.words))
        self.words.append(text)

    def near(self, group: str, word: str) -> Iterator[int]:
        """Numbers of the words that nearly match, in order."""
        text, found = folded(word), set()
        for longer in range(-REACH, min(REACH, len(text)) + 1):
            n = len(text) - longer
            for i in range(1, PIECES + 1):
                start, size = cut(n, i)
                for at in (start + by for by in shifts(i, longer)):
                    if 0 <= at and at + size <= len(text):
                        found.update(self.by_piece.get((group, n, i, text[at : at + size]), ()))
        return (k for k in sorted(found) if within_reach(self.words[k], text))
