import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexirank.llm.alignment import Aligner, align, aligned_with_counts, label_string
from lexirank.llm.chunks import pieces

from .conftest import ROWS

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


class Plain:
    """The contract by the libraries' own calls on whole texts and by sets of byte ranges."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in keep]
        self.byte = {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}

    def tokens(self, text):
        """Ids and byte ranges of both; None where there are no tokens."""
        if not text:
            return None
        ids_a = self.a.encode(" " + text, add_special_tokens=False).ids
        by_a = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in ids_a]
        ids_b = self.b.encode(text)
        by_b = []
        for i in ids_b:
            piece = self.b.id_to_piece(i)
            by_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        if not b"".join(by_a) == b"".join(by_b) == (" " + text).encode():
            return None

        def ranges(ids, parts):
            out, at = [], 0
            for i, p in zip(ids, parts):
                out.append((i, at, at + len(p)))
                at += len(p)
            return out

        return ranges(ids_a, by_a), ranges(ids_b, by_b)

    def facts(self, text):
        found = self.tokens(text)
        if not found:
            return (0, 0, 0, 0, ""), Counter()
        a, b = found
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, start = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in t if start <= s and e <= cut) for t in (a, b)))
            start = cut
        links = Counter((i, j) for i, s, e in a for j, u, v in b if s < v and u < e)
        return (len(a), len(b), len(groups), sum(links.values()), hashlib.sha256(";".join(groups).encode()).hexdigest()), links

    def table(self, texts):
        found = [self.facts(t) for t in texts]
        count = Counter(p for _, links in found for p in links)
        best = defaultdict(int)
        for (i, _), n in count.items():
            best[i] = max(best[i], n)
        return [
            (*f[:4], sum(k for p, k in links.items() if count[p] == best[p[0]]), sum(k * count[p] for p, k in links.items()), f[4]) for f, links in found
        ]


@pytest.fixture(scope="module")
def plain():
    return Plain()


def test_labels():
    import numpy as np

    assert label_string(5, np.array([2, 5]), np.array([1, 2, 5])) == b"23003"


TEXT = st.text(alphabet="  \n\n\t\r 　▁abcé日😀19.,!'s<|endoftext|></s>\0", max_size=40)


@given(st.lists(TEXT, min_size=1, max_size=4))
@settings(max_examples=300, deadline=None)
def test_chunks_align_as_whole_texts_do(texts):
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    from lexirank.llm import alignment

    own = Plain.__dict__.get("_own") or (Plain(), Aligner(A, B))
    Plain._own = own
    plain, aligner = own
    odd = pc.match_substring_regex(pa.array(texts, pa.string()), alignment._ODD).to_numpy(zero_copy_only=False)
    numbers, groups, doc, pair, times = aligner.block(texts, odd)
    for k, text in enumerate(texts):
        want, links = plain.facts(text)
        if numbers[k, 4] or not text:
            assert want[0] == 0
            continue
        assert (*numbers[k, :4].tolist(), hashlib.sha256(groups[k].encode()).hexdigest()) == want
        got = {divmod(int(p), aligner.b_ids): int(n) for p, n in zip(pair[doc == k], times[doc == k])}
        assert got == dict(links)
    assert np.all(np.diff(doc) >= 0)


def test_edge_rows(spark, docs, empty, plain):
    rows = [r for r in ROWS if r[0] != 6]
    got = aligned_with_counts(docs.filter("doc_id is null or doc_id <> 6"), A, B, held_pairs=20)
    want = Counter((r[0], *w) for r, w in zip(rows, plain.table([r[1] for r in rows])))
    assert Counter((r.doc_id, *[r[c] for c in COLUMNS]) for r in got.collect()) == want
    assert aligned_with_counts(empty, A, B).count() == 0


@pytest.mark.parametrize("held", [0, 300, 1 << 18])
def test_held_and_joined_counts_agree(spark, plain, held):
    """All counts by the join, some, and all held by tasks give what the plain version gives."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(30).collect()]
    texts = [t[:600] for t in texts] + [texts[0][:600]] * 5
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = aligned_with_counts(frame, A, B, held_pairs=held).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in got] == plain.table(texts)


def test_a_text_in_many_parts_is_one_document(spark, monkeypatch):
    from lexirank.llm import alignment, chunks

    texts = ["The cat  sat on\nthe mat, " * 40, "short", "a \n b " * 60, "don't stop " * 50]
    aligner = Aligner(A, B)
    monkeypatch.setitem(alignment._ALIGNERS, (A, B), aligner)
    whole = list(alignment._aligned(A, B)(iter([_batch(texts)])))
    monkeypatch.setattr(alignment, "pieces", lambda t: chunks.pieces(t, 97))
    cut = list(alignment._aligned(A, B)(iter([_batch(texts)])))
    assert len(list(pieces(texts, 97))) > 5
    rows = lambda batches: [r for b in batches for r in b.to_pylist()]
    assert rows(cut) == rows(whole)


def _batch(texts):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])


def test_query_on_all_rows(spark, plain):
    from lexirank.llm.queries import op13_alignment

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in op13_alignment(spark, sf).collect()}
    rows = docs.filter("length(text) < 700").collect()
    assert len(got) == docs.count() and len(rows) > 20
    for r in rows:
        want, links = plain.facts(r.text)
        assert tuple(got[r.doc_id][c] for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")) == want
    held = align(docs, A, B).selectExpr("explode(pairs) p").groupBy("p").count().collect()
    assert sum(r["count"] for r in held) > 0
