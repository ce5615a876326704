import random
import re
import string
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexirank.llm import pii, queries
from lexirank.llm import quality
from lexirank.llm.quality import cotrain_scores

KEY = b"test key"


def gender_of(value):
    return pii.TITLES[re.match(r"\w+", value)[0]]


def drawn(kind, value):
    name = (kind, pii.canonical(kind, value), gender_of(value) if kind == "name" else "")
    return pii.in_place(kind, value, pii.surrogate(*name, KEY))


@pytest.mark.parametrize(
    "kind,value",
    [("phone", "+1 (988) 555-2485"), ("card", "4111 1111 1111 1111"), ("card", "4337166598464399"), ("email", "Jo.Hn7@mail5.example.com"), ("ssn", "123-45-6789"), ("iban", "DE89 3704 0044 0532 0130 00"), ("ip", "43.203.110.141"), ("ip", "10.1.2.3"), ("name", "Mrs. Mary Ann Jones"), ("name", "Господин Иван Петров"), ("name", "Κύριος Νίκος Παππάς"), ("name", "Dr. Ann-Marie Jones")],
)
def test_format_is_kept(kind, value):
    new = drawn(kind, value)
    shape = lambda s: re.sub(r"\d+" if kind == "ip" else r"\d", "0", s) if kind not in ("email", "name", "iban") else ""
    assert new != value and shape(new) == shape(value)
    assert pii.find_entities(f"x {new} y") == [(2, 2 + len(new), kind)]
    assert new == drawn(kind, value)
    if value == "4111 1111 1111 1111":
        digits = new.replace(" ", "")
        assert pii._luhn(digits[:-1]) == int(digits[-1])
    if kind == "ip" and value.startswith("10."):
        assert new.startswith("10.")
    if kind == "name":
        gender, script = gender_of(value), pii._script(value.split(" ", 1)[1])
        assert new.split()[0] == value.split()[0] and re.split("[ -]", new)[1] in [x for g in gender or "fm" for x in pii.GIVEN[script, g]]
        assert pii._script(new.split()[-1]) == script


@pytest.mark.parametrize(
    "kind,value",
    [("card", "2221000000000009"), ("card", "2720 9999 9999 9996"), ("card", "3782 822463 10005"), ("card", "3782-822463-10005"), ("phone", "+49 30 1234567"), ("phone", "+44 20 79460958"), ("phone", "030 1234567"), ("phone", "5551234567"), ("phone", "0301234567")],
)
def test_plain_formats_are_found_and_kept(kind, value):
    assert pii.find_entities(f"x {value}, y") == [(2, 2 + len(value), kind)]
    test_format_is_kept(kind, value)


def test_other_numbers_stay():
    for text in ("at 1700000000 s", "2220000000000000 rows", "0.2345678901", "2345678901.55", "id-5551234567"):
        assert pii.find_entities(text) == []
    assert len({pii.surrogate("card", str(2221 * 10**12 + i * 7), "", KEY) for i in range(3000)}) == 3000


def test_formats_are_permuted():
    assert sorted(pii.permuted(i, 1000, KEY, "t") for i in range(1000)) == list(range(1000))
    for kind, form in (("ssn", "{:09d}"), ("phone", "+1{:010d}"), ("card", "4{:015d}")):
        assert len({pii.surrogate(kind, form.format(i * 7), "", KEY) for i in range(3000)}) == 3000


def test_documents(spark, docs, empty):
    text = "Mr. John Smith, +1 (988) 555-2485, jo@example.com; again JOHN: Mr. John Smith."
    rows = spark.createDataFrame([(1, text), (2, "call +1 (988) 555-2485"), (3, "call +1-988-555-2486"), (4, None), (5, ""), (6, "nothing")], "doc_id long, text string")
    for held in (100, 0):
        got = {r.doc.doc_id: r for r in pii.with_surrogates(rows, KEY, held_redraws=held).collect()}
        names = [e.surrogate for e in got[1].entities if e.kind == "name"]
        assert len(names) == 2 and len(set(names)) == 1 and "John Smith" not in got[1].text and "988" not in got[1].text
        phone = lambda r: next(re.sub(r"\D", "", e.surrogate) for e in r.entities if e.kind == "phone")
        assert phone(got[1]) == phone(got[2]) != phone(got[3])
        assert (got[4].text, got[5].text, got[6].text) == (None, "", "nothing")
    assert pii.with_surrogates(docs, KEY).count() == docs.count() and pii.with_surrogates(empty, KEY).count() == 0


def test_collisions_are_drawn_again(spark, monkeypatch):
    """With a few names to draw from at first, so that most meet: all end with names of their own, and those alone are drawn again that met."""
    whole = pii.surrogate

    def few(kind, entity, gender, key, redraw=0):
        return f"N{int.from_bytes(entity.encode(), 'big') % 7}" if redraw == 0 else whole(kind, entity, gender, key, redraw)

    monkeypatch.setattr(pii, "surrogate", few)
    names = [("name", f"John {chr(65 + i % 26)}{'abcde'[i % 5]}{i}", "m") for i in range(50)]
    entities = spark.createDataFrame(names, "kind string, entity string, gender string")
    again = {(r.kind, r.entity, r.gender): r.redraw for r in pii.checked_redraws(entities, KEY).collect()}
    made = [few(*r, KEY, again.get(r, 0)) for r in names]
    assert len(set(made)) == len(made) and 40 <= len(again) < 50


def test_full_formats_raise_nothing(spark):
    """Every address of a private range, and 97 account numbers that differ in their check digits alone."""
    ips = [("ip", f"192.168.{a}.{b}", "") for a in range(256) for b in range(256)]
    rest = "370400440532013000"
    ibans = [("iban", f"DE{i:02d}{rest}", "") for i in range(100)]
    entities = spark.createDataFrame([*ips, *ibans], "kind string, entity string, gender string")
    assert pii.checked_redraws(entities, KEY).count() == 0
    assert len({pii.surrogate(*r, KEY) for r in ibans}) == 100
    some = {pii.surrogate(*r, KEY) for r in ips[::64]}
    assert len(some) == 1024 and all(x.startswith("192.168.") for x in some)


def test_people_keep_one_name_in_a_text():
    text = "Smith waits. Mr. John Smith met Mrs Anna Smith and Dr. Lee. Mr. Smith and John Smith are one; Smith spoke. Prof. Lee Chan, then Lee. Smithson stays."
    found = [(text[m.start : m.end], m.entity, m.gender, m.part) for m in pii.mentions(text)]
    assert found == [
        ("Mr. John Smith", "John Smith", "m", "whole"), ("Mrs Anna Smith", "Anna Smith", "f", "whole"), ("Dr. Lee", "Lee", "", "whole"), ("Mr. Smith", "John Smith", "m", "last"),
        ("John Smith", "John Smith", "m", "whole"), ("Smith", "John Smith", "m", "last"), ("Prof. Lee Chan", "Lee Chan", "", "whole"), ("Lee", "Lee", "", "last"),
    ]


def test_very_many_entities_in_one_text():
    text = " ".join(f"Mr. Karl Ab{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x jo{i}@example.com +1 (988) 555-{i % 10000:04d};" for i in range(7000))
    assert len(pii.mentions(text)) == 21_000


def brute_surrogates(rows):
    """What must hold of any rows and their surrogates: a list of what doesn't."""
    wrong, of, back = [], {}, {}
    for old, new, entities in rows:
        at, kept = 0, []
        for e in entities:
            kept.append(old[at : e.start])
            at = e.end
            value = old[e.start : e.end]
            if e.kind != "name":
                one = (e.kind, pii.canonical(e.kind, value))
                same = re.sub(r"[^0-9A-Za-z+@.]", "", e.surrogate).lower()
                if of.setdefault(one, same) != same or back.setdefault((e.kind, same), one) != one:
                    wrong.append((value, e.surrogate))
            if e.kind in ("phone", "card", "ssn") and re.sub(r"\d", "0", value) != re.sub(r"\d", "0", e.surrogate):
                wrong.append(("format", value, e.surrogate))
        kept.append((old or "")[at:])
        rebuilt = "".join(x for pair in zip(kept, [*(e.surrogate for e in entities), ""]) for x in pair)
        if rebuilt != (new or "") or (old is None) != (new is None):
            wrong.append(("text", old, new))
    return wrong


def test_query_against_what_must_hold(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = pii.with_surrogates(d, KEY, keep=["doc_id", "text"]).collect()
    assert len(got) == d.count() and sum(len(r.entities) for r in got) > 20
    assert brute_surrogates([(r.doc.text, r.text, r.entities) for r in got]) == []
    query = {r.doc_id: r for r in queries.op5_pii(spark, "/root/testdata/sf0.001").collect()}
    for r in got:
        assert query[r.doc.doc_id].n_entities == len(r.entities) and query[r.doc.doc_id].kinds == ",".join(sorted({e.kind for e in r.entities}))


@pytest.mark.parametrize(
    "text,names",
    [
        ("Frau öffnet die Tür. Herr über alles. Monsieur était là. Señora ñandú.", []),
        ("Frau Über und Mr O'Neil, dann Mr de Gaulle; Gaulle geht.", ["Frau Über", "Mr O'Neil", "Mr de Gaulle", "Gaulle"]),
        ("今天王伟先生来了，张小红女士没来。", ["王伟", "张小红"]),
        ("田中太郎さん と 김철수 씨", ["田中太郎", "김철수"]),
        ("Mr राहुल शर्मा said so", ["Mr राहुल शर्मा"]),
        ("Mme Élodie de la Tour-Petit; Κυρία Άννα Παππά", ["Mme Élodie de la Tour-Petit", "Κυρία Άννα Παππά"]),
    ],
)
def test_names_of_many_scripts(text, names):
    found = [m for m in pii.mentions(text) if m.kind == "name"]
    assert [text[m.start : m.end] for m in found] == names
    drawn = {m.name: pii.surrogate(*m.name, b"k") for m in found}
    assert len(set(drawn.values())) == len(drawn)
    for m in found:
        new = pii.in_place("name", text[m.start : m.end], drawn[m.name], m.part)
        assert new != text[m.start : m.end] and new.strip() and pii._script(new) == pii._script(m.entity)


def test_a_name_of_a_hundred_thousand_mentions_takes_seconds():
    began = time.monotonic()
    found = pii.mentions("Mr. John Smith came. Mr. Smith went. " * 50_000)
    assert len(found) == 100_000 and {m.entity for m in found} == {"John Smith"}
    assert time.monotonic() - began < 15


def test_nothing_is_its_own_surrogate():
    """Of all short addresses, and of every small range, none stays; none of two becomes one."""
    letters = string.ascii_lowercase
    mails = [f"{a}{b}@x.de" for a in letters for b in letters]
    drawn = [pii.surrogate("email", m, "", b"k") for m in mails]
    assert len(set(drawn)) == len(mails) and not any(a.split("@")[0] == b.split("@")[0] for a, b in zip(mails, drawn))
    for size in (2, 3, 10, 97, 676):
        out = [pii.permuted(i, size, b"k", "t") for i in range(size)]
        assert sorted(out) == list(range(size)) and all(a != b for a, b in enumerate(out))


def test_quality_held_out(spark):
    d = "/root/testdata/sf0.01"
    r = queries.op6_quality(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert ((r.score >= 0.5) == (r.quality == 1)).mean() > 0.95
    assert r.score.between(0, 1).all() and r.text_score.between(0, 1).all() and r.meta_score.between(0, 1).all()


def test_quality_of_any_rows(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = cotrain_scores(docs, none).collect()
    assert len(got) == docs.count() and {round(r.score, 9) for r in got} == {0.5}
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0), (3, 0), (6, 1)], "doc_id long, quality int")
    got = cotrain_scores(docs, odd).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert cotrain_scores(empty, odd).count() == 0


def two_views(n, seed, tells=3, flip=0.0, right=0.97, vocab=30):
    """Documents whose words tell their quality a little, and whose source tells it well, by itself."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.5)
        words = [f"{'good' if (y == 1) == (rng.random() >= flip) else 'bad'}{rng.randrange(vocab)}" for _ in range(tells)]
        text = [f"w{rng.randrange(200)}" for _ in range(12)] + words
        rng.shuffle(text)
        source = f"s{(0 if (y == 1) == (rng.random() < right) else 1) * 2 + rng.randrange(2)}"
        rows.append((i, " ".join(text), "en", source, 100, y))
    return rows


def right_by_round(spark, rows, every, rounds):
    """Of documents without labels, those that the text view is right about, by the number of rounds."""
    docs = spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    labels = spark.createDataFrame([(r[0], r[5]) for r in rows if r[0] % every == 0], "doc_id long, quality int")
    found = {}
    for k in rounds:
        got = cotrain_scores(docs, labels, rounds=k).collect()
        found[k] = np.mean([(r.text_score >= 0.5) == (rows[r.doc_id][5] == 1) for r in got if r.doc_id % every])
    return found


def test_views_teach_each_other(spark):
    """75 labels, of which 44 fit a text view that sees words of which a quarter mislead: what the source tells of the others makes it better."""
    right = right_by_round(spark, two_views(3000, 6, tells=6, flip=0.25, right=0.99, vocab=12), 40, (1, quality.ROUNDS))
    assert right[1] < 0.88 and right[quality.ROUNDS] > right[1] + 0.025, right


def test_pseudo_labels_of_one_kind_teach_nothing(spark):
    """So few labels that a view is sure of one kind alone: taken as they come, its pseudo-labels would call everything that kind."""
    right = right_by_round(spark, two_views(4000, 8, tells=8, flip=0.3, right=0.98, vocab=12), 80, (1, quality.ROUNDS))
    assert right[quality.ROUNDS] > right[1] - 0.02 > 0.8, right


def test_weights_of_pseudo_labels():
    d = 2
    sums = np.concatenate([[30, 10], [600, 100], np.zeros(d + d * d), np.full(d + d * d, 1.0), np.full(d + d * d, 100.0)])
    both = quality.weighed(sums, d)  # ten of one kind for each of its labels: 300 and 100 count, as a quarter each
    assert np.allclose(both, 0.25 * (300 / 600 * 1.0 + 100.0))
    sums[3] = 0
    assert not quality.weighed(sums, d).any()


def test_first_round_against_a_plain_fit(spark):
    """Both views by Newton's steps over one array, their lines and their combination."""
    rows = two_views(400, 7)
    docs = spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    labels = spark.createDataFrame([(r[0], r[5]) for r in rows], "doc_id long, quality int")
    got = {r.doc_id: r for r in cotrain_scores(docs, labels, rounds=1).collect()}
    meta = {r.doc_id: r.m for r in docs.select("doc_id", quality.metadata_vector(F.col("source"), F.col("lang"), F.col("n_chars")).alias("m")).collect()}
    texts = [r[1] for r in rows]
    x = np.hstack([quality.text_features(pa.array(texts)), quality.upper_share(texts)[:, None]]).astype(np.float32).astype(float)
    m = np.array([meta[r[0]] for r in rows])
    y = np.array([r[5] for r in rows], dtype=float)
    fold = np.array([zlib.crc32(str(r[0]).encode()) % 5 for r in rows])
    fit, line = ~np.isin(fold, (3, 4)), fold == 4

    def newton(design, at, w, towards, ridge=None):
        ridge = np.diag([1e-6] + [1.0] * (design.shape[1] - 1) if ridge is None else ridge)
        for _ in range(quality.STEPS):
            p = 1 / (1 + np.exp(-np.clip(design[at] @ w, -30, 30)))
            step = np.linalg.solve(design[at].T @ (design[at] * (p * (1 - p))[:, None]) + ridge, design[at].T @ (y[at] - p) - ridge @ (w - towards))
            w = w + step * min(1.0, 1.5 / np.abs(step).max())
        return w

    one = np.ones((len(rows), 1))
    logits = []
    for part, ridge in ((x, quality.ridge_of_text()), (m, None)):
        design = np.hstack([one, (part - part.mean(0)) / (part.std(0) + 1e-6)])
        z = design @ newton(design, fit, np.zeros(design.shape[1]), 0.0, ridge)
        flat = np.hstack([one, z[:, None]])
        logits.append(flat @ newton(flat, line, np.array([0.0, 1.0]), np.array([0.0, 1.0])))
    both = np.stack([one[:, 0], *logits], 1)
    z = both @ newton(both, line, np.array([0.0, 1.0, 0.0]), 0.0)
    for i, r in enumerate(rows):
        for want, mine in zip((*(v[i] for v in logits), z[i]), (got[r[0]].text_score, got[r[0]].meta_score, got[r[0]].score)):
            assert abs(1 / (1 + np.exp(-want)) - mine) < 1e-4
