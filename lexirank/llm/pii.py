"""Personal data: detected entities get keyed surrogates of the same type and format."""

from __future__ import annotations

import bisect
import hashlib
import hmac
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import materialize

#: Entities drawn again that every task holds; more of them reach their documents by a join.
HELD_REDRAWS = 100_000

# Titles with the gender that they tell, if they do, and given names by gender and script, all public knowledge.
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Sir": "m", "Dr": "", "Prof": "", "Professor": "", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f",
    "Mme": "f", "Mlle": "f", "Señor": "m", "Señora": "f", "Señorita": "f", "Don": "m", "Doña": "f", "Signor": "m", "Signora": "f", "Господин": "m", "Госпожа": "f",
    "Κύριος": "m", "Κυρία": "f",
}
# What follows a name in Chinese, Japanese and Korean, with the gender it tells; common Chinese surnames, of which a
# name there begins with one; small words within European names.
HONORIFICS = {"先生": "m", "女士": "f", "小姐": "f", "太太": "f", "夫人": "f", "教授": "", "さん": "", "様": "", "氏": "", "씨": "", "님": "", "선생님": ""}
SURNAMES = "王李张張刘劉陈陳杨楊赵趙黄黃周吴吳徐孙孫朱马馬胡郭何林高罗羅郑鄭梁谢謝宋唐许許韩韓冯馮邓鄧曹彭曾"
PARTICLES = "al bin da de del della den der di du ibn la le ter van von zu".split()
GIVEN = {
    ("latin", "f"): "Alma Anna Berta Carla Clara Diana Elena Emma Flora Greta Helga Ida Julia Laura Lena Maria Mona Nina Nora Olga Paula Rosa Sara Tina Vera".split(),
    ("latin", "m"): "Adam Anton Bruno Carl David Emil Erik Felix Georg Hans Hugo Ivan Jakob Karl Leon Marco Max Nils Oscar Otto Paul Peter Rolf Simon Viktor".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Зоя Инна Ирина Лидия Мария Нина Ольга Роза София Тамара".split(),
    ("greek", "f"): "Αθηνά Άννα Ελένη Ειρήνη Ζωή Κατερίνα Μαρία Νίκη Σοφία".split(),
    ("greek", "m"): "Αλέξης Γιώργος Δημήτρης Ηλίας Κώστας Νίκος Παύλος Πέτρος Σταύρος".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Игорь Лев Максим Олег Павел Роман Семён Юрий".split(),
}
_LETTERS = {
    "latin": ("bcdfghklmnprstvz", "aeiou"),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу"),
    "greek": ("βγδζκλμνπρστ", "αεηιο"),
    "hebrew": ("בגדזחטכלמנספצקרשת", "אהוי"),
    "arabic": ("بتثجحدرزسشصطعفقكلمن", "اوي"),
    "devanagari": ("कखगघचछजटडतदनपबभमरलवसह", "अइउएओ"),
    "kana": ("カキクケサシスセタツテナニネ", "アイウエオ"),
    "hangul": ("가나다라마바사아자차", "고노도로모보소오조초"),
    "han": ("王李张刘陈杨赵黄周吴徐孙朱马胡", "安平文明华国建林"),
}
_BLOCKS = (
    ("cyrillic", 0x0400, 0x052F), ("greek", 0x0370, 0x03FF), ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x06FF), ("devanagari", 0x0900, 0x097F),
    ("kana", 0x3040, 0x30FF), ("hangul", 0xAC00, 0xD7A3), ("han", 0x4E00, 0x9FFF),
)

_WORD = r"(?:\p{Lu}['’]\p{Lu}[\p{L}\p{M}]+|[\p{Lu}\p{Lt}\p{Lo}][\p{L}\p{M}]+)"
_SMALL = rf"(?:(?:{'|'.join(PARTICLES)})[ \u00a0]){{0,3}}"
_NAME = rf"{_SMALL}{_WORD}(?:[ \u00a0]{_SMALL}{_WORD}|-{_WORD}){{0,2}}"
_AFTER = lambda *names: rf"(?=[ \u00a0]?(?:{'|'.join(names)}))"
_BEFORE_HONORIFIC = "|".join([
    rf"[{SURNAMES}]\p{{Han}}{{1,2}}{_AFTER('先生', '女士', '小姐', '太太', '夫人', '教授')}",
    rf"(?<![\p{{Han}}\p{{Katakana}}])[\p{{Han}}\p{{Katakana}}ー]{{2,6}}{_AFTER('さん', '様', '氏')}",
    rf"(?<!\p{{Hangul}})\p{{Hangul}}{{2,4}}[ \u00a0]?{_AFTER('씨', '님', '선생님')}",
])

_FINDERS = (
    ("email", re.compile(r"(?<![\w.+-])[A-Za-z0-9][\w.+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}\b"), "@"),
    ("ip", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w.]*\d)"), "."),
    ("iban", re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"), None),
    ("card", re.compile(r"(?<![\w.-])(?:[3-6]\d{3}(?:([ -]?)\d{4})(?:\1\d{4})(?:\1\d{1,7})|2(?:22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720)([ -]?)\d{4}\2\d{4}\2\d{4}|3\d{3}([ -])\d{6}\3\d{5})(?![\w-])"), None),
    ("phone", re.compile(
        r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]\d{3,4}(?![\w-])|(?<![\w.])\+\d{8,14}(?!\w)"
        r"|(?<![\w.])\+\d{1,3}[ .-]?(?:\(\d{1,5}\)|\d{1,5})[ .-]?\d{3,4}[ .-]?\d{2,4}(?![\w-])"  # two groups after the country
        r"|(?<![\w.+-])(?:0\d{1,4}[ -]\d{5,8}|0\d{9,10}|[2-9]\d{9})(?![\w-]|\.\d)"  # national, in two groups or one
    ), None),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"), "-"),
    ("name", regex.compile(rf"\b(?:{'|'.join(TITLES)})\b\.?[ \u00a0]+{_NAME}|{_BEFORE_HONORIFIC}"), None),
)
_ANY_DIGIT = re.compile(r"\d[\d .()-]{5}")
_ANY_TITLE = re.compile("|".join([*TITLES, *HONORIFICS]))


class Mention(NamedTuple):
    """A place in a text, and whom or what it names. part: of a name, the whole or its last word alone."""

    start: int
    end: int
    kind: str
    entity: str
    gender: str
    part: str = "whole"

    @property
    def name(self) -> tuple[str, str, str]:
        return self.kind, self.entity, self.gender


_HEAD = re.compile(r"(\w+)\.?[\u0020\u00a0]+")
_CAPITAL = regex.compile(_WORD)
_WHOLE = regex.compile(_NAME)
_HONORIFIC = re.compile(r"[ \u00a0]?(" + "|".join(sorted(HONORIFICS, key=len, reverse=True)) + ")")


def titled(text: str, start: int, end: int) -> tuple[int, int, str]:
    """Of a name's span where the name itself begins and ends, and the gender that the title before it, or what follows it, tells."""
    head = _HEAD.match(text, start, end)
    if head and head[1] in TITLES:
        return head.end(), end, TITLES[head[1]]
    after = _HONORIFIC.match(text, end - (text[end - 1] in " \u00a0"))
    return start, end - (text[end - 1] in " \u00a0"), HONORIFICS[after[1]] if after else ""


def find_entities(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) of entities, apart, in order; of overlapping ones that found first in the order of kinds."""
    starts: list[int] = []
    found: list[tuple[int, int, str]] = []
    digits, title = _ANY_DIGIT.search(text), _ANY_TITLE.search(text)
    for kind, pattern, needs in _FINDERS:
        if needs and needs not in text or kind == "name" and not title or kind not in ("email", "name") and not digits:
            continue
        fresh = []
        for m in pattern.finditer(text):
            i = bisect.bisect_right(starts, m.start())
            if not (i and found[i - 1][1] > m.start() or i < len(found) and starts[i] < m.end()):
                fresh.append((m.start(), m.end(), kind))
        if fresh:
            found = sorted(found + fresh)
            starts = [a for a, _, _ in found]
    return found


def mentions(text: str) -> list[Mention]:
    """The entities of a text, in order.

    A title with a last name alone is a mention of the person of the text who has it as last name, if one does: of
    several of the title's gender the one named last before it, or first after it. Once a person has been
    named with a title, the name, and its last word by itself, are mentions of that person too. What has been named is
    kept by name, so that the work grows with the text.
    """
    found = []
    for a, b, kind in find_entities(text):
        end, gender = b, ""
        if kind == "name":
            _, end, gender = titled(text, a, b)
        found.append(Mention(a, end, kind, canonical(kind, text[a:end]), gender))
    people = [m for m in found if m.kind == "name"]
    if not people:
        return found
    gender: dict[str, str] = {}
    for m in people:
        if m.gender:
            gender.setdefault(m.entity, m.gender)
    of = lambda m: m.gender or gender.get(m.entity, "")
    ends = lambda m: re.split("[ -]", m.entity)[-1]
    several = lambda m: " " in m.entity or "-" in m.entity
    earliest: dict[tuple[str, str], Mention] = {}
    for m in people:
        if several(m):
            earliest.setdefault((ends(m), of(m)), m)
    latest: dict[tuple[str, str], Mention] = {}

    def person(m: Mention) -> Mention:
        own = of(m)
        if several(m):
            latest[ends(m), own] = m
            return m._replace(gender=own)
        fits = [own, ""] if own else ["", "m", "f"]
        before = [latest[m.entity, g] for g in dict.fromkeys(fits) if (m.entity, g) in latest]
        after = [earliest[m.entity, g] for g in dict.fromkeys(fits) if (m.entity, g) in earliest]
        p = max(before, key=lambda p: p.start) if before else min(after, key=lambda p: p.start) if after else None
        return m._replace(gender=own) if p is None else m._replace(entity=p.entity, gender=of(p), part="last")

    found = [person(m) if m.kind == "name" else m for m in found]
    named, last = {}, {}
    more, end, at, told = [], -1, 0, 0
    for w in _CAPITAL.finditer(text):
        a, b = w.span()
        while told < len(found) and found[told].start < a:
            if found[told].kind == "name":
                named[found[told].entity] = last[ends(found[told])] = found[told]
            told += 1
        while at < len(found) and found[at].end <= a:
            at += 1
        if a < end or at < len(found) and found[at].start < b or a and text[a - 1].isalnum():
            continue
        whole = _WHOLE.match(text, a)
        cuts = [m.start() for m in re.finditer("[ -]", whole[0])] if whole else []
        known = next((n for n in (whole[0][:c] for c in [len(whole[0]), *reversed(cuts)]) if n in named and " " in n), None) if cuts else None
        if known and (at == len(found) or a + len(known) <= found[at].start):
            end = a + len(known)
            more.append(named[known]._replace(start=a, end=end, part="whole"))
        elif w[0] in last:
            end = b
            more.append(last[w[0]]._replace(start=a, end=b, part="last"))
    return sorted([*found, *more])


def canonical(kind: str, value: str) -> str:
    """What two mentions of one entity have in common: case of mail addresses, separators of numbers and spaces of names don't tell."""
    if kind == "email":
        return value.lower()
    if kind == "ip":
        return value
    if kind == "name":
        words = value.split()
        return " ".join(words[1:] if len(words) > 1 and words[0].rstrip(".") in TITLES else words)
    return re.sub(r"[^0-9A-Za-z+]", "", value)


def _feistel(number: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of 0..size-1, or its inverse: a balanced Feistel network, walked until it is back in the range."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = number >> half, number & mask
        for r in reversed(range(8)) if back else range(8):
            known = left if back else right
            digest = hmac.new(key, f"{tweak}|{r}|{half}|{known}".encode(), hashlib.sha256).digest()
            bits = int.from_bytes(digest, "big") & mask
            left, right = (right ^ bits, left) if back else (right, left ^ bits)
        number = (left << half) | right
        if number < size:
            return number


def permuted(number: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of 0..size-1 that leaves no number where it is: a step along a keyed order of all of them."""
    if size < 2:
        return number
    step = 1 + int.from_bytes(hmac.new(key, f"{tweak}|step|{size}".encode(), hashlib.sha256).digest(), "big") % (size - 1)
    return _feistel((_feistel(number, size, key, tweak) + step) % size, size, key, tweak, back=True)


def _like(value: str, key: bytes, tweak: str) -> str:
    """A string of the same pattern: digits for digits, small and capital ASCII letters for such, all else as it is."""
    sets = ["0123456789" if c.isascii() and c.isdigit() else "abcdefghijklmnopqrstuvwxyz" if "a" <= c <= "z" else "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if "A" <= c <= "Z" else c for c in value]
    size, number = 1, 0
    for s, c in zip(sets, value):
        number, size = number * len(s) + s.index(c), size * len(s)
    pattern = "".join(s[0] for s in sets)
    number = permuted(number, size, key, f"{tweak}|{pattern}")
    out = []
    for s in reversed(sets):
        number, at = divmod(number, len(s))
        out.append(s[at])
    return "".join(reversed(out))


def _luhn(digits: str) -> int:
    total = sum(int(d) if i % 2 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return -total % 10


def _script(name: str) -> str:
    return next((script for script, low, high in _BLOCKS if any(low <= ord(c) <= high for c in name)), "latin")


def surrogate(kind: str, entity: str, gender: str, key: bytes, redraw: int = 0) -> str:
    """The canonical surrogate of a canonical entity: for one key, kind, format and redraw different entities get different ones.

    Mail addresses keep their last label and the pattern of the rest, addresses of one host staying together.
    Cards keep their issuer digit, and their check digit where it was right; IBANs their country with right check
    digits; phones a country code; private and public IP addresses stay such. Names get a given name of the
    gender their title tells, and surnames of as many parts, in the script of the original.
    """
    tweak = f"{kind}|{redraw}"
    if kind == "email":
        local, _, host = entity.partition("@")
        labels = host.split(".")
        return f"{_like(local, key, f'{tweak}|{host}')}@{_like('.'.join(labels[:-1]), key, tweak)}.{labels[-1]}"
    if kind == "card":
        if entity[0] == "2":  # issuers 2221 to 2720
            rest = len(entity) - 5
            number = permuted(int(entity[:-1]) - 2221 * 10**rest, 500 * 10**rest, key, f"{tweak}2|{rest}")
            body = str(2221 * 10**rest + number)
        else:
            body = entity[0] + _like(entity[1:-1], key, tweak + entity[0])
        was, check, last = _luhn(entity[:-1]), _luhn(body), int(entity[-1])
        if last == was:
            return body + str(check)
        wrong = lambda right: [d for d in range(10) if d != right]  # noqa: E731  as many either way, so none meet
        return body + str(wrong(check)[permuted(wrong(was).index(last), 9, key, f"{tweak}|{body}")])
    if kind == "iban":
        country, rest = entity[:2], _like(entity[4:], key, tweak + entity[:2])
        check = lambda rest: 98 - int("".join(str(int(c, 36)) for c in f"{rest}{country}00")) % 97
        return f"{country}{(check(rest) + int(entity[2:4]) - check(entity[4:])) % 100:02d}{rest}"  # right where it was right, and as far off where not
    if kind == "ip":
        octets = [int(x) for x in entity.split(".")]
        number = int.from_bytes(bytes(octets), "big")
        for base, bits in ((10 << 24, 24), ((172 << 24) + (16 << 16), 20), ((192 << 24) + (168 << 16), 16), (127 << 24, 24), ((169 << 24) + (254 << 16), 16)):
            if number >> bits == base >> bits:
                return ".".join(map(str, (base + permuted(number - base, 1 << bits, key, f"{tweak}|{base}")).to_bytes(4, "big")))
        while True:
            number = permuted(number, 1 << 32, key, tweak)
            a, b = number >> 24, (number >> 16) & 255
            if not (a in (0, 10, 127) or a >= 224 or (a == 172 and 16 <= b < 32) or (a, b) in ((192, 168), (169, 254))) or octets[0] in (0,) or octets[0] >= 224:
                return ".".join(map(str, number.to_bytes(4, "big")))
    if kind == "name":
        script, parts = _script(entity), [w for w in re.split("[ -]", entity) if w not in PARTICLES]
        hard, soft = _LETTERS[script]
        given = [x for g in (gender or "fm") for x in GIVEN.get((script, g), ())]
        number = int.from_bytes(hmac.new(key, f"{tweak}|{gender}|{entity}".encode(), hashlib.sha256).digest(), "big")
        out = []
        if len(parts) > 1 and given:
            number, at = divmod(number, len(given))
            out.append(given[at])
        for _ in parts[len(out) :]:
            word = ""
            for _ in range(3 + redraw):  # every redraw has more names to draw from than the one before
                number, at = divmod(number, len(hard) * len(soft))
                word += hard[at // len(soft)] + soft[at % len(soft)]
            number, at = divmod(number, len(hard))
            out.append((word + hard[at]).capitalize())
        return " ".join(out)
    if kind == "phone" and entity.startswith("+"):
        code = 2 if entity[1] in "17" else 3
        return entity[:code] + _like(entity[code:], key, tweak + entity[:code])
    if kind == "phone":  # the first digit tells a number without separators from other ones
        return entity[0] + _like(entity[1:], key, tweak + entity[0])
    return _like(entity, key, tweak)


def in_place(kind: str, value: str, drawn: str, part: str = "whole") -> str:
    """The surrogate in the format of a mention: its separators, its case, its title, its part of a name."""
    if kind == "name":
        head = _HEAD.match(value)
        title = head[0] if head and head[1] in TITLES else ""
        if part == "last":
            return title + drawn.split()[-1]
        words = iter(drawn.split())
        return title + "".join(w if i % 2 or w in PARTICLES else next(words, "") for i, w in enumerate(re.split("([ \u00a0-]+)", value[len(title) :])))
    if kind == "email":
        return drawn.upper() if value.isupper() else drawn
    if kind == "ip":
        return drawn
    rest = iter(drawn)
    return "".join(next(rest) if c.isalnum() or c == "+" else c for c in value)


def _detector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = sorted({m.name for text in batch.column(0).to_pylist() for m in mentions(text)})
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], names=["kind", "entity", "gender"])


def _drawer(key: bytes):
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            made = [surrogate(kind, entity, gender, key, redraw) for kind, entity, gender, redraw in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=[*batch.schema.names, "drawn"])

    return draw


def checked_redraws(entities: DataFrame, key: bytes) -> DataFrame:
    """Entities (kind, entity, gender; distinct) whose surrogates had to be drawn again, and how often (redraw).

    A surrogate may not be another entity's. Of entities that meet all but the first are drawn again, and those
    alone. Formats are permuted, so only names meet by chance; every redraw of a name has so many times more to draw
    from that rounds end. That a surrogate is a real entity of some text does no harm: that one has another surrogate.
    """
    fields = "kind string, entity string, gender string, redraw int, drawn string"
    now, settled, redrawn, step = entities.withColumn("redraw", F.lit(0)), None, None, 0
    while True:
        drawn = materialize(now.mapInArrow(_drawer(key), fields), "surrogates")
        new = drawn.withColumn("_new", F.lit(1))
        if settled is not None:  # only those that a new one may meet
            new = new.unionByName(settled.join(drawn.select("kind", "drawn").distinct(), ["kind", "drawn"], "left_semi").withColumn("_new", F.lit(0)))
        first = materialize(new.groupBy("kind", "drawn").agg(F.min(F.struct("_new", "entity", "gender")).alias("keeps")), "first")
        state = drawn.join(first.hint("merge"), ["kind", "drawn"]).withColumn("bad", (F.col("keeps._new") == 0) | (F.struct("entity", "gender") != F.struct("keeps.entity", "keeps.gender")))
        state = materialize(state.drop("keeps"), "redraws")
        good = state.filter("not bad").drop("bad")
        settled = good if settled is None else settled.unionByName(good)
        if step:
            redrawn = good if redrawn is None else redrawn.unionByName(good)
        bad = state.filter("bad")
        if bad.isEmpty():
            out = settled.limit(0) if redrawn is None else redrawn
            return out.select("kind", "entity", "gender", "redraw")
        now, step = bad.select("kind", "entity", "gender", (F.col("redraw") + 1).alias("redraw")), step + 1


REPLACED = "text string, entities array<struct<kind:string,start:int,end:int,surrogate:string>>"


def _replacer(key: bytes, held: dict | None):
    def replace_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, str] = {}
        for batch in batches:
            texts, notes = [], []
            own = batch.column(2).to_pylist() if held is None else None
            for i, text in enumerate(batch.column(1).to_pylist()):
                at, out, note = 0, [], []
                again = held if own is None else {(x["kind"], x["entity"], x["gender"]): x["redraw"] for x in own[i] or ()}
                for m in mentions(text or ""):
                    a, b, kind, name = m.start, m.end, m.kind, m.name
                    value = text[a:b]
                    redraw = again.get(name, 0)
                    if (name, redraw) not in known:
                        if len(known) > 200_000:
                            known.clear()
                        known[name, redraw] = surrogate(*name, key, redraw)
                    new = in_place(kind, value, known[name, redraw], m.part)
                    out += [text[at:a], new]
                    note.append({"kind": kind, "start": a, "end": b, "surrogate": new})
                    at = b
                texts.append(text if not out else "".join([*out, text[at:]]))
                notes.append(note)
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("surrogate", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(notes, kind)], names=["doc", "text", "entities"])

    return replace_batches


def with_surrogates(docs: DataFrame, key: bytes, *, text_col: str = "text", keep: list[str] | None = None, held_redraws: int = HELD_REDRAWS) -> DataFrame:
    """doc (a struct of the row, or of the columns to keep), its text with surrogates, and entities (spans in the old text).

    One entity has one surrogate in all documents, under one key; two have two. A null text stays null, an empty
    one empty, a text without entities as it is; rows that repeat are answered each; an empty table gives none.
    """
    text = docs[text_col].cast("string")
    found = docs.select(F.coalesce(text, F.lit("")).alias("text")).mapInArrow(_detector, "kind string, entity string, gender string")
    again = checked_redraws(materialize(found.distinct(), "entities"), key)
    few = again.limit(held_redraws + 1).collect()
    rows = docs.select(F.struct(*[docs[c] for c in keep or docs.columns]).alias("doc"), text.alias("text"))
    fields = T.StructType([rows.schema.fields[0], *T.StructType.fromDDL(REPLACED).fields])
    if len(few) <= held_redraws:
        return rows.mapInArrow(_replacer(key, {(r["kind"], r["entity"], r["gender"]): r["redraw"] for r in few}), fields)
    rows = rows.withColumn("key", F.xxhash64("text"))
    mentions = rows.select("key", "text").dropDuplicates(["key"]).mapInArrow(_mentions, "key long, kind string, entity string, gender string")
    own = mentions.join(again, ["kind", "entity", "gender"]).groupBy("key").agg(F.collect_set(F.struct("kind", "entity", "gender", "redraw")).alias("own"))
    own = materialize(own, "own-redraws")  # a written table, so that a text that very many rows have is split
    return rows.join(own.hint("merge"), "key", "left").select("doc", "text", "own").mapInArrow(_replacer(key, None), fields)


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = set()
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows |= {(key, *m.name) for m in mentions(text or "")}
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["key", "kind", "entity", "gender"])
