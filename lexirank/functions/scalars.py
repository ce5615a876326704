"""Scalar functions as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters that are folded, and what they are folded to.
FOLDED_FROM, FOLDED_TO = "ăâîșțşţĂÂÎȘȚŞŢ", "aaiststAAISTST"
# What a message is about. It is about a thing when, for one of its lines, it has one text of each group,
# in lower case. Of the categories, in capitals, the first that fits counts.
MESSAGES: dict[str, list[tuple[tuple[str, ...], ...]]] = {
    "MISSING_CONTENT": [(("missing",), ("content",))],
    "TRUNCATED_JSON": [(("truncat", "unclosed", "unexpected end", "premature"),)],
    "DECIMAL_FORMAT": [(("decimal", "number format"),)],
    "WORD_MISMATCH": [(("word",), ("mismatch",))],
    "MODEL_CRASH": [(("model",), ("crash", "exit code"))],
    "CONNECTIVITY": [(("timed out", "connection refused"),), (("connect",), ("fail",))],
    "unreachable": [(("timed out", "connection refused", "couldn't connect"),)],
    "crash": [(("exit code",),), (("model",), ("crash",))],
    "format refused": [(("response_format",), ("unsupported", "unknown", "must be", "json_schema", "json object"))],
    "schema wanted": [(("response_format",), ("must be",), ("json_schema",))],
    "reasoning refused": [(("reasoning_effort", "thinking", "chat_template_kwargs"), ("unsupported", "unknown", "unexpected", "invalid"))],
    "nothing parsed": [(("no valid results parsed from 0 result nodes",),)],
    "miscounted": [(("expected exactly",), ("selected",))],
}
# What a reviewer may type.
LABEL_INPUTS = {
    "1": "1", "common": "1", "2": "2", "3": "3", "u": "unknown_4_5", "unknown": "unknown_4_5", "unknown_4_5": "unknown_4_5",
    "d": "undecided", "undecided": "undecided", "s": "skip", "skip": "skip", "q": "quit", "quit": "quit",
}

INTEGER = r"^\s*[+-]?\d+\s*$"


def says(message: Column, what: str) -> Column:
    """Whether a message is about one of MESSAGES."""
    low = F.lower(message)
    either, all_of = (lambda a, b: a | b), (lambda a, b: a & b)
    return reduce(either, [reduce(all_of, [reduce(either, [F.contains(low, F.lit(x)) for x in group]) for group in line]) for line in MESSAGES[what]])


def said(message: str, what: str) -> bool:
    """says() of a text in a task."""
    low = message.lower()
    return any(all(any(x in low for x in group) for group in line) for line in MESSAGES[what])


def normalize(word: Column) -> Column:
    """Lower case with the folded letters as their plain ones; other accents stay."""
    return F.lower(F.translate(word, FOLDED_FROM, FOLDED_TO))


def matches(expected: Column, actual: Column) -> Column:
    """Equal, equal when folded, or at an edit distance of 2 at most; the cheap length test comes first."""
    a, b = normalize(expected), normalize(actual)
    near = (F.abs(F.length(a) - F.length(b)) <= 2) & F.levenshtein(a, b, 2).between(0, 2)
    return F.coalesce((expected == actual) | (a == b) | near, F.lit(False))


def median_level(*levels: Column) -> Column:
    """Of those that are not null: the middle one, of two the mean rounded half to even, of none 4."""
    known = F.array_sort(F.array_compact(F.array(*levels)))
    n = F.size(known)
    middle = F.element_at(known, F.floor(n / 2).cast("int") + 1)
    mean = F.bround((F.element_at(known, F.greatest(F.floor(n / 2).cast("int"), F.lit(1))) + middle) / 2)
    return F.when(n == 0, 4).when(n % 2 == 1, middle).otherwise(mean).cast("int")


def spread(*levels: Column) -> Column:
    return F.coalesce(F.greatest(*levels) - F.least(*levels), F.lit(0))


def any_below(limit: float, *confidences: Column) -> Column:
    return F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(c < limit, F.lit(False)) for c in confidences]), F.lit(False))


def merge_any_extremes(median: Column, *levels: Column) -> Column:
    """1 if any level is; 2 if any is and the median is 3 or more; 5 if any is and the median is 3 or 4; else the median."""
    has = lambda x: reduce(lambda a, b: a | b, [F.coalesce(c == x, F.lit(False)) for c in levels])
    return F.when(has(1), 1).when((median >= 3) & has(2), 2).when(median.isin(3, 4) & has(5), 5).otherwise(median)


def outlier_reason(spread_: Column, low: Column, spread_limit: int, confidence_limit: float) -> Column:
    return F.concat_ws(";", F.when(spread_ >= spread_limit, F.lit(f"spread>={spread_limit}")), F.when(low, F.lit(f"low_confidence<{confidence_limit}")))


def slug(text: Column) -> Column:
    """Trimmed, lower case, dashes as underscores, without other characters than letters, digits and underscores."""
    return F.regexp_replace(F.replace(F.lower(F.trim(text)), F.lit("-"), F.lit("_")), r"[^\p{L}\p{N}_]", "")


def run_slug(text: Column) -> Column:
    """A slug of 1 to 40 characters; else an error."""
    s = slug(text)
    return F.when(F.length(s).between(1, 40), s).otherwise(F.raise_error(F.lit("a run's slug has 1 to 40 letters, digits or underscores")).cast("string"))


def chain_slug(text: Column) -> Column:
    return F.coalesce(F.nullif(F.left(slug(text), F.lit(40)), F.lit("")), F.lit("rebalance_run"))


def to_int(text: Column) -> Column:
    """Of a whole number's text its value; of others null, of numbers with a fraction as well."""
    return F.when(text.rlike(INTEGER), F.trim(text)).try_cast("int")


def text_or_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def confidence(text: Column) -> Column:
    """0 to 1 as it is, up to 100 as a percentage, anything else 0.5."""
    x = F.trim(text).try_cast("double")
    return F.when(x.isNull() | F.isnan(x), 0.5).when(x.between(0, 1), x).when((x > 1) & (x <= 100), x / 100).otherwise(0.5)


def tag(text: Column) -> Column:
    return F.left(F.coalesce(text_or_null(text), F.lit("uncertain")), F.lit(16))


def selection_word(text: Column) -> Column:
    """What two spellings of a selected word have in common."""
    plain = F.translate(F.lower(F.trim(text)), "’", "'")
    return F.regexp_replace(F.regexp_replace(plain, r"(?U)^[^\w]+", ""), r"(?U)[^\w]+$", "")


def strip_fences(text: Column) -> Column:
    """Without a leading code fence, bare or tagged as JSON, and a trailing one."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), r"^```(?:json|JSON)?\s*", ""), r"\s*```$", ""))


def model_content(body: Column) -> Column:
    """The text of a response: of its first choice, its message, or its output."""
    return F.coalesce(*[F.get_json_object(body, path) for path in ("$.choices[0].message.content", "$.message.content", "$.output_text")])


def results_text(content: Column) -> Column:
    """The JSON array of results: the content itself, or one of its usual fields."""
    return F.coalesce(F.when(F.trim(content).startswith("["), content), *[F.get_json_object(content, f"$.{k}") for k in ("results", "items", "data", "predictions")])


def error_category(message: Column) -> Column:
    return F.coalesce(*[F.when(says(message, name), name) for name in MESSAGES if name.isupper()], F.lit("OTHER"))


def is_connectivity(message: Column) -> Column:
    return says(message, "unreachable")


def is_model_crash(message: Column) -> Column:
    return says(message, "crash")


def is_format_unsupported(message: Column) -> Column:
    return says(message, "format refused")


def wants_schema(message: Column) -> Column:
    return says(message, "schema wanted")


def is_reasoning_unsupported(message: Column) -> Column:
    return says(message, "reasoning refused")


def is_empty_parse(message: Column) -> Column:
    return says(message, "nothing parsed")


def is_count_mismatch(message: Column) -> Column:
    return says(message, "miscounted")


def duration_text(seconds: Column) -> Column:
    s = F.floor(seconds).cast("long")
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    return F.when(h > 0, F.format_string("%dh%dm%ds", h, m, r)).when(m > 0, F.format_string("%dm%ds", m, r)).otherwise(F.format_string("%ds", r))


def excerpt(text: Column, most: int = 500) -> Column:
    flat = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.length(flat) > most, F.concat(F.left(flat, F.lit(most)), F.lit("..."))).otherwise(flat)


def split_expected(total: Column, left: Column, size: Column) -> Column:
    """How many of a batch's picks its left half should have."""
    return F.bround(total * left / size).cast("int")


def disables_schema(unresolved: Column, size: Column) -> Column:
    return unresolved >= F.greatest(F.lit(1), F.ceil(size * 0.2))


def score_tokens(size: Column, most: int) -> Column:
    return F.least(F.greatest(size * 40 + 200, F.lit(256)), F.lit(most))


def select_tokens(expected: Column, most: int) -> Column:
    return F.least(F.greatest(expected * 24 + 128, F.lit(128)), F.lit(most), F.lit(1024))


def rendered(template: Column, **values: Column) -> Column:
    """A template with {name} placeholders filled."""
    return reduce(lambda t, kv: F.replace(t, F.lit("{" + kv[0] + "}"), kv[1].cast("string")), values.items(), template)


def review_label(typed: Column) -> Column:
    pairs = [F.lit(x) for kv in LABEL_INPUTS.items() for x in kv]
    return F.element_at(F.create_map(*pairs), F.lower(F.trim(typed)))


def switch_sign(previous: Column, new: Column) -> Column:
    return F.when(new < previous, "+").when(new > previous, "-").otherwise("=")
