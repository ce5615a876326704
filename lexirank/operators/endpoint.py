"""A chat endpoint as a scorer: which flavour it speaks, requests, their size limits, and what it refuses."""

from __future__ import annotations

import http.client
import json
import os
import re
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime
from urllib.parse import urlsplit

import pandas as pd

from ..functions.repair import parse_content
from ..functions.scalars import said
from .journal import Journal

# Where an endpoint is looked for, paths by flavour, time and token limits.
BASE_URL = "http://127.0.0.1:1234"
PATHS = {"openai": ("/v1/models", "/v1/chat/completions"), "native": ("/api/v1/models", "/api/v1/chat")}
TIMEOUT, PREFLIGHT_TIMEOUT, TOKENS = 300, 5, 8000
FORMATS = ("json_object", "json_schema", "none")
#: Entries of a file of the request log.
ENTRIES = 100


@dataclass(frozen=True)
class Profile:
    """Sampling of a model and its limits; what is None isn't sent."""

    temperature: float | None = 0.0
    top_k: int | None = 40
    top_p: float | None = 1.0
    max_tokens: int | None = None
    reasoning_effort: str | None = None
    thinking: str | None = None
    enable_thinking: bool | None = None
    extra: dict = field(default_factory=dict)


# Profiles by model in lower case; "" for any other.
PROFILES: dict[str, Profile] = {
    "": Profile(),
    "openai/gpt-oss-20b": Profile(max_tokens=4096, reasoning_effort="low"),
    "zai-org/glm-4.7-flash": Profile(max_tokens=2048, reasoning_effort="low", thinking="disabled", enable_thinking=False),
    "ministral-3-8b-instruct-2512-mixed-8-6-bit": Profile(max_tokens=3072),
    "mlx-community/eurollm-22b-instruct-2512-mlx-4bit": Profile(max_tokens=3072),
    "eurollm-22b-instruct-2512-mlx": Profile(max_tokens=3072),
}


def profile_of(model: str) -> Profile:
    return PROFILES.get(model.strip().lower(), PROFILES[""])


@dataclass(frozen=True)
class Endpoint:
    base: str
    flavour: str
    #: The base is where chats are posted, and there is no list of models.
    exact: bool = False

    def url(self, what: str) -> str | None:
        if self.exact:
            return self.base if what == "chat" else None
        return self.base.rstrip("/") + PATHS[self.flavour][("models", "chat").index(what)]


def _get(url: str, timeout: float) -> str:
    with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310
        return r.read().decode()


def detect(endpoint: str | None = None, base: str | None = None, get: Callable[[str, float], str] = _get) -> Endpoint:
    """An endpoint named by its path has that path's flavour, and is used as it stands if the path is of none.

    Else the flavours are tried in turn, and the first stands if none answers.
    """
    for flavour, (_, chat) in PATHS.items():
        if endpoint and endpoint.rstrip("/").endswith(chat):
            return Endpoint(endpoint.rstrip("/")[: -len(chat)], flavour)
    if endpoint and urlsplit(endpoint).path.strip("/"):
        return Endpoint(endpoint.strip(), next(iter(PATHS)), exact=True)
    root = (endpoint or base or BASE_URL).strip().rstrip("/")
    for flavour in PATHS:
        try:
            get(Endpoint(root, flavour).url("models"), PREFLIGHT_TIMEOUT)
            return Endpoint(root, flavour)
        except (OSError, ValueError):
            continue
    return Endpoint(root, next(iter(PATHS)))


def preflight(endpoint: Endpoint, model: str, get: Callable[[str, float], str] = _get) -> list[str]:
    """Warnings; an endpoint that doesn't answer is an error. One without a list of models isn't asked."""
    if endpoint.url("models") is None:
        return []
    body = get(endpoint.url("models"), PREFLIGHT_TIMEOUT)
    return [] if model in body else [f"the endpoint doesn't list {model}"]


def headers() -> dict[str, str]:
    key = os.environ.get("LMSTUDIO_API_KEY", "")
    return {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})


def results_schema(count: int) -> dict:
    """The shape of an answer with a result for each of so many words."""
    item = {
        "type": "object",
        "properties": {
            "word_id": {"type": "integer"}, "word": {"type": "string"}, "type": {"type": "string"},
            "rarity_level": {"type": "integer", "minimum": 1, "maximum": 5}, "tag": {"type": "string"}, "confidence": {"type": "number", "minimum": 0, "maximum": 1},
        },
    }
    item |= {"required": list(item["properties"]), "additionalProperties": False}
    results = {"type": "array", "items": item, "minItems": count, "maxItems": count}
    return {"type": "object", "properties": {"results": results}, "required": ["results"], "additionalProperties": False}


def selection_schema(size: int, expected: int) -> dict:
    """The shape of a selection: so many distinct local ids."""
    return {"type": "array", "items": {"type": "integer", "minimum": 1, "maximum": size}, "minItems": expected, "maxItems": expected, "uniqueItems": True}


@dataclass
class Abilities:
    """What an endpoint has not refused so far, in one worker: the answer's format, and reasoning controls."""

    format: str = FORMATS[0]
    reasoning: bool = True

    @classmethod
    def of(cls, endpoint: Endpoint) -> Abilities:
        return cls("none", False) if endpoint.flavour == "native" else cls()

    def refused(self, message: str) -> bool:
        """Give up what the message says is refused, or gave nothing; whether that changes anything."""
        before = (self.format, self.reasoning)
        if self.format == "json_object" and said(message, "schema wanted"):
            self.format = "json_schema"
        elif said(message, "format refused") or self.format == "json_schema" and said(message, "nothing parsed"):
            self.format = "none"
        if said(message, "reasoning refused"):
            self.reasoning = False
        return before != (self.format, self.reasoning)

    def answered(self, size: int, unresolved: int) -> None:
        """A schema under which a fifth of a batch or more stays unresolved does harm."""
        if self.format == "json_schema" and unresolved and unresolved >= max(1, -(-size // 5)):
            self.format = "none"


def payload(model: str, system: str, user: str, *, tokens: int, abilities: Abilities, schema: dict, profile: Profile | None = None) -> dict:
    p = profile or profile_of(model)
    body = {"model": model, "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}], "max_tokens": min(tokens, p.max_tokens or tokens), "stream": False}
    body |= {k: v for k, v in (("temperature", p.temperature), ("top_k", p.top_k), ("top_p", p.top_p)) if v is not None} | p.extra
    if abilities.reasoning:
        controls = {"reasoning_effort": p.reasoning_effort, "thinking": p.thinking and {"type": p.thinking}}
        controls["chat_template_kwargs"] = None if p.enable_thinking is None else {"enable_thinking": p.enable_thinking}
        body |= {k: v for k, v in controls.items() if v is not None}
    if abilities.format == "json_object":
        body["response_format"] = {"type": "json_object"}
    elif abilities.format == "json_schema":
        body["response_format"] = {"type": "json_schema", "json_schema": {"name": "answer", "strict": True, "schema": schema}}
    return body


#: Where a prompt's template has the entries; templates without any of them are followed by the entries.
INPUTS = ("{words}", "{{INPUT_JSON}}")


def prompt(template: str, entries: list[dict], **values: int) -> str:
    """A template with its numbers and entries; no template sends a prompt without the entries."""
    for name, value in values.items():
        template = template.replace(f"{{{name}}}", str(value))
    listed = json.dumps(entries, ensure_ascii=False)
    if not any(x in template for x in INPUTS):
        return f"{template}\n\n{listed}"
    for x in INPUTS:
        template = template.replace(x, listed)
    return template


#: The fence at the start or the end of a part of an answer.
_FENCE = re.compile(r"\A\s*```\w*\s*|\s*```\s*\Z")


def json_or_text(value: str):
    """What a text is as JSON, or the text itself: for logs of requests and answers."""
    try:
        return json.loads(value)
    except ValueError:
        return value


def content_text(body: dict) -> str:
    """The text of an answer: a string, parts of one, or an object as JSON."""
    choices = body.get("choices") or [{}]
    found = (choices[0].get("message") or {}).get("content") or (body.get("message") or {}).get("content") or body.get("output_text")
    if found is None:
        raise ValueError("Missing content")
    if isinstance(found, list):
        return "".join(_FENCE.sub("", x if isinstance(x, str) else str(x.get("text", ""))) for x in found)
    return found if isinstance(found, str) else json.dumps(found, ensure_ascii=False)


@dataclass
class Chat:
    """An endpoint as a task uses it, made anew in each worker: it learns what the endpoint refuses."""

    endpoint: Endpoint
    model: str
    system: str
    template: str
    tokens: int = TOKENS
    timeout: float = TIMEOUT
    post: Callable[[str, dict, float], dict] | None = None
    #: Where requests and answers are kept.
    log: Journal | None = None

    def _post(self, url: str, body: dict, timeout: float) -> dict:
        request = urllib.request.Request(url, json.dumps(body).encode(), headers())  # noqa: S310
        try:
            with urllib.request.urlopen(request, timeout=timeout) as r:  # noqa: S310
                return json.load(r)
        except urllib.error.HTTPError as x:
            raise ValueError(x.read().decode(errors="replace")) from x
        except (urllib.error.URLError, http.client.HTTPException) as x:
            raise ConnectionError(str(x)) from x

    def ask(self, system: str, user: str, tokens: int, schema: dict) -> str:
        """The text of the answer; asked again without what the endpoint says it refuses."""
        if not hasattr(self, "abilities"):
            self.abilities = Abilities.of(self.endpoint)
        while True:
            body = payload(self.model, system, user, tokens=tokens, abilities=self.abilities, schema=schema)
            answer: dict | str = ""
            try:
                answer = (self.post or self._post)(self.endpoint.url("chat"), body, self.timeout)
                return content_text(answer)
            except Exception as x:
                answer = answer or json_or_text(str(x))
                if not isinstance(x, ValueError) or not self.abilities.refused(str(x)):
                    raise
            finally:
                self.note(body, answer)

    def note(self, request: dict, response: dict | str) -> None:
        """Keep a request and what came of it; entries go out by the hundred, and at the end of a task by flush()."""
        if self.log is not None:
            self.entries = [*getattr(self, "entries", []), {"ts": datetime.now(UTC).isoformat(), "model": self.model, "request": request, "response": response}]
            if len(self.entries) >= ENTRIES:
                self.flush()

    def flush(self) -> None:
        if getattr(self, "entries", None):
            self.log.put(uuid.uuid4().hex, self.entries)
            self.entries = []


@dataclass
class ChatScorer(Chat):
    """A Scorer over an endpoint: batch in, results out."""

    def __call__(self, batch: pd.DataFrame) -> pd.DataFrame:
        from ..functions.responses import _nodes, _waterfall

        words = list(batch[["word_id", "word", "type"]].itertuples(index=False, name=None))
        user = prompt(self.template, [{"word_id": int(i), "word": w, "type": t} for i, w, t in words], count=len(words))
        tokens = max(256, min(40 * len(words) + 200, self.tokens))
        content = self.ask(self.system, user, tokens, results_schema(len(words)))
        try:
            rows = _waterfall(words, _nodes(parse_content(content)[0]), True)
        except ValueError as x:
            self.abilities.refused(str(x))
            raise
        found = [(r[0], *r[3:7]) for r in rows if r[3] is not None]
        self.abilities.answered(len(words), len(words) - len(found))
        return pd.DataFrame(found, columns=["word_id", "rarity_level", "tag", "confidence", "matched"])


#: What is asked when a selection had the wrong number of picks.
REPAIR_SYSTEM = "Answer with one JSON array of whole numbers and nothing else. Every number is a local_id of the list, none stands twice."
REPAIR_USER = "Choose exactly {count} of these {size} words: the most common ones. The array must have exactly {count} numbers.\n{words}"


def picked_ids(node, words: list[str], expected: int) -> list[int]:
    """The local ids, from 1, that a parsed answer picks: by number, or by spelling where it gives words. The first `expected` distinct ones."""
    edges = " \t\n.,;:!?\"'()[]{}«»„”“-"
    plain = lambda w: str(w).strip(edges).lower()
    by_word: dict[str, list[int]] = {}
    for i, w in enumerate(words, 1):
        by_word.setdefault(plain(w), []).append(i)
    items = node if isinstance(node, list) else next((x for x in node.values() if isinstance(x, list)), []) if isinstance(node, dict) else []
    out: dict[int, None] = {}
    for x in items:
        x = x.get("local_id", x.get("id", x.get("word"))) if isinstance(x, dict) else x
        number = int(x) if isinstance(x, (int, float)) and not isinstance(x, bool) or isinstance(x, str) and x.strip().isdigit() else None
        if number is None:
            number = next((i for i in by_word.get(plain(x), ()) if i not in out), None)
        if number is not None and 1 <= number <= len(words):
            out[number] = None
    if len(out) < expected:
        raise ValueError(f"expected exactly {expected} selected, got {len(out)}")
    return list(out)[:expected]


@dataclass
class ChatSelector(Chat):
    """A selector over an endpoint: words and how many to pick in, local ids of the commonest out."""

    def __call__(self, words: list[str], expected: int, repair: bool = False) -> list[int]:
        entries = [{"local_id": i, "word": w} for i, w in enumerate(words, 1)]
        system, user = (REPAIR_SYSTEM, REPAIR_USER) if repair else (self.system, self.template)
        system = system.replace("{count}", str(expected)).replace("{size}", str(len(words)))
        user = prompt(user, entries, count=expected, size=len(words))
        tokens = min(max(128, min(24 * expected + 128, self.tokens)), 1024)
        content = self.ask(system, user, tokens, selection_schema(len(words), expected))
        node = parse_content(content)[0]
        return picked_ids(json_or_text(node) if isinstance(node, str) else node, words, expected)
