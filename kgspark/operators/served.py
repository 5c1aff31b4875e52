"""Extractors that ask a served model through the chat-completion protocol."""

from __future__ import annotations

import json
import os
import urllib.error
import urllib.request
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from ..config import Settings
from .extract import DictionaryExtractor, Extractor

SYSTEM = "You are a helpful assistant that responds in JSON format."
#: Answers of a service that may be different later.
PASSING = (408, 429, 500, 502, 503, 504)


@dataclass(frozen=True)
class Capabilities:
    """What a model can be asked for: an answer by schema (``strict``: enforced), any JSON object, or fenced text only."""

    by_schema: bool = False
    strict: bool = False
    json_object: bool = True
    fenced: bool = False


# Parts of models' names, tried in this order, and what such models can do.
FAMILIES: tuple[tuple[tuple[str, ...], Capabilities], ...] = (
    (("gpt-4", "gpt-3.5", "o1", "o3"), Capabilities(by_schema=True, strict=True)),
    (("deepseek",), Capabilities(by_schema=True)),
    (("qwen-max", "qwen-plus", "qwen-turbo"), Capabilities()),
    (("qwen",), Capabilities(json_object=False, fenced=True)),
)


def capabilities(model: str, families: Sequence[tuple[Sequence[str], Capabilities]] = FAMILIES) -> Capabilities:
    """Those of the first family with a part of the model's name; a JSON object if there is none."""
    return next((c for parts, c in families if any(p in model.lower() for p in parts)), Capabilities())


@dataclass(frozen=True)
class ServedModel:
    """An extractor: prompts to answers, None for each that failed and may be asked again.

    The key is read from the environment of the worker that asks, so that it is never part of a plan. ``schema`` is a JSON
    schema of the answer, used as far as the model can. Prompts of a batch are asked ``parallel`` at a time. A refusal
    that asking again can't mend (a wrong key or address, a bad request) is an error.
    """

    url: str
    model: str
    key_env: str = "KGSPARK_API_KEY"
    temperature: float | None = 0.1
    max_tokens: int | None = 16384
    timeout: float = 120.0
    thinking: bool = False
    schema: Mapping | None = None
    parallel: int = 8

    def body(self, prompt: str) -> dict:
        can = capabilities(self.model)
        out: dict = {"model": self.model, "messages": [{"role": "system", "content": SYSTEM}, {"role": "user", "content": prompt}]}
        if self.temperature is not None:
            out["temperature"] = self.temperature
        if self.max_tokens is not None:
            out["max_tokens"] = self.max_tokens
        if self.schema and can.by_schema:
            out["response_format"] = {"type": "json_schema", "json_schema": {"name": "extractions", "schema": self.schema, "strict": can.strict}}
        elif can.json_object:
            out["response_format"] = {"type": "json_object"}
        if not self.thinking:
            out["thinking"] = {"type": "disabled"}
        return out

    def ask(self, prompt: str) -> str | None:
        head = {"Content-Type": "application/json", "Authorization": f"Bearer {os.environ.get(self.key_env, '')}"}
        request = urllib.request.Request(f"{self.url.rstrip('/')}/chat/completions", json.dumps(self.body(prompt)).encode(), head)
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                return json.load(answer)["choices"][0]["message"]["content"]
        except urllib.error.HTTPError as e:
            if e.code in PASSING:
                return None
            raise ValueError(f"the service refuses the request: {e.code} {e.reason}") from e
        except (OSError, ValueError, LookupError, TypeError):  # no connection, no time, or no answer that can be read
            return None

    def __call__(self, prompts: Sequence[str]) -> list[str | None]:
        if len(prompts) == 1:
            return [self.ask(prompts[0])]
        with ThreadPoolExecutor(max(1, min(self.parallel, len(prompts)))) as pool:
            return list(pool.map(self.ask, prompts))


def extractor_factory(settings: Settings, names: Mapping[str, Sequence[str]] | None = None, schema: Mapping | None = None) -> Callable[[], Extractor]:
    """What makes the extractor of a run: the served model if the settings give its address, else the offline one."""
    if settings.model_url:
        model = ServedModel(settings.model_url, settings.model, temperature=settings.temperature, thinking=settings.thinking, schema=schema)
        return lambda: model
    if names is None:
        raise ValueError("set model_url, or give names for the offline extractor")
    return lambda: DictionaryExtractor(dict(names))
