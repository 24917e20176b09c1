"""Answers of a language model, as a provider on the executors or replayed from a table.

``make()`` gives a provider, once a partition: ``answer(prompt, handle, body, schema) -> (json text, input, cached, output)``, and, if it can keep prompts,
``keep(prompt) -> handle``, which then stands for the prompt. Without a provider, answers are replayed. No key or prompt is logged.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from statuta.functions.budget import fit
from statuta.operators.answers import BUDGETS, SCHEMAS

SCHEMA = "doc string, question string, ok boolean, value string, error string, input long, cached long, output long, ms long"
ATTEMPTS, TIMEOUT_WORDS = 3, ("timeout", "timedout", "deadline")
PRUNED = ("additionalProperties", "$schema", "definitions", "$defs", "title")
Call = Callable[[str, str, dict], tuple[str, int, int, int]]


def find_key(names: list[str], env_file: str | None = None) -> str | None:
    """The first of the names that the environment, or else a file of NAME=value lines, sets. Read on the driver only."""
    import os

    found = {}
    if env_file and os.path.exists(env_file):
        with open(env_file, encoding="utf-8") as f:
            pairs = (line.strip().removeprefix("export ").split("=", 1) for line in f if "=" in line and not line.lstrip().startswith("#"))
            found = {k.strip(): v.strip().strip("'\"") for k, v in pairs}
    return next((v for source in (os.environ, found) for n in names if (v := source.get(n))), None)


class PromptCache:
    """Handles of prompts that a provider keeps, by digest: made once, made anew before they expire, and not asked for again once refused."""

    def __init__(self, make: Callable[[str], str | None], lifetime: float = 3600, margin: float = 300, least_chars: int = 2400, clock: Callable[[], float] = time.monotonic):
        self.make, self.lifetime, self.margin, self.least_chars, self.clock = make, lifetime, margin, least_chars, clock
        self.known: dict[str, tuple[str | None, float]] = {}

    def get(self, prompt_: str) -> str | None:
        if len(prompt_) < self.least_chars:
            return None
        key = hashlib.sha256(prompt_.encode()).hexdigest()
        handle, until = self.known.get(key, ("", 0.0))
        if handle is None or self.clock() < until - self.margin:
            return handle
        try:
            handle = self.make(prompt_)
        except Exception:  # a provider that keeps no prompts still answers
            handle = None
        self.known[key] = (handle, self.clock() + self.lifetime)
        return handle

    def lost(self, prompt_: str) -> None:
        """The provider no longer has it."""
        self.known.pop(hashlib.sha256(prompt_.encode()).hexdigest(), None)


def timed_out(error: BaseException) -> bool:
    name = type(error).__name__.lower()
    return any(w in name for w in TIMEOUT_WORDS)


def pruned(schema):
    """A JSON schema without keys that a provider may refuse. Names of properties are no such keys."""
    if isinstance(schema, list):
        return [pruned(v) for v in schema]
    if not isinstance(schema, dict):
        return schema
    return {k: {n: pruned(x) for n, x in v.items()} if k == "properties" else pruned(v) for k, v in schema.items() if k not in PRUNED}


def json_schema(question: str) -> dict:
    """The shape of a question's answer as a JSON schema."""

    def of(t) -> dict:
        if isinstance(t, StructType):
            return {"type": "object", "properties": {f.name: of(f.dataType) for f in t.fields}, "additionalProperties": False}
        if isinstance(t, ArrayType):
            return {"type": "array", "items": of(t.elementType)}
        return {"type": "number" if t.typeName() == "double" else "string"}

    return {"title": question, **of(StructType.fromDDL(SCHEMAS[question]))}


class Session:
    """A provider with its kept prompts: a handle goes instead of the prompt, and one that the provider has lost is forgotten and the prompt sent."""

    def __init__(self, provider):
        self.provider = provider
        self.cache = PromptCache(provider.keep) if hasattr(provider, "keep") else None

    def __call__(self, prompt_: str, body: str, schema: dict) -> tuple[str, int, int, int]:
        handle = self.cache.get(prompt_) if self.cache else None
        if handle is not None:
            try:
                return self.provider.answer(None, handle, body, schema)
            except Exception as e:
                if "cache" not in f"{type(e).__name__}{e}".lower():
                    raise
                self.cache.lost(prompt_)
        return self.provider.answer(prompt_, None, body, schema)


def prompt(template: str, taxonomy: str = "") -> str:
    return template.replace("{{taxonomy}}", taxonomy)


def ask_one(call: Call, prompt_: str, body: str, schema: dict) -> tuple:
    """(ok, value, error, input, cached, output, ms): time-outs and answers that are no JSON are tried again."""
    began, error = time.monotonic(), ""
    for _ in range(ATTEMPTS):
        try:
            value, *tokens = call(prompt_, body, schema)
            json.loads(value)
            return (True, value, None, *tokens, int(1000 * (time.monotonic() - began)))
        except ValueError as e:
            error = f"no JSON: {e}"[:300]
        except Exception as e:
            error = f"{type(e).__name__}: {e}"[:300]
            if not timed_out(e):
                break
    return (False, None, error, 0, 0, 0, int(1000 * (time.monotonic() - began)))


def ask(documents: DataFrame, questions: list[str], prompts: dict[str, str], make: Callable[[], object]) -> DataFrame:
    """Answers to each question about each (doc, text), each text within the question's budget."""
    bodies = F.array(*[F.struct(F.lit(q).alias("question"), fit(F.col("text"), *BUDGETS[q]).alias("body")) for q in questions])
    asked = documents.select("doc", F.explode(bodies).alias("a")).select("doc", "a.question", "a.body")

    shapes = {q: pruned(json_schema(q)) for q in questions}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = Session(make())
        for frame in frames:
            rows = [(d, q, *ask_one(call, prompts[q], b, shapes[q])) for d, q, b in frame.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return asked.mapInPandas(run, SCHEMA)
