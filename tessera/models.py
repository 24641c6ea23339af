"""The model boundary: clients run inside partitions, with a deterministic default."""

from __future__ import annotations

import contextlib
import ctypes
import json
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Pauses between attempts of a call; rows that a Python worker holds at once.
BACKOFF, RATE_LIMIT_WAIT = 1.5, 12.0
ROWS_AT_ONCE = 256
ANSWER = "raw_response string, error string"


class ChatClient(Protocol):
    def complete(self, model: str, system: str, user: str, temperature: float, max_tokens: int) -> str: ...


class MockClient:
    def complete(self, model: str, system: str, user: str, temperature: float, max_tokens: int) -> str:
        return '{"prompt": "[mock] prompt", "expected": "[mock] answer"}'


class HttpClient:
    """Client of any server with the common chat completions interface. One request per
    call, with a timeout; retries are the caller's."""

    def __init__(self, base_url: str, api_key: str, timeout: float = 90.0, post=None):
        if not api_key:
            raise ValueError("an api key is needed")
        self.url, self.key, self.timeout, self.post = base_url.rstrip("/") + "/chat/completions", api_key, timeout, post or self._post

    def _post(self, url: str, headers: dict, body: bytes, timeout: float) -> dict:
        from urllib.error import HTTPError
        from urllib.request import Request, urlopen

        try:
            with urlopen(Request(url, body, headers), timeout=timeout) as r:
                return json.load(r)
        except HTTPError as e:
            raise (RateLimited if e.code == 429 else RuntimeError)(f"status {e.code}") from e

    def complete(self, model: str, system: str, user: str, temperature: float, max_tokens: int) -> str:
        messages = [{"role": "system", "content": system}, {"role": "user", "content": user}]
        body = json.dumps({"model": model, "messages": messages, "temperature": temperature, "max_tokens": max_tokens}).encode()
        got = self.post(self.url, {"Authorization": f"Bearer {self.key}", "Content-Type": "application/json"}, body, self.timeout)
        return got["choices"][0]["message"]["content"] or ""


class CommandClient:
    """Client that runs a command, gives it the prompts on standard input and takes its
    output; for a driver, not for executors."""

    def __init__(self, command: list[str], timeout: float = 300.0):
        self.command, self.timeout = command, timeout

    def complete(self, model: str, system: str, user: str, temperature: float, max_tokens: int) -> str:
        import subprocess

        words = [w.replace("{model}", model) for w in self.command]
        done = subprocess.run(words, input=f"{system}\n\n{user}", capture_output=True, text=True, timeout=self.timeout)
        if done.returncode:
            raise RuntimeError(f"{words[0]} ended with {done.returncode}: {done.stderr.strip()[:200]}")
        return done.stdout.strip()


class RateLimited(RuntimeError):
    """The server asks for fewer calls."""


CLIENTS: dict[str, Callable[[], ChatClient]] = {"mock": MockClient}


def register_client(name: str, factory: Callable[[], ChatClient]) -> None:
    CLIENTS[name] = factory


def build_client(name: str) -> ChatClient:
    if name not in CLIENTS:
        raise ValueError(f"unknown client {name!r}")
    return CLIENTS[name]()


class RateLimiter:
    """At least ``60 / per_minute`` seconds between calls of one process; a cluster's cap
    must be divided by its partitions."""

    def __init__(self, per_minute: float, clock=time.monotonic, sleep=time.sleep):
        self.gap, self.clock, self.sleep, self.last = 60.0 / per_minute, clock, sleep, None

    def wait(self) -> None:
        now = self.clock()
        if self.last is not None and now - self.last < self.gap:
            self.sleep(self.gap - (now - self.last))
        self.last = self.clock()


def pause(error: Exception, attempt: int, backoff: tuple[float, ...] | None = None) -> float:
    """Seconds before the next attempt (from 0): a fixed cool-off for rate limits, else a
    growing pause, or the given ones, of which the last repeats."""
    if backoff:
        return backoff[min(attempt, len(backoff) - 1)]
    limited = isinstance(error, RateLimited) or "429" in str(error)
    return RATE_LIMIT_WAIT if limited else BACKOFF**attempt


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows, as prompts may be long; a smaller setting is kept."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if not 0 < now <= ROWS_AT_ONCE:
        spark.conf.set(key, str(ROWS_AT_ONCE))


def give_back() -> None:
    """Return what this worker has freed to the system, as Spark keeps workers after a task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def complete(
    prompts: DataFrame, factory: Callable[[], ChatClient], per_minute: float | None = None, attempts: int = 4, temperature: float = 0.7, max_tokens: int = 1024,
    backoff: tuple[float, ...] | None = None, sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """``prompts`` with system, user, model: adds raw_response or error. Retries happen
    here, so that a failing call never fails a task. A client is built once per task; a
    cap on the calls a minute must be divided by the number of tasks. Workers see only the
    three columns of a call, a few rows at a time; the others stay in the JVM."""

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        client, limit = factory(), RateLimiter(per_minute) if per_minute else None
        try:
            for model, system, user in batches:
                got, bad = [], []
                for m, s, u in zip(model, system, user, strict=True):
                    text = error = None
                    for k in range(attempts):
                        try:
                            if limit:
                                limit.wait()
                            text, error = client.complete(m.as_py(), s.as_py(), u.as_py(), temperature, max_tokens), None
                            break
                        except Exception as e:  # noqa: BLE001
                            error = str(e)
                            if k + 1 < attempts:
                                sleep(pause(e, k, backoff))
                    got.append(text)
                    bad.append(error)
                yield pa.StructArray.from_arrays([pa.array(got, pa.string()), pa.array(bad, pa.string())], ["raw_response", "error"])
        finally:
            give_back()

    small_batches(prompts.sparkSession)
    # a call is not repeated for each use of its answer, nor moved past a filter or join
    call = F.arrow_udf(run, ANSWER).asNondeterministic()
    return prompts.withColumn("_answer", call("model", "system", "user")).select(*prompts.columns, "_answer.raw_response", "_answer.error")


def letter_vector(text):
    """A 26-dim letter-frequency embedding, the deterministic stand-in for a model."""
    return F.transform(F.sequence(F.lit(97), F.lit(122)), lambda c: F.regexp_count(F.lower(text), F.char(c)).cast("double"))


class Embedder(Protocol):
    def encode(self, texts: list[str]) -> list[list[float]]: ...


class LetterEmbedder:
    """The letter-frequency vector as an ``Embedder``."""

    def encode(self, texts: list[str]) -> list[list[float]]:
        return [[float(t.lower().count(chr(c))) for c in range(97, 123)] for t in texts]


def embed(texts: DataFrame, factory: Callable[[], Embedder], batch: int = 64) -> DataFrame:
    """Embed the distinct texts once: (text) -> (text, vector). The model is built once
    per task and sees ``batch`` texts at a time, whose vectors leave before the next."""

    def run(frames):
        model = factory()
        try:
            for f in frames:
                for a in range(0, len(f), batch):
                    some = f["text"].iloc[a : a + batch].tolist()
                    yield pd.DataFrame({"text": some, "vector": [list(map(float, v)) for v in model.encode(some)]})
        finally:
            give_back()

    small_batches(texts.sparkSession)
    return texts.select("text").distinct().mapInPandas(run, "text string, vector array<double>")
