"""Services outside Spark, as functions that a table of their recorded answers can stand in for."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from collections import deque
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import boundaries


@dataclass(frozen=True)
class Limits:
    """Texts and estimated tokens of a request; tokens a minute; attempts, and seconds before each further one; tokens of
    one text, and those that are left of a longer one."""

    texts: int = 2048
    tokens: int = 100_000
    per_minute: int = 350_000
    attempts: int = 4
    waits: tuple[int, ...] = (30, 60, 90)
    text_tokens: int = 8192
    text_kept: int = 8000


def batches(texts: list[str], limits: Limits, count: Callable[[str], int] = lambda t: max(1, len(t) // 4)) -> Iterator[list[int]]:
    """Places of texts by request: in order, each as full as the limits allow."""
    now: list[int] = []
    used = 0
    for i, t in enumerate(texts):
        n = count(t)
        if now and (len(now) == limits.texts or used + n > limits.tokens):
            yield now
            now, used = [], 0
        now.append(i)
        used += n
    if now:
        yield now


def with_retries(call: Callable[[], object], limits: Limits, sleep: Callable[[float], None] = time.sleep) -> object:
    for k in range(limits.attempts):
        try:
            return call()
        except Exception:
            if k + 1 == limits.attempts:
                raise
            sleep(limits.waits[min(k, len(limits.waits) - 1)])
    return None


class TokenBucket:
    """Waits until so many tokens may be sent, at a rate a minute."""

    def __init__(self, per_minute: int, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.rate, self.clock, self.sleep = per_minute / 60, clock, sleep
        self.left, self.at = float(per_minute), clock()
        self.most = float(per_minute)

    def take(self, n: int) -> None:
        now = self.clock()
        self.left = min(self.most, self.left + (now - self.at) * self.rate)
        self.at = now
        if n > self.left:
            wait = (min(n, self.most) - self.left) / self.rate
            self.sleep(wait)
            self.left = min(self.most, self.left + wait * self.rate)
            self.at = self.clock()
        self.left -= n


class Chain:
    """A conversation with a service that keeps its answers: each request builds on the last answer that was confirmed.

    An answer is only proposed until confirm() takes it, so a repair builds on what was right before. Of the confirmed
    ones the newest `depth` are kept and older ones handed to `delete`, whose failures are passed over; depth None keeps
    all, 0 makes every request independent.
    """

    def __init__(self, depth: int | None = None, delete: Callable[[str], object] = lambda _: None) -> None:
        self.depth, self.delete = depth, delete
        self.kept: deque[str] = deque()
        self.previous: str | None = None
        self.proposed: str | None = None

    def ask(self, call: Callable[[str | None], tuple[str, str]]) -> str:
        """The text of call(previous id) -> (text, id)."""
        text, self.proposed = call(None if self.depth == 0 else self.previous)
        return text

    def confirm(self) -> None:
        if self.proposed is None:
            return
        self.previous, self.proposed = self.proposed, None
        if self.depth:
            self.kept.append(self.previous)
            while len(self.kept) > self.depth:
                try:
                    self.delete(self.kept.popleft())
                except Exception:  # an answer that stays behind does no harm
                    continue

    def ask_valid(self, call: Callable[[str | None, str], tuple[str, str]], valid: Callable[[str], bool], hint: str, repairs: int = 1) -> str | None:
        """The first answer that is valid, confirmed; call gets "" and then, for repairs, the hint. None if none is."""
        for k in range(repairs + 1):
            text = self.ask(lambda previous, k=k: call(previous, hint if k else ""))
            if valid(text):
                self.confirm()
                return text
        self.proposed = None
        return None


def embeddings(nodes: DataFrame, embed: Callable[[list[str]], list[list[float]]], dim: int, limits: Limits | None = None) -> DataFrame:
    """nodes with vec: unit vectors of their texts in the service's requests; zero vectors for blank texts.
    Texts over the limits' tokens are cut first."""
    limits = limits or Limits()

    @F.pandas_udf("array<float>")
    def vectors(s: pd.Series) -> pd.Series:
        texts = [boundaries.truncated(t or "", limits.text_tokens, limits.text_kept) for t in s]
        out = [np.zeros(dim, np.float32)] * len(texts)
        full = [i for i, t in enumerate(texts) if t.strip()]
        for own in batches([texts[i] for i in full], limits):
            for i, v in zip(own, with_retries(lambda own=own: embed([texts[full[i]] for i in own]), limits), strict=True):
                v = np.asarray(v, float)
                out[full[i]] = (v / (np.sqrt(v @ v) or 1.0)).astype(np.float32)
        return pd.Series([v.tolist() for v in out])

    return nodes.withColumn("vec", vectors("text"))


def prompt(template: str, values: dict[str, str]) -> str:
    """A template with {{name}} replaced; a name without a value is an error."""
    missing = {n for n in re.findall(r"\{\{(\w+)\}\}", template) if n not in values}
    if missing:
        raise KeyError(f"no value for {sorted(missing)}")
    return re.sub(r"\{\{(\w+)\}\}", lambda m: values[m[1]], template)
