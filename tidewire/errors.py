"""Errors of the engine, and helpers that show them without stack traces."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


class EngineError(Exception):
    """Any failure that the engine itself reports."""


class ConfigError(EngineError):
    """A configuration that can't be used; the message has the key's dotted path."""


class SpecError(EngineError):
    """An API description that can't be read, or a table that it can't give a schema for."""


class NoSuchTable(EngineError):
    """A table that isn't there; the message lists those that are."""


class ApiError(EngineError):
    """An HTTP response that stands for a failure."""

    REQUEST_IDS = ("x-request-id", "x-correlation-id", "correlation-id", "x-amzn-requestid", "x-github-request-id", "x-trace-id", "request-id", "cf-ray")
    PREVIEW, BODY = 200, 4096

    def __init__(self, method: str, url: str, status: int, reason: str, headers: dict[str, str], body: bytes):
        self.status, self.headers = status, {k.lower(): v for k, v in headers.items()}
        self.body = redact(body[: self.BODY].decode("utf-8", "replace"))
        found = next((f"{k}: {self.headers[k]}" for k in self.REQUEST_IDS if self.headers.get(k)), "")
        preview = " ".join(self.body.split())[: self.PREVIEW]
        super().__init__(f"{method} {redact_url(url)} failed: {status} {reason}" + (f" ({found})" if found else "") + (f": {preview}" if preview else ""))

    def __reduce__(self):
        return (EngineError, (str(self),))


_SECRETS = [
    re.compile(r"(?i)\b(bearer|basic|token)\s+[a-z0-9._~+/=-]{8,}"),
    re.compile(r"\b(?:gh[pousr]_|github_pat_|xox[abpors]-|sk-|sk_live_|sk_test_|AKIA|AIza)[A-Za-z0-9_-]{8,}"),
    re.compile(r"\beyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*"),
    re.compile(r"""(?i)("?(?:(?:[\w-]*[_-])?(?:token|secret|key|pass(?:word|wd|phrase)?|pwd)|accesstoken|refreshtoken|apikey|clientsecret)"?\s*[:=]\s*)"?[^"&\s,}]+"?"""),
]
_SENSITIVE = re.compile(r"(?i)token|secret|pass|pwd|key|auth|signature|credential|session")


def redact(text: str) -> str:
    """The text with what looks like a credential replaced by [SCRUBBED]."""
    for i, pattern in enumerate(_SECRETS):
        text = pattern.sub(r"\1[SCRUBBED]" if i == 3 else "[SCRUBBED]", text)
    return text


def redact_url(url: str) -> str:
    """The URL with the values of sensitive parameters replaced by [REDACTED]."""
    head, mark, query = url.partition("?")
    if not mark:
        return redact(url)
    parts = [k + "=[REDACTED]" if _SENSITIVE.search(k) and eq else redact(k + eq + v) for k, eq, v in (p.partition("=") for p in query.split("&"))]
    return f"{redact(head)}?{'&'.join(parts)}"


def clean_message(error: BaseException) -> str:
    """The message of the innermost failure that the engine reported, or the first line of the error's own."""
    text = str(error)
    found = re.findall(r"(?:tidewire\.errors\.)(?:\w+): (.+)", text)
    if found:
        return found[-1].strip()
    lines = [x.strip() for x in text.splitlines() if x.strip() and not x.strip().startswith(("at ", "File ", "Traceback", "JVM stacktrace"))]
    return lines[0] if lines else type(error).__name__


@contextmanager
def clean_errors() -> Iterator[None]:
    """Turns any failure inside into an EngineError with one clean message."""
    try:
        yield
    except EngineError:
        raise
    except Exception as error:
        raise EngineError(clean_message(error)) from None


def sql_clean(spark: SparkSession, text: str) -> DataFrame:
    with clean_errors():
        return spark.sql(text)


def collect_clean(df: DataFrame) -> list:
    with clean_errors():
        return df.collect()


def count_clean(df: DataFrame) -> int:
    with clean_errors():
        return df.count()


def take_clean(df: DataFrame, n: int) -> list:
    with clean_errors():
        return df.take(n)


def show_clean(df: DataFrame, n: int = 20) -> None:
    with clean_errors():
        df.show(n)
