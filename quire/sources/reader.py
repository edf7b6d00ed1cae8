"""The page reader: an image-to-markdown model behind an HTTP chat interface.

A ``Reader`` is what one Python worker holds; ``read_pages`` maps a relation of
page images to markdown with one reader per worker, a few requests in flight,
and a row of its own for each failure, so one page doesn't fail the job.
"""

from __future__ import annotations

import base64
import json
import os
import queue
import random
import time
import urllib.error
import urllib.request
import warnings
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass, field, replace
from email.message import Message
from http.client import HTTPConnection, HTTPException, HTTPSConnection
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..errors import ConversionError, ReaderResponse, ReaderUnavailable
from ..functions.pixels import png

#: Defaults and limits of the wire contract.
BASE_URL, MODEL, NEW_TOKENS, CONTEXT, MARGIN, IN_FLIGHT = "http://127.0.0.1:8000/v1", "page-reader", 2048, 8192, 64, 4
REQUEST_S, HEALTH_S, RETRIES, BACKOFF_S, RETRY_AFTER_S = 600.0, 10.0, 2, 0.5, 30.0
RETRYABLE = (429, 502, 503, 504)
PREFIX = "QUIRE_READER_"


class HttpFailure(Exception):
    """A reply with an error status, or none at all (status 0)."""

    def __init__(self, status: int, headers: Message | dict | None = None):
        super().__init__(f"HTTP status {status}" if status else "no reply")
        self.status, self.headers = status, headers or {}


#: (url, body or null for GET, timeout) -> reply as text; raises HttpFailure.
Transport = Callable[[str, bytes | None, float], str]


def http(url: str, body: bytes | None, timeout: float) -> str:
    try:
        request = urllib.request.Request(url, body, {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=timeout) as reply:
            return reply.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        raise HttpFailure(e.code, e.headers) from e
    except (OSError, ValueError) as e:
        raise HttpFailure(0) from e


class Pool:
    """A transport that keeps connections open between requests, ``size`` at
    most; a kept one that the other side has closed is replaced. Urls that a
    proxy is set for go by ``http``."""

    def __init__(self, size: int):
        self.size, self.idle = size, queue.LifoQueue(size)

    def __call__(self, url: str, body: bytes | None, timeout: float) -> str:
        try:
            parts = urlsplit(url)
            at = parts.scheme, parts.hostname, parts.port
        except ValueError as e:
            raise HttpFailure(0) from e
        if at[0] not in ("http", "https") or not at[1] or (at[0] in urllib.request.getproxies() and not urllib.request.proxy_bypass(at[1])):
            return http(url, body, timeout)
        target = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
        while True:
            link = self.kept(at)
            fresh = link is None
            try:
                link = link or (HTTPSConnection if at[0] == "https" else HTTPConnection)(*at[1:])
                link.timeout = timeout
                if link.sock is not None:
                    link.sock.settimeout(timeout)
                link.request("GET" if body is None else "POST", target, body, {"Content-Type": "application/json"})
                reply = link.getresponse()
                text = reply.read().decode("utf-8", "replace")
            except (OSError, ValueError, HTTPException) as e:
                if link is not None:
                    link.close()
                if fresh or isinstance(e, TimeoutError):
                    raise HttpFailure(0) from e
                continue
            self.keep(at, link)
            if not 200 <= reply.status < 300:
                raise HttpFailure(reply.status, reply.headers)
            return text

    def kept(self, at: tuple) -> HTTPConnection | None:
        while True:
            try:
                place, link = self.idle.get_nowait()
            except queue.Empty:
                return None
            if place == at:
                return link
            link.close()

    def keep(self, at: tuple, link: HTTPConnection) -> None:
        try:
            if link.sock is not None:  # else the reply ended it
                self.idle.put_nowait((at, link))
        except queue.Full:
            link.close()

    def close(self) -> None:
        while not self.idle.empty():
            self.idle.get_nowait()[1].close()


def setting(name: str, default, kind=float):
    """A positive number from the environment; a bad one is reported and ignored.
    Whole numbers are raised to 1."""
    raw = os.environ.get(PREFIX + name)
    if raw is None:
        return default
    try:
        value = kind(raw)
    except ValueError:
        value = None
    if kind is int and value is not None:
        return max(1, value)
    if value is None or value <= 0:
        warnings.warn(f"{PREFIX}{name}={raw!r} is not a positive number; {default} is used", stacklevel=2)
        return default
    return value


def base_url(given: str | None = None) -> str:
    return (given or os.environ.get(PREFIX + "URL", BASE_URL)).rstrip("/")


def context_of(payload) -> int | None:
    """The context length that a model list reports first, if it is one."""
    try:
        value = payload["data"][0]["max_model_len"]
    except (KeyError, IndexError, TypeError):
        return None
    return value if isinstance(value, int) and not isinstance(value, bool) and value > 0 else None


@dataclass
class Reader:
    """A connection: where, which model, its limits."""

    url: str = BASE_URL
    model: str = MODEL
    context: int = CONTEXT
    in_flight: int = IN_FLIGHT
    timeout: float = REQUEST_S
    transport: Transport = field(default=http, repr=False)
    sleep: Callable[[float], None] = field(default=time.sleep, repr=False)

    @classmethod
    def connect(cls, url: str | None = None, model: str | None = None, timeout: float | None = None, transport: Transport | None = None) -> Reader:
        """Probe the service and take over its context length: a setting in the
        environment wins, then what it reports, then the default. Without a
        ``transport``, as many connections stay open as requests are in flight."""
        at, in_flight = base_url(url), setting("IN_FLIGHT", IN_FLIGHT, int)
        transport = transport or Pool(in_flight)
        try:
            reply = transport(f"{at}/models", None, setting("HEALTH_TIMEOUT", HEALTH_S))
        except HttpFailure as e:
            raise ReaderUnavailable(f"the page reader at {at} is unreachable or unhealthy") from e
        try:
            reported = context_of(json.loads(reply))
        except ValueError:
            reported = None
        return cls(
            at,
            model or os.environ.get(PREFIX + "MODEL", MODEL),
            setting("CONTEXT", reported or CONTEXT, int),
            in_flight,
            timeout if timeout is not None else setting("TIMEOUT", REQUEST_S),
            transport,
        )

    def reconnect(self) -> Reader:
        """Probe anew; this reader changes only if that works."""
        fresh = self.connect(self.url, self.model, self.timeout, self.transport)
        self.context, self.in_flight = fresh.context, fresh.in_flight
        return self

    def __enter__(self) -> Reader:
        return self

    def __exit__(self, *exc) -> None:
        """Closes the connections that were kept; the reader can go on."""
        if isinstance(self.transport, Pool):
            self.transport.close()

    def delay(self, failure: HttpFailure, attempt: int) -> float:
        """Seconds to the next attempt: what the service asks for, within a
        limit, or a doubling wait with jitter."""
        try:
            return min(max(0.0, float(failure.headers.get("Retry-After"))), RETRY_AFTER_S)
        except (TypeError, ValueError):
            return BACKOFF_S * 2.0**attempt + random.uniform(0, BACKOFF_S)

    def post(self, encoded: str, tokens: int) -> tuple[str, str | None, int | None]:
        """Content, why it ended, and the prompt's tokens."""
        part = {"type": "image_url", "image_url": {"url": f"data:image/png;base64,{encoded}"}}
        body = {"model": self.model, "temperature": 0.0, "max_tokens": tokens, "messages": [{"role": "user", "content": [part]}]}
        for attempt in range(RETRIES + 1):
            try:
                reply = self.transport(f"{self.url}/chat/completions", json.dumps(body).encode(), self.timeout)
                break
            except HttpFailure as e:
                if attempt == RETRIES or (e.status and e.status not in RETRYABLE):
                    raise ReaderUnavailable(f"reading at {self.url} failed") from e
                self.sleep(self.delay(e, attempt))
        try:
            payload = json.loads(reply)
            choice = payload["choices"][0]
            content = choice["message"]["content"]
        except (ValueError, KeyError, IndexError, TypeError) as e:
            raise ReaderResponse("the reply has no content") from e
        if content is not None and not isinstance(content, str):
            raise ReaderResponse("the reply's content is no text")
        usage = payload.get("usage")
        return content or "", choice.get("finish_reason"), usage.get("prompt_tokens") if isinstance(usage, dict) else None

    def read(self, image: np.ndarray, tokens: int = NEW_TOKENS) -> str:
        """A page's markdown. A reply that hit the limit is asked for once more
        with all that the context has left; the longer one counts."""
        encoded = base64.b64encode(png(image)).decode()
        content, ended, prompt = self.post(encoded, tokens)
        left = self.context - prompt - MARGIN if ended == "length" and prompt is not None else 0
        if left <= tokens:
            return content
        again = self.post(encoded, left)[0]
        return again if len(again) >= len(content) else content

    def read_all(self, images: Sequence[np.ndarray], tokens: int = NEW_TOKENS) -> list[str]:
        """Pages in order, a few at a time; the first failure ends it without
        starting what waits."""
        if not images:
            return []
        pool = ThreadPoolExecutor(min(self.in_flight, len(images)))
        try:
            jobs = [pool.submit(self.read, x, tokens) for x in images]
            done, _ = wait(jobs, return_when=FIRST_EXCEPTION)
            for job in jobs:
                if job in done and job.exception():
                    raise job.exception()
            return [job.result() for job in jobs]
        finally:
            pool.shutdown(wait=False, cancel_futures=True)

    def read_each(self, images: Iterable[np.ndarray], tokens: int = NEW_TOKENS) -> list[str | ConversionError]:
        """As ``read_all``, but a failure takes the place of its page."""

        def one(image: np.ndarray) -> str | ConversionError:
            try:
                return self.read(image, tokens)
            except ConversionError as e:
                return e

        with ThreadPoolExecutor(self.in_flight) as pool:
            return list(pool.map(one, images))


def as_image(pixels: bytes, width: int, height: int) -> np.ndarray:
    return np.frombuffer(pixels, np.uint8).reshape(height, width, -1)


def outcome(result: str | ConversionError) -> dict:
    """``md, error, disposition`` of a page."""
    failed = isinstance(result, ConversionError)
    return {"md": None if failed else result, "error": str(result) if failed else None, "disposition": result.disposition if failed else None}


def read_pages(images: DataFrame, connect: Callable[[], Reader] = Reader.connect) -> DataFrame:
    """``doc_id, page_no, md, error, disposition`` for a relation of images (see
    ``schema.IMAGES``). Filter pages before this: nothing is pushed through it.
    A task has as many requests in flight as its reader allows; the tasks that
    run at once multiply that. Pages are read once: store the result."""
    ddl = "doc_id string, page_no int, md string, error string, disposition string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in batches:
            rows = batch.to_pylist()
            try:
                reader = reader or connect()
                results = reader.read_each(as_image(r["pixels"], r["width"], r["height"]) for r in rows)
            except ConversionError as e:  # no reader
                results = [e] * len(rows)
            out = [{"doc_id": r["doc_id"], "page_no": r["page_no"], **outcome(x)} for r, x in zip(rows, results, strict=True)]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("doc_id", pa.string()), ("page_no", pa.int32()), ("md", pa.string()), ("error", pa.string()), ("disposition", pa.string())]))

    images.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    return images.select("doc_id", "page_no", "width", "height", "pixels").mapInArrow(run, ddl)


def worker(reader: Reader, **changes) -> Reader:
    """A copy of a reader with other limits."""
    return replace(reader, **changes)
