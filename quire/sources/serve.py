"""A page-reader service over HTTP, for tests and for models run at hand.

It has the two routes that ``reader.Reader`` needs: the model list with its
context length, and chat completions on one image.
"""

from __future__ import annotations

import base64
import binascii
import json
import threading
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

#: (image bytes, most tokens) -> text, tokens of the prompt, tokens of the text.
Generate = Callable[[bytes, int], tuple[str, int, int]]


class BadRequest(ValueError):
    """What a client has to put right."""


def image_of(body: dict) -> bytes:
    """The first image among the messages, from its base64 data URI."""
    for message in body.get("messages") or []:
        content = message.get("content")
        for part in content if isinstance(content, list) else []:
            if part.get("type") == "image_url":
                _, comma, data = part["image_url"]["url"].partition(",")
                try:
                    return base64.b64decode(data if comma else "", validate=True) or _refuse("the image is empty")
                except binascii.Error:
                    _refuse("the image is not base64")
    return _refuse("there is no image")


def _refuse(why: str):
    raise BadRequest(why)


def completion(body: dict, model: str, generate: Generate, lock: threading.Lock) -> dict:
    """One reply; generation runs one request at a time. It ended for length
    if it used all the tokens that it might."""
    image, most = image_of(body), int(body.get("max_tokens") or 2048)
    with lock:
        text, prompt, made = generate(image, most)
    return {
        "model": model,
        "choices": [{"index": 0, "message": {"role": "assistant", "content": text}, "finish_reason": "length" if made >= most else "stop"}],
        "usage": {"prompt_tokens": prompt, "completion_tokens": made, "total_tokens": prompt + made},
    }


def serve(generate: Generate, *, model: str = "page-reader", context: int = 8192, host: str = "127.0.0.1", port: int = 0) -> ThreadingHTTPServer:
    """A started server; ``server_address`` tells the port, ``shutdown()`` ends it."""
    lock = threading.Lock()

    class Handler(BaseHTTPRequestHandler):
        protocol_version = "HTTP/1.1"  # connections stay open

        def reply(self, status: int, payload: dict) -> None:
            data = json.dumps(payload).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def do_GET(self) -> None:  # noqa: N802
            if self.path.rstrip("/").endswith("/models"):
                self.reply(200, {"object": "list", "data": [{"id": model, "object": "model", "max_model_len": context}]})
            else:
                self.reply(404, {"error": "no such route"})

        def do_POST(self) -> None:  # noqa: N802
            try:
                body = json.loads(self.rfile.read(int(self.headers.get("Content-Length", 0))))
                self.reply(200, completion(body, model, generate, lock))
            except (BadRequest, ValueError, KeyError, TypeError, AttributeError) as e:
                self.close_connection = True  # what is left of the body
                self.reply(400, {"error": str(e)})

        def log_message(self, *args) -> None:
            pass

    server = ThreadingHTTPServer((host, port), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server
