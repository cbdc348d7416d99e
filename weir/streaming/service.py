"""Rows to a table service over HTTP, and a server of our own that fails on purpose, to test and to time against.

POST /append/<table> has a wire schema and wire rows, each with its length as four bytes before it; POST /load/<table>
has lines of JSON. 200 takes them; another status has {"code", "message", "rows"} as its body.
"""

from __future__ import annotations

import http.client
import json
import struct
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import quote, unquote, urlsplit

from weir.streaming.remote import FaultyService, Service, ServiceError, rest_retry

TIMEOUT_S = 60
_LENGTH = struct.Struct("<I")


def packed(parts: list[bytes]) -> bytes:
    return b"".join(x for part in parts for x in (_LENGTH.pack(len(part)), part))


def unpacked(raw: bytes) -> list[bytes]:
    found, at = [], 0
    while at < len(raw):
        (size,) = _LENGTH.unpack_from(raw, at)
        found.append(raw[at + 4 : at + 4 + size])
        at += 4 + size
    return found


class HttpService:
    """A client with one connection, opened anew when it breaks."""

    def __init__(self, url: str, sleep=time.sleep):
        self.parts, self.sleep = urlsplit(url), sleep
        self.connection: http.client.HTTPConnection | None = None

    def _post(self, path: str, body: bytes) -> tuple[int, str]:
        if self.connection is None:
            kind = http.client.HTTPSConnection if self.parts.scheme == "https" else http.client.HTTPConnection
            self.connection = kind(self.parts.netloc, timeout=TIMEOUT_S)
        try:
            self.connection.request("POST", f"{self.parts.path.rstrip('/')}/{path}", body)
            answer = self.connection.getresponse()
            return answer.status, answer.read().decode()
        except (http.client.HTTPException, OSError) as error:
            self.connection.close()
            self.connection = None
            raise OSError(str(error)) from error

    def append(self, table: str, schema: bytes, rows: list[bytes]) -> None:
        try:
            status, body = self._post(f"append/{quote(table)}", packed([schema, *rows]))
        except OSError as error:
            raise ServiceError("UNAVAILABLE", str(error)) from error
        if status != 200:
            try:
                told = json.loads(body)
            except ValueError:
                raise ServiceError("UNAVAILABLE" if status >= 500 else f"HTTP {status}", body[:500]) from None
            raise ServiceError(told["code"], told["message"], tuple(told["rows"]))

    def load(self, table: str, lines: list[str]) -> None:
        """A load is tried again by the rules of REST requests."""
        rest_retry(sleep=self.sleep)(lambda: self._post(f"load/{quote(table)}", "\n".join(lines).encode()))


def serve_rows(service: FaultyService | Service, port: int = 0) -> ThreadingHTTPServer:
    """Starts a server of a service, which gets one call at a time; port 0 takes a free one. shutdown() ends it."""
    lock = threading.Lock()

    class Handler(BaseHTTPRequestHandler):
        protocol_version = "HTTP/1.1"

        def do_POST(self) -> None:
            raw = self.rfile.read(int(self.headers.get("Content-Length", 0)))
            _, kind, table = self.path.rsplit("/", 2)
            status, body = 200, b""
            try:
                with lock:
                    if kind == "append":
                        schema, *rows = unpacked(raw)
                        service.append(unquote(table), schema, rows)
                    else:
                        service.load(unquote(table), raw.decode().split("\n"))
            except ServiceError as error:
                status = 400 if error.rows or error.code == "INVALID_ARGUMENT" else 503
                body = json.dumps({"code": error.code, "message": error.message, "rows": error.rows}).encode()
            self.send_response(status)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args) -> None:
            pass

    server = ThreadingHTTPServer(("", port), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server
