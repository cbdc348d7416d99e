"""/healthz, /readyz and /metrics over HTTP, from a thread of the driver."""

from __future__ import annotations

import threading
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from weir.streaming.metrics import Metrics


def serve(port: int, metrics: Metrics, healthy: Callable[[], bool], ready: Callable[[], bool]) -> ThreadingHTTPServer:
    """Starts the server; port 0 takes a free one. shutdown() ends it."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            if self.path == "/metrics":
                status, body = 200, metrics.prometheus()
            elif self.path in ("/healthz", "/readyz"):
                good = healthy() if self.path == "/healthz" else ready()
                status, body = (200, "ok\n") if good else (503, "not ok\n")
            else:
                status, body = 404, "not found\n"
            raw = body.encode()
            self.send_response(status)
            self.send_header("Content-Type", "text/plain; charset=utf-8")
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

        def log_message(self, *args) -> None:
            pass

    server = ThreadingHTTPServer(("", port), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server
