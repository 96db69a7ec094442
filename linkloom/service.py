"""A thin HTTP face of the lookup: GET /api/health and POST /api/links.

Each client address has a request limit; the addresses whose window is over are forgotten once there are `MOST` of them.
"""

from __future__ import annotations

import json
import ssl
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from threading import Lock
from time import time

from pyspark.sql import DataFrame

from .operators.lookup import answer
from .operators.ratelimit import Limiter


#: Client addresses that are remembered, bytes of a request, and seconds that a client may take to send it.
MOST, MOST_BYTES, PATIENCE = 100_000, 1 << 20, 5


class Clients:
    """The request limit of each client address."""

    def __init__(self, limit: int, window_seconds: int, most: int = MOST):
        self.limit, self.window_us, self.most = limit, window_seconds * 1_000_000, most
        self.states: dict[str, Limiter] = {}
        self.lock = Lock()

    def refuses(self, address: str, at: int) -> bool:
        with self.lock:
            if len(self.states) >= self.most and address not in self.states:
                self.states = {a: s for a, s in self.states.items() if s.first is not None and at - s.first <= self.window_us}
                while len(self.states) >= self.most:  # all are in use: the oldest goes
                    del self.states[next(iter(self.states))]
            return self.states.setdefault(address, Limiter(self.limit, self.window_us)).refuses(at)


def serve(store: DataFrame, host: str = "127.0.0.1", port: int = 8010, limit: int = 50, window_seconds: int = 900, certificate: tuple[str, str] | None = None) -> ThreadingHTTPServer:
    """A server over a store; call serve_forever() on it.  certificate: the files of a certificate and its key, for TLS."""
    clients = Clients(limit, window_seconds)

    class Handler(BaseHTTPRequestHandler):
        timeout = PATIENCE

        def _send(self, status: int, body: str) -> None:
            self.send_response(status)
            for name, value in (("Content-Type", "application/json"), ("Access-Control-Allow-Origin", "*"), ("Access-Control-Allow-Methods", "GET, POST, OPTIONS"), ("Access-Control-Allow-Headers", "Content-Type")):
                self.send_header(name, value)
            self.end_headers()
            self.wfile.write(body.encode())

        def do_OPTIONS(self) -> None:
            self._send(200, "")

        def do_GET(self) -> None:
            self._send(200, json.dumps({"status": "ok"})) if self.path in ("/api/health", "/health") else self._send(404, "{}")

        def do_POST(self) -> None:
            if self.path != "/api/links":
                return self._send(404, "{}")
            if clients.refuses(self.client_address[0], int(time() * 1e6)):
                return self._send(429, json.dumps({"error_code": "ErrorTooManyRequests", "function": "lookup", "error": "too many requests"}))
            length = self.headers.get("Content-Length") or "0"
            if not length.isdigit() or int(length) > MOST_BYTES:
                return self._send(400, json.dumps({"error_code": "ErrorParsing", "function": "lookup", "error": "the request is too long"}))
            body = self.rfile.read(int(length)).decode("utf-8", "replace")
            return self._send(*answer(store, body))

        def log_message(self, *args) -> None:
            pass

    server = ThreadingHTTPServer((host, port), Handler)
    if certificate:
        context = ssl.SSLContext(ssl.PROTOCOL_TLS_SERVER)
        context.load_cert_chain(*certificate)
        server.socket = context.wrap_socket(server.socket, server_side=True)
    return server
