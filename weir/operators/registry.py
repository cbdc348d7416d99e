"""Writer schemas by global id: from a folder, a dict, or a registry over HTTP; and the schema column's texts.

Schemas are few and small: the driver resolves the distinct ids of a batch and broadcasts them, so that executors make
no calls. A missing schema is a decode error of its messages.
"""

from __future__ import annotations

import base64
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable
from pathlib import Path
from typing import Any

from weir.functions.canonical import parse

ATTEMPTS = 10
FIRST_WAIT, LONGEST_WAIT = 0.5, 30.0
TIMEOUT_S = 30


class RegistryError(RuntimeError):
    """A registry that does not answer, or not with a schema."""


def named_envelope(schema: Any) -> Any:
    """A record schema under the name Envelope, whatever its own."""
    return {**schema, "name": "Envelope"} if isinstance(schema, dict) else schema


class Registry:
    """Resolves ids once each; load gives a schema's text, or None for an unknown id."""

    def __init__(self, load: Callable[[int], str | None]):
        self.load = load
        self.known: dict[int, Any] = {}

    def resolve(self, ids: Iterable[int]) -> dict[int, Any]:
        """The schemas of the ids given that exist: what is broadcast with a batch is what the batch needs."""
        found = {}
        for schema_id in ids:
            if schema_id not in self.known and (text := self.load(schema_id)) is not None:
                self.known[schema_id] = named_envelope(parse(text))
            if schema_id in self.known:
                found[schema_id] = self.known[schema_id]
        return found


def from_folder(folder: str) -> Registry:
    """Schemas in <folder>/<id>.json."""

    def load(schema_id: int) -> str | None:
        path = Path(folder, f"{schema_id}.json")
        return path.read_text(encoding="utf-8") if path.exists() else None

    return Registry(load)


def from_dict(schemas: dict[int, Any]) -> Registry:
    return Registry(lambda i: json.dumps(schemas[i]) if i in schemas else None)


def from_http(url: str, username: str = "", password: str = "", sleep: Callable[[float], None] = time.sleep, opened=urllib.request.urlopen) -> Registry:
    """A registry with global ids. Transport errors, 5xx and 429 are tried again, with doubling waits."""
    token = base64.b64encode(f"{username}:{password}".encode()).decode()

    def load(schema_id: int) -> str | None:
        request = urllib.request.Request(f"{url.rstrip('/')}/apis/registry/v2/ids/globalIds/{schema_id}")
        if username:
            request.add_header("Authorization", f"Basic {token}")
        wait, failed = FIRST_WAIT, None
        for _ in range(ATTEMPTS):
            try:
                with opened(request, timeout=TIMEOUT_S) as answer:
                    return answer.read().decode()
            except urllib.error.HTTPError as error:
                if error.code == 404:
                    return None
                if error.code < 500 and error.code != 429:
                    raise RegistryError(f"schema {schema_id}: status {error.code}") from error
                failed = error
            except OSError as error:
                failed = error
            sleep(wait)
            wait = min(2 * wait, LONGEST_WAIT)
        raise RegistryError(f"schema {schema_id}: {failed}")

    return Registry(load)
