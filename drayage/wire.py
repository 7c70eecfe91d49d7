"""Plain HTTP for ``fetch`` and ``deliver``.

Credentials live in the closure, which Spark ships with the task; they never become part of
a landed or outbox row.  ``requests`` is imported where it is used, on the executors.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Mapping
from typing import Any

from drayage.landed import Get
from drayage.operators.deliver import Send

TIMEOUT_SECONDS = 30


def basic_auth(username: str, password: str) -> dict[str, str]:
    token = base64.b64encode(f"{username}:{password}".encode()).decode()
    return {"Authorization": f"Basic {token}"}


def bearer(token: str | None) -> dict[str, str]:
    return {"Authorization": f"Bearer {token}"} if token else {}


def http_get(headers: Mapping[str, str] | None = None, secret_params: Mapping[str, str] | None = None) -> Get:
    """Ask ``request["url"]``, with ``request["body"]`` as JSON where there is one."""
    headers, secret_params = dict(headers or {}), dict(secret_params or {})
    timeout = TIMEOUT_SECONDS

    def get(request: dict[str, Any]) -> tuple[int, str]:
        import requests

        body = request.get("body")
        answer = requests.request(
            "GET" if body is None else "POST",
            request["url"],
            data=body,
            params=secret_params,
            headers={**headers, **({} if body is None else {"Content-Type": "application/json"})},
            timeout=timeout,
        )
        return answer.status_code, answer.text

    return get


def http_send(
    base_url: str,
    headers: Mapping[str, str] | None = None,
    secret_params: Mapping[str, str] | None = None,
    refused: Callable[[str, dict[str, Any]], list[int]] | None = None,
) -> Send:
    """Send an outbox request to ``base_url`` plus its path.

    ``refused`` tells from the text of a good answer which records of the request were not taken.
    """
    headers, secret_params = dict(headers or {}), dict(secret_params or {})
    timeout = TIMEOUT_SECONDS

    def send(request: dict[str, Any]) -> dict[str, Any]:
        import requests

        answer = requests.request(
            request["method"],
            base_url.rstrip("/") + request["path"],
            data=request["body"].encode(),
            params=secret_params,
            headers={"Content-Type": "application/json", **headers},
            timeout=timeout,
        )
        if not answer.ok:
            return {"status": answer.status_code, "error": answer.text}
        if refused is None:
            return {"status": answer.status_code, "error": None}
        lost = refused(answer.text, request)
        error = answer.text if lost else None
        return {"status": answer.status_code, "refused": lost, "error": error}

    return send
