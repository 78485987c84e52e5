"""A paginated API with tokens, retries and renewal; the token chain is sequential, so it is read on the driver."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from urllib.parse import urlencode

TEMPORARY = frozenset({429, 500, 502, 503, 504})
ATTEMPTS, FIRST_WAIT, LONGEST_WAIT, RENEW_BEFORE, LIFETIME = 6, 0.5, 30.0, 60.0, 3600.0


class ApiError(RuntimeError):
    """The source cannot be read whole."""


def urllib_transport(method: str, url: str, headers: dict, body: bytes | None) -> tuple[int, dict, bytes]:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, body, headers, method=method), timeout=30) as r:
            return r.status, dict(r.headers), r.read()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers), e.read()


class Client:
    """transport(method, url, headers, body) -> (status, headers, body); it may raise OSError."""

    def __init__(self, base: str, user: str, secret: str, transport: Callable = urllib_transport, sleep: Callable = time.sleep, clock: Callable = time.monotonic):
        self.base, self.user, self.secret = base.rstrip("/"), user, secret
        self.transport, self.sleep, self.clock = transport, sleep, clock
        self.token, self.expires = None, 0.0

    def _send(self, method: str, path: str, headers: dict, body: bytes | None = None) -> tuple[int, object]:
        for attempt in range(1, ATTEMPTS + 1):
            wait, why = min(LONGEST_WAIT, FIRST_WAIT * 2 ** (attempt - 1)), ""
            try:
                status, got, raw = self.transport(method, self.base + path, headers, body)
                if status not in TEMPORARY:
                    try:
                        return status, json.loads(raw)
                    except ValueError:
                        if status >= 400:
                            return status, None
                        why = "the body is no JSON"
                else:
                    why = f"status {status}"
                    after = {k.lower(): v for k, v in got.items()}.get("retry-after", "")
                    wait = min(LONGEST_WAIT, float(after)) if after.replace(".", "", 1).isdigit() else wait
            except OSError as e:
                why = str(e)
            if attempt < ATTEMPTS:
                self.sleep(wait)
        raise ApiError(f"{path}: {why} after {ATTEMPTS} attempts")

    def _login(self) -> None:
        status, found = self._send("POST", "/auth/token", {"Content-Type": "application/json"}, json.dumps({"client_id": self.user, "client_secret": self.secret}).encode())
        if status != 200 or not isinstance(found, dict) or "access_token" not in found:
            raise ApiError(f"login failed with status {status}")
        self.token, self.expires = found["access_token"], self.clock() + float(found.get("expires_in", LIFETIME))

    def get(self, path: str, params: dict | None = None) -> dict:
        again = True
        while True:
            if self.token is None or self.clock() > self.expires - RENEW_BEFORE:
                self._login()
            status, found = self._send("GET", path + (f"?{urlencode(params)}" if params else ""), {"Authorization": f"Bearer {self.token}"})
            if status == 401 and again:
                self.token, again = None, False
                continue
            if status != 200 or not isinstance(found, dict):
                raise ApiError(f"{path}: status {status}")
            return found

    def fetch_all(self, path: str, params: dict | None = None, page_size: int = 500) -> tuple[list[dict], list[int]]:
        """All records and each one's page number; a total that changes, a token that repeats or a short read is an error."""
        records: list[dict] = []
        pages: list[int] = []
        token, seen, total = None, set(), None
        while True:
            page = self.get(path, {**(params or {}), "page_size": page_size, **({"page_token": token} if token else {})})
            data, about = page.get("data"), page.get("pagination")
            if not isinstance(data, list) or not all(isinstance(x, dict) for x in data) or not isinstance(about, dict) or about.get("returned") != len(data) or type(about.get("total_count")) is not int:
                raise ApiError(f"{path}: malformed page")
            if total not in (None, about["total_count"]):
                raise ApiError(f"{path}: the total changed while reading")
            total = about["total_count"]
            records += data
            pages += [len(seen) + 1] * len(data)
            token = about.get("next_token")
            if not token:
                break
            if token in seen:
                raise ApiError(f"{path}: the page token repeats")
            seen.add(token)
        if len(records) != total:
            raise ApiError(f"{path}: {len(records)} of {total} records")
        return records, pages
