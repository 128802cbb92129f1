"""Plain HTTP with retries; every function takes its opener, so nothing here needs a network to be tested."""

from __future__ import annotations

import time
import urllib.request
from collections.abc import Callable

TIMEOUT_S, TRIES = 120, 3


def _open(request: urllib.request.Request):
    return urllib.request.urlopen(request, timeout=TIMEOUT_S)


def fetch(url: str, headers: dict[str, str] | None = None, tries: int = TRIES, opener: Callable = _open, sleep: Callable = time.sleep) -> bytes:
    """The body; waits 2 and 4 seconds between tries and raises what the last one raised."""
    for attempt in range(1, tries + 1):
        try:
            with opener(urllib.request.Request(url, headers=headers or {})) as answer:
                return answer.read()
        except Exception:
            if attempt == tries:
                raise
            sleep(2**attempt)
    raise AssertionError("no try")


def fetch_range(url: str, start: int, end: int | None, **kw) -> bytes:
    """Bytes start to end, without end; to the end of the file if that is None."""
    return fetch(url, {"Range": f"bytes={start}-{'' if end is None else end - 1}"}, **kw)


def exists(url: str, opener: Callable = _open) -> bool:
    """Whether HEAD gives 200; any failure is a no."""
    try:
        with opener(urllib.request.Request(url, method="HEAD")) as answer:
            return answer.status == 200
    except Exception:
        return False
