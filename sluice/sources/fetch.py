"""One page: over HTTP, or from a file system that executors share."""

from __future__ import annotations

import time
from collections.abc import Callable
from email.utils import parsedate_to_datetime
from urllib.parse import quote, urlsplit

from sluice.sources.options import RETRY_STATUSES, Request

# (status, body, error)
Answer = tuple[int | None, str | None, str | None]


class Fetcher:
    """Asks for pages one after the other, as task `index` of `count`.

    If `rate` is set, all tasks together make at most that many requests a second: each has
    an equal part of the rate and of `capacity`, the requests that may go out at once. First
    requests are staggered. (`pacing` shares a rate among the tasks that have work.)
    `new_session` makes the HTTP session, for proxies, certificates or adapters.
    """

    def __init__(
        self, rate: float = 0.0, capacity: float = 1.0, index: int = 0, count: int = 1, new_session: Callable | None = None
    ):
        self.rate = rate / count
        self.most = max(capacity / count, 1.0)
        self.tokens = self.most - index / count
        self.at = time.monotonic()
        self.session = None
        self.new_session = new_session

    def page(self, request: Request, page: int | None) -> Answer:
        """The answer after all retries; between them the task sleeps."""
        for attempt in range(request.retries + 1):
            answer, wait = self.ask(request, page, attempt)
            if wait is None or attempt == request.retries:
                break
            time.sleep(wait)
        return answer

    def ask(self, request: Request, page: int | None, attempt: int = 0) -> tuple[Answer, float | None]:
        """One request, and how many seconds to wait before another try: None if a try would
        not help, else the backoff of this attempt, or what the server's Retry-After asks for."""
        if urlsplit(request.url).scheme not in ("http", "https"):
            return read_file(request, page), None
        import requests

        if self.session is None:
            self.session = self.new_session() if self.new_session else requests.Session()
        params = dict(request.params)
        if page is not None:
            params[request.page_param] = page
        backoff = request.backoff * 2**attempt if attempt else 0.0
        self._wait_for_token()
        try:
            answer = self.session.get(
                request.url,
                params=params,
                headers=request.headers,
                auth=request.auth,
                timeout=request.timeout,
            )
        except (requests.ConnectionError, requests.Timeout) as e:
            return (None, None, f"{type(e).__name__}: {e}"), backoff
        except requests.RequestException as e:
            return (None, None, f"{type(e).__name__}: {e}"), None
        again = answer.status_code in RETRY_STATUSES
        return _decoded(answer), max(backoff, retry_after(answer.headers.get("Retry-After"))) if again else None

    def _wait_for_token(self) -> None:
        if self.rate <= 0:
            return
        now = time.monotonic()
        self.tokens = min(self.most, self.tokens + (now - self.at) * self.rate)
        self.at = now
        if self.tokens < 1:
            time.sleep((1 - self.tokens) / self.rate)
            # What refills while sleeping is this request's own token.
            self.at = time.monotonic()
            self.tokens = 1
        self.tokens -= 1


def retry_after(header: str | None, now: float | None = None) -> float:
    """Seconds that a Retry-After header asks to wait, given as a number or as a date; 0 if it
    is missing, past or unreadable."""
    text = (header or "").strip()
    if text.isascii() and text.isdigit():
        return float(text)
    try:
        return max(0.0, parsedate_to_datetime(text).timestamp() - (time.time() if now is None else now))
    except ValueError:
        return 0.0


def _decoded(answer) -> Answer:
    try:
        return answer.status_code, answer.content.decode("utf-8-sig"), None
    except UnicodeDecodeError as e:
        return answer.status_code, None, f"{type(e).__name__}: {e}"


def page_location(request: Request, page: int | None) -> str:
    """Where a page lies: `url/page=N`, in place of the query parameter."""
    return request.url if page is None else f"{request.url}/{quote(request.page_param)}={page}"


def read_file(request: Request, page: int | None) -> Answer:
    """A page kept as a file, or as a folder of part files; 404 if there is none."""
    from pyarrow import fs

    location = page_location(request, page)
    try:
        files, path = open_file_system(location)
        info = files.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            return 404, None, None
        paths = [path]
        if info.type == fs.FileType.Directory:
            found = files.get_file_info(fs.FileSelector(path))
            paths = sorted(f.path for f in found if f.is_file and f.base_name[0] not in "._")
        body = b"".join(files.open_input_stream(p).read() for p in paths)
        return 200, body.decode("utf-8"), None
    except (OSError, UnicodeDecodeError) as e:
        return None, None, f"{type(e).__name__}: {e}"


def open_file_system(location: str):
    from pyarrow import fs

    if "://" in location:
        return fs.FileSystem.from_uri(location.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), location.removeprefix("file:")
