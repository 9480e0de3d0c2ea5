"""Options of the page sources."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field

# Statuses that are asked for again, and the retry defaults.
RETRY_STATUSES = (429, 500, 502, 503)
RETRIES = 2
BACKOFF_SECONDS = 1.0
TIMEOUT_SECONDS = 30.0

# Pages without records that a stream looks past for the next page.
MAX_GAP = 3


def join_url(base: str, endpoint: str | None) -> str:
    """Base and endpoint with exactly one slash between them."""
    base = base.rstrip("/")
    return f"{base}/{endpoint.strip('/')}" if endpoint and endpoint.strip("/") else base


@dataclass
class Request:
    """How to ask for any page of one endpoint."""

    url: str
    page_param: str = "page"
    params: dict = field(default_factory=dict)
    headers: dict = field(default_factory=dict)
    auth: tuple | None = None
    timeout: float = TIMEOUT_SECONDS
    retries: int = RETRIES
    backoff: float = BACKOFF_SECONDS


@dataclass
class PageOptions:
    """The options of one scan, checked."""

    base_url: str
    endpoints: list[str]
    start_page: int
    max_pages: int
    concurrency: int
    rate: float
    rate_capacity: float
    max_pages_per_trigger: int
    filter_pushdown: bool
    state_path: str | None
    max_gap: int
    request: Request

    @staticmethod
    def parse(options: Mapping[str, str]) -> PageOptions:
        def text(name: str, default: str | None = None) -> str | None:
            value = options.get(name)
            return default if value is None else value

        base_url = text("base_url")
        if not base_url:
            raise ValueError("option base_url is required")
        endpoints = json.loads(text("endpoints", "null")) or [text("endpoint", "")]
        parsed = PageOptions(
            base_url=base_url,
            endpoints=list(endpoints),
            start_page=int(text("start_page", "1")),
            max_pages=int(text("max_pages", "1")),
            concurrency=int(text("concurrency", "4")),
            rate=float(text("rate_per_sec") or text("rate") or 0),
            rate_capacity=float(text("rate_capacity") or text("rate_per_sec") or text("rate") or 0) or 1.0,
            max_pages_per_trigger=int(text("max_pages_per_trigger", "0")),
            filter_pushdown=text("filter_pushdown", "false").lower() == "true",
            state_path=text("state_path"),
            max_gap=int(text("max_gap", str(MAX_GAP))),
            request=parse_request(base_url, options),
        )
        if parsed.concurrency < 1:
            raise ValueError("option concurrency must be at least 1")
        if min(parsed.max_pages, parsed.max_pages_per_trigger, parsed.max_gap) < 0:
            raise ValueError("options max_pages, max_pages_per_trigger and max_gap must not be negative")
        return parsed

    def for_endpoint(self, endpoint: str) -> Request:
        return Request(**{**vars(self.request), "url": join_url(self.base_url, endpoint)})


def parse_request(url: str, options: Mapping[str, str]) -> Request:
    """Request options: `params` and `headers` as JSON objects, or single ones as
    `param.NAME` and `header.NAME` (Spark lower-cases those names); basic
    authentication from `auth.username` with `auth.password` or the variable named
    by `auth.password_env`; `auth_token`, or the variable named by
    `auth_token_env`, is the whole Authorization header; `history_start` and
    `history_end` become the parameters start and end, replacing others of
    that name."""
    params = json.loads(options.get("params") or "{}") | _with_prefix(options, "param.")
    headers = json.loads(options.get("headers") or "{}") | _with_prefix(options, "header.")
    for name, option in (("start", "history_start"), ("end", "history_end")):
        if options.get(option) is not None:
            params[name] = options.get(option)
    token = _secret(options, "auth_token")
    if token:
        headers["Authorization"] = token
    user = options.get("auth.username")
    return Request(
        url=url,
        page_param=options.get("page_param") or "page",
        params=params,
        headers=headers,
        auth=(user, _secret(options, "auth.password") or "") if user else None,
        timeout=float(options.get("timeout") or TIMEOUT_SECONDS),
        retries=int(options.get("retries") or RETRIES),
        backoff=float(options.get("backoff") or BACKOFF_SECONDS),
    )


def _with_prefix(options: Mapping[str, str], prefix: str) -> dict[str, str]:
    return {k[len(prefix):]: options[k] for k in options if k.lower().startswith(prefix)}


def _secret(options: Mapping[str, str], name: str) -> str | None:
    variable = options.get(f"{name}_env")
    if variable:
        if variable not in os.environ:
            raise ValueError(f"environment variable {variable} is not set")
        return os.environ[variable]
    return options.get(name)
