"""Sluice: paged JSON API payloads to typed tables, as plain Spark plans."""

from sluice.session import configure, shared_folder

__all__ = ["configure", "shared_folder"]
