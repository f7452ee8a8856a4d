"""Job descriptions: a process document over a global document, both plain dicts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

# The kinds of module a job is made of.
MODULES = ("extract", "transform", "load")


def _named(document: Mapping[str, Any], name: str) -> dict[str, Any] | None:
    for entry in document.get("config_app") or []:
        if entry.get("name") == name:
            return dict(entry.get("properties") or {})
    return None


@dataclass(frozen=True)
class Job:
    """What to run, and for which batch and period.

    Documents may hold credentials, so they are kept out of the printed form.
    """

    process: Mapping[str, Any] = field(repr=False)
    shared: Mapping[str, Any] = field(default_factory=dict, repr=False)
    batch_id: str | None = None
    period: str | None = None

    def modules(self, kind: str) -> list[dict[str, Any]]:
        """All modules of one kind, in document order across blocks."""
        if kind not in MODULES:
            raise ValueError(f"unknown module kind {kind!r}")
        return [
            dict(module)
            for block in self.process.get("process_modules") or []
            for module in block.get(kind) or []
        ]

    def settings(self, name: str) -> dict[str, Any]:
        """Named settings; the process document wins key by key."""
        return {**(_named(self.shared, name) or {}), **(_named(self.process, name) or {})}

    def connection(self, name: str) -> dict[str, Any]:
        """A named connection of the global document."""
        found = _named(self.shared, name)
        if found is None:
            raise KeyError(f"no connection named {name!r}")
        return found

    def parallelism(self) -> int:
        """How many independent loads may run at the same time; without a setting, they run in document order."""
        return max(1, int(self.settings("load").get("parallelism", 1)))
