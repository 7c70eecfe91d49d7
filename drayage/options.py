"""Connector options: what each connector takes, and the checks on it.

Unknown names raise, so a misspelt option never passes for its default.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

TRUE_WORDS = frozenset({"1", "true", "yes", "y"})


@dataclass(frozen=True)
class OptionSpec:
    connector: str
    required: tuple[str, ...] = ()
    optional: Mapping[str, Any] = field(default_factory=dict)
    any_of: tuple[tuple[str, ...], ...] = ()
    exclusive: tuple[tuple[str, ...], ...] = ()
    together: tuple[tuple[str, ...], ...] = ()
    choices: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    positive: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    json_objects: tuple[str, ...] = ()

    def names(self) -> set[str]:
        grouped = {n for group in (*self.any_of, *self.exclusive, *self.together) for n in group}
        return set(self.required) | set(self.optional) | grouped

    def check(self, given: Mapping[str, Any]) -> dict[str, Any]:
        """Return the options with defaults filled in and values converted, or raise."""
        values = {k: v for k, v in given.items() if v is not None}
        unknown = sorted(set(values) - self.names())
        if unknown:
            raise ValueError(
                f"{self.connector}: unknown option(s) {', '.join(unknown)}; "
                f"known options are {', '.join(sorted(self.names()))}"
            )
        missing = [n for n in self.required if values.get(n) in (None, "")]
        if missing:
            raise ValueError(f"{self.connector}: option(s) {', '.join(missing)} required")
        for group in self.any_of:
            if not any(values.get(n) for n in group):
                raise ValueError(f"{self.connector}: specify one of {' or '.join(group)}")
        for group in self.exclusive:
            if sum(bool(values.get(n)) for n in group) > 1:
                raise ValueError(f"{self.connector}: specify only one of {', '.join(group)}")
        for group in self.together:
            if any(values.get(n) for n in group) and not all(values.get(n) for n in group):
                raise ValueError(f"{self.connector}: {' and '.join(group)} must be provided together")
        merged = {**self.optional, **values}
        for name, allowed in self.choices.items():
            if merged.get(name) not in allowed:
                raise ValueError(
                    f"{self.connector}: {name} `{merged.get(name)}` is not supported; "
                    f"must be one of: {', '.join(allowed)}"
                )
        for name in self.positive:
            merged[name] = _positive(self.connector, name, merged[name])
        for name in self.flags:
            merged[name] = as_flag(merged[name])
        for name in self.json_objects:
            if merged.get(name) is not None:
                merged[name] = json_object(self.connector, name, merged[name])
        return merged


def as_flag(value: Any) -> bool:
    return str(value).strip().lower() in TRUE_WORDS


def json_object(connector: str, name: str, value: Any) -> dict[str, Any]:
    if isinstance(value, Mapping):
        return dict(value)
    try:
        parsed = json.loads(value)
    except json.JSONDecodeError as error:
        raise ValueError(f"{connector}: option '{name}' must be valid JSON") from error
    if not isinstance(parsed, dict):
        raise ValueError(f"{connector}: option '{name}' must be a JSON object")
    return parsed


def _positive(connector: str, name: str, value: Any) -> int:
    try:
        number = int(value)
    except (TypeError, ValueError):
        number = 0
    if number <= 0:
        raise ValueError(f"{connector}: option '{name}' must be a positive integer")
    return number
