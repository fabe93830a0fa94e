"""Settings from the environment, log time zones, identity mode."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from datetime import timedelta
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

_UNITS = {"h": 3600.0, "m": 60.0, "s": 1.0, "ms": 1e-3, "us": 1e-6, "µs": 1e-6, "ns": 1e-9}


class ConfigError(ValueError):
    """A setting that must not be replaced by a default."""


def text(name: str, fallback: str, env: Mapping[str, str] = os.environ) -> str:
    return env.get(name) or fallback


def integer(name: str, fallback: int, env: Mapping[str, str] = os.environ) -> int:
    value = env.get(name, "")
    return int(value) if re.fullmatch(r"[+-]?\d+", value) else fallback


def boolean(name: str, fallback: bool, env: Mapping[str, str] = os.environ) -> bool:
    value = env.get(name, "")
    if value in ("1", "t", "T", "true", "TRUE", "True"):
        return True
    return False if value in ("0", "f", "F", "false", "FALSE", "False") else fallback


def duration(name: str, fallback: timedelta, env: Mapping[str, str] = os.environ) -> timedelta:
    """A duration like 1h30m; anything else gives the fallback."""
    value = env.get(name, "")
    parts = re.findall(r"(\d+(?:\.\d+)?)(ns|us|µs|ms|s|m|h)", value)
    if not parts or "".join(a + b for a, b in parts) != value.lstrip("+-"):
        return fallback
    total = sum(float(a) * _UNITS[b] for a, b in parts)
    return timedelta(seconds=-total if value.startswith("-") else total)


def log_zone(source_setting: str, global_setting: str = "LOG_TZ", env: Mapping[str, str] = os.environ) -> str:
    """IANA zone of a log source: its own setting, then the global one, then UTC. A bad name is fatal."""
    name = env.get(source_setting) or env.get(global_setting) or "UTC"
    try:
        ZoneInfo(name)
    except (ZoneInfoNotFoundError, ValueError, OSError) as error:
        raise ConfigError(f"unknown time zone {name!r}") from error
    return name


def identity_mode(upstream_anonymised: bool, key_file_set: bool, any_log_dir: bool) -> str:
    """'off', 'passthrough' (tokens come ready) or 'hashed'.

    With log folders, claiming both ready tokens and a key is a contradiction and fatal; with
    neither, identities stay off: nothing is ever stored raw by default.
    """
    if any_log_dir and upstream_anonymised and key_file_set:
        raise ConfigError("upstream tokens and a token key exclude each other")
    if not any_log_dir or not (upstream_anonymised or key_file_set):
        return "off"
    return "passthrough" if upstream_anonymised else "hashed"
