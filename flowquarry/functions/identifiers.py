"""Device, user and host identifiers: normal forms and keyed tokens."""

from __future__ import annotations

import hashlib
import hmac
from collections.abc import Callable
from pathlib import Path

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_mac(mac: Column) -> Column:
    """Twelve lower-case hex digits, '' if there are none.

    The text before the first colon counts alone if it holds twelve digits (a station id may
    carry a network name after it), else the whole text's digits do.
    """
    digits = lambda c: F.regexp_replace(c, "[^0-9A-Fa-f]", "")
    mac = F.coalesce(mac, F.lit(""))
    head, whole = digits(F.substring_index(mac, ":", 1)), digits(mac)
    return F.lower(F.when(F.length(head) == 12, head).when(F.length(whole) == 12, whole).otherwise(""))


def normal_user(user: Column) -> Column:
    """The account without domain or realm, in lower case."""
    return F.lower(F.substring_index(F.substring_index(F.trim(F.coalesce(user, F.lit(""))), "\\", -1), "@", 1))


def normal_host(host: Column) -> Column:
    """A host name without one trailing dot, in lower case."""
    return F.lower(F.regexp_replace(F.trim(F.coalesce(host, F.lit(""))), r"\.$", ""))


Tokens = Callable[[Column], Column]


def passthrough(text: Column) -> Column:
    """For logs whose identifiers are tokens already."""
    return F.coalesce(text, F.lit(""))


def read_key(path: str) -> bytes:
    """The token key: a file's trimmed content, which must not be empty."""
    key = Path(path).read_bytes().strip()
    if not key:
        raise ValueError(f"token key {path} is empty")
    return key


def tokenizer(key: bytes) -> Tokens:
    """Keyed tokens: the first 32 hex digits of HMAC-SHA256; '' stays ''.

    An Arrow function, so that the key is in no plan, user interface or event log.
    """

    @F.pandas_udf("string")
    def token(text: pd.Series) -> pd.Series:
        return text.map(lambda x: hmac.new(key, x.encode(), hashlib.sha256).hexdigest()[:32] if x else "")

    return token


class Identity:
    """Tokens of the three kinds of identifiers for a mode of config.identity_mode()."""

    def __init__(self, mode: str, key: bytes | None = None):
        if mode == "hashed":
            if not key:
                raise ValueError("hashed mode needs a key")
            make = tokenizer(key)
            self.mac, self.user, self.host = (lambda c: make(normal_mac(c))), (lambda c: make(normal_user(c))), (lambda c: make(normal_host(c)))
        elif mode == "passthrough":
            self.mac = self.user = self.host = passthrough
        else:
            raise ValueError(f"no tokens in mode {mode!r}")
