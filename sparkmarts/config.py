"""Settings that raw ingestion and the silver event table must agree on."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

# The setting's name, default and largest value.
LOOKBACK_VARIABLE, LOOKBACK_DEFAULT, LOOKBACK_MOST = "INGESTION_LOOKBACK_SECONDS", 7200, 2**31 - 1


@dataclass(frozen=True)
class Settings:
    """How far behind the newest event a run reads again."""

    lookback_seconds: int = LOOKBACK_DEFAULT

    def __post_init__(self):
        if not 0 <= self.lookback_seconds <= LOOKBACK_MOST:
            raise ValueError(f"the lookback must be from 0 to {LOOKBACK_MOST} seconds, not {self.lookback_seconds}")

    @classmethod
    def of(cls, environment: Mapping[str, str]) -> Settings:
        if LOOKBACK_VARIABLE not in environment:
            return cls()
        digits = environment[LOOKBACK_VARIABLE].strip()
        if not digits or not set(digits) <= set("0123456789"):
            raise ValueError(f"{LOOKBACK_VARIABLE} is not a whole number: {digits!r}")
        return cls(int(digits))


def lookback(given: int | None = None) -> int:
    """The lookback of a call: the one given, else the process's setting."""
    return Settings.of(os.environ).lookback_seconds if given is None else Settings(given).lookback_seconds
