"""Relations by name: a function's parameters name the relations it reads."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame

RELATIONS: dict[str, Callable[..., DataFrame]] = {}


def relation(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    RELATIONS[build.__name__] = build
    return build


def inputs_of(name: str) -> tuple[str, ...]:
    return tuple(inspect.signature(RELATIONS[name]).parameters)


class Marts(Mapping):
    """Lazy relations over given tables; anything already given (raw or materialised) is used as is."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self._given = tables
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in self._given:
                self._frames[name] = self._given[name]
            elif name in RELATIONS:
                self._frames[name] = RELATIONS[name](*(self[parent] for parent in inputs_of(name)))
            else:
                raise KeyError(f"unknown relation: {name}")
        return self._frames[name]

    def __contains__(self, name: object) -> bool:
        return name in self._given or name in RELATIONS

    def __iter__(self) -> Iterator[str]:
        return iter({**dict.fromkeys(self._given), **dict.fromkeys(RELATIONS)})

    def __len__(self) -> int:
        return sum(1 for _ in self)
