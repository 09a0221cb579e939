"""The registry that plans dispatch through: operators by name, with their kind and parameters."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass


@dataclass(frozen=True)
class Operator:
    name: str
    kind: str  # "selection", "transformation" or "postprocessing"
    function: Callable
    keyed: bool  # takes the column it is declared under as its first parameter

    @property
    def parameters(self) -> dict[str, inspect.Parameter]:
        return dict(list(inspect.signature(self.function).parameters.items())[1:])

    def check(self, given: dict) -> None:
        known = set(self.parameters)
        if unknown := sorted(set(given) - known):
            raise TypeError(f"{self.name}: unknown parameters {unknown}; known: {sorted(known)}")


REGISTRY: dict[str, Operator] = {}


def operator(kind: str, keyed: bool = True, name: str | None = None):
    def add(function: Callable) -> Callable:
        known = name or function.__name__
        REGISTRY[known] = Operator(known, kind, function, keyed)
        return function

    return add
