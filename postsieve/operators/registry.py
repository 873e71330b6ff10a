"""Registry of filter operators: ``name -> builder(view, *params) -> Leaf | Column | bool``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column

from postsieve.operators.leaf import COST_SCALAR, Leaf, PostView

Builder = Callable[..., "Leaf | Column | bool"]


@dataclass(frozen=True)
class Operator:
    name: str
    build: Builder
    needs_model: bool = False


class Registry:
    def __init__(self, operators: dict[str, Operator] | None = None):
        self._operators = dict(operators or {})

    def register(self, name: str, build: Builder, needs_model: bool = False) -> None:
        """Add an operator.  A builder may return a plain boolean ``Column``."""
        self._operators[name] = Operator(name, build, needs_model)

    def copy(self) -> Registry:
        return Registry(self._operators)

    def __contains__(self, name: str) -> bool:
        return name in self._operators

    @property
    def names(self) -> frozenset[str]:
        return frozenset(self._operators)

    @property
    def model_names(self) -> frozenset[str]:
        """Operators which need a model (a "gpu" environment)."""
        return frozenset(o.name for o in self._operators.values() if o.needs_model)

    def build(self, condition: dict, view: PostView) -> Leaf:
        """Build the leaf ``{name: [params]}``; a ``metadata`` key beside it is ignored."""
        for name, params in condition.items():
            if name in self._operators:
                built = self._operators[name].build(view, *_positional(params))
                if isinstance(built, Leaf):
                    return built
                return Leaf(built, COST_SCALAR)
            if name != "metadata":
                raise ValueError(f"Unknown operation '{name}'")
        raise ValueError("Invalid condition structure.")


def _positional(params: Any) -> list:
    if not isinstance(params, (list, tuple)):
        raise ValueError(f"Operator parameters must be a list, got {params!r}")
    return list(params)
