"""Feed filters: AND/OR trees of operators, and their translation to columns."""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from postsieve.operators.leaf import COST_CONSTANT, COST_MODEL, Leaf, Need, PostView
from postsieve.operators.registry import Registry

Predicate = Column | bool


BRANCHES = ("and", "or")
# Messages by which callers know what is wrong with a manifest.
UNKNOWN_CONDITION = "Condition ID {} not found in condition_map."
MALFORMED = "Unexpected condition format: {}"


def stored_condition(conditions: dict[int, dict], number: int) -> dict:
    """The tree a stored condition stands for: its parameters if it is a component, else one leaf."""
    row = conditions.get(number) or None
    if row is None:
        raise ValueError(UNKNOWN_CONDITION.format(number))
    parameters = row["condition_parameters"]
    return parameters if row.get("algorithm_component_id") else {row.get("operator_name"): parameters}


def resolve_ids(tree: Any, conditions: dict[int, dict]) -> Any:
    """``tree`` with stored conditions in place of their ids, wherever a branch or list has them."""
    match tree:
        case bool():
            raise ValueError(MALFORMED.format(tree))
        case int():
            return stored_condition(conditions, tree)
        case list():
            return [resolve_ids(part, conditions) for part in tree]
        case dict():
            grown = {name: resolve_ids(list(tree[name]), conditions) for name in BRANCHES if name in tree}
            return tree | grown
    raise ValueError(MALFORMED.format(tree))


def rehydrate(manifest: dict | None, conditions: dict[int, dict]) -> dict:
    """A manifest whose filter holds whole conditions; inline ones stay.  ``{}`` for no manifest."""
    whole = dict(manifest or {})
    if "filter" in whole:
        whole["filter"] = resolve_ids(whole["filter"], conditions)
    return whole


def extract_conditions(condition: Any) -> list[dict]:
    """The leaves of a tree in order, each as ``{operator: params}``."""
    leaves, open_parts = [], [condition]
    while open_parts:
        part = open_parts.pop()
        if isinstance(part, tuple):
            name, inside = part
            if name in BRANCHES:
                open_parts.append(inside)
            else:
                leaves.append({name: inside})
        elif isinstance(part, list):
            open_parts.extend(part[::-1])
        elif isinstance(part, dict):
            open_parts.extend(list(part.items())[::-1])
    return leaves


def operators_of(condition: Any) -> set[str]:
    return {key for leaf in extract_conditions(condition) for key in leaf} - {"metadata"}


def is_operable(manifest: dict, registry: Registry) -> bool:
    return operators_of(manifest.get("filter") or []) <= registry.names


def environment(manifest: dict, registry: Registry) -> str:
    return "gpu" if operators_of(manifest.get("filter") or []) & registry.model_names else "cpu"


@dataclass(frozen=True)
class Node:
    """A compiled node; ``condition`` is the JSON it came from, ``path`` its place in the tree."""

    condition: dict
    path: str
    connective: str | None = None
    children: tuple[Node, ...] = ()
    leaf: Leaf | None = None

    def nodes(self) -> Iterator[Node]:
        yield self
        for child in self.children:
            yield from child.nodes()

    def leaves(self) -> Iterator[Node]:
        return (n for n in self.nodes() if n.leaf is not None)

    @property
    def needs(self) -> tuple[Need, ...]:
        return tuple(dict.fromkeys(need for n in self.leaves() for need in n.leaf.needs))

    @property
    def cost(self) -> int:
        return self.leaf.cost if self.leaf else max((c.cost for c in self.children), default=COST_CONSTANT)

    @property
    def key(self) -> str:
        """Equal for equal conditions, wherever they stand."""
        return json.dumps(self.condition, sort_keys=True, ensure_ascii=False)


def compile_tree(
    condition: Any, view: PostView, registry: Registry, path: str = "0", built: dict[str, Leaf] | None = None
) -> Node:
    """``built`` collects leaves by their condition, so that equal ones are built once."""
    if not isinstance(condition, dict):
        raise ValueError("Invalid condition structure.")
    built = {} if built is None else built
    for connective in ("and", "or"):
        if connective in condition:
            children = tuple(
                compile_tree(c, view, registry, f"{path}.{i}", built) for i, c in enumerate(condition[connective])
            )
            return Node(condition, path, connective, children)
    node = Node(condition, path)
    if node.key not in built:
        built[node.key] = registry.build(condition, view)
    return Node(condition, path, leaf=built[node.key])


def render(node: Node, leaf_value: Callable[[Node], Predicate] | None = None) -> Predicate:
    """The tree as one predicate, children ordered cheap-first, constants folded.

    Ordering is free to change because leaves are two-valued and have no side effects.
    """
    if node.leaf is not None:
        return leaf_value(node) if leaf_value else node.leaf.predicate
    absorbing = node.connective == "or"
    parts: list[Column] = []
    for child in sorted(node.children, key=lambda c: c.cost):
        value = render(child, leaf_value)
        if isinstance(value, bool):
            if value is absorbing:
                return absorbing
            continue
        parts.append(value)
    if not parts:
        return not absorbing
    return functools.reduce((lambda a, b: a | b) if absorbing else (lambda a, b: a & b), parts)


def render_sql(node: Node, leaf_value: Callable[[Node], str | bool]) -> str | bool:
    """Like :func:`render` over leaves that are named columns, as SQL text.

    A plan for a thousand feeds is thousands of AND/OR nodes; as text they are handed to Spark in a
    few calls instead of one call per node.
    """
    if node.leaf is not None:
        return leaf_value(node)
    absorbing = node.connective == "or"
    parts = []
    for child in sorted(node.children, key=lambda c: c.cost):
        value = render_sql(child, leaf_value)
        if isinstance(value, bool):
            if value is absorbing:
                return absorbing
            continue
        parts.append(value)
    if not parts:
        return not absorbing
    return parts[0] if len(parts) == 1 else "(" + f" {node.connective.upper()} ".join(parts) + ")"


def with_models_as(value: bool) -> Callable[[Node], Predicate]:
    """Leaf values with every model leaf replaced by a constant.

    Trees have no negation above a leaf, so TRUE gives an upper bound of the filter and FALSE a
    lower bound, both free of model scores.
    """
    return lambda n: value if n.leaf.cost == COST_MODEL else n.leaf.predicate


def as_sql(predicate: str | bool) -> str:
    return str(predicate).lower() if isinstance(predicate, bool) else predicate


def as_column(predicate: Predicate) -> Column:
    return F.lit(predicate) if isinstance(predicate, bool) else predicate
