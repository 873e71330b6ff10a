"""Rule-based content feeds on Spark: filters as columns, sets as joins, history as windows."""

from postsieve.operators.builtin import DEFAULT_REGISTRY, default_registry
from postsieve.operators.leaf import Leaf, PostView
from postsieve.operators.registry import Registry
from postsieve.plans.attach import Catalog
from postsieve.plans.audit import audit_nodes, audit_trees
from postsieve.plans.match import compile_feeds, filter_posts, match_feeds, project_matches
from postsieve.sources.scores import Scorer

__all__ = [
    "Catalog",
    "DEFAULT_REGISTRY",
    "Leaf",
    "PostView",
    "Registry",
    "Scorer",
    "audit_nodes",
    "audit_trees",
    "compile_feeds",
    "default_registry",
    "filter_posts",
    "match_feeds",
    "project_matches",
]
