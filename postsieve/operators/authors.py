"""Author-set predicates: is the post's author in a follow collection, list, pack or audience?"""

from __future__ import annotations

from postsieve.functions.keys import asset_key
from postsieve.operators.entities import DID_PREFIX, INLINE_LIMIT
from postsieve.operators.leaf import COST_SCALAR, COST_SET, Atoms, Leaf, PostView, SetNeed
from pyspark.sql import functions as F


def social_graph(view: PostView, actor: str, comparator: str, direction: str) -> Leaf:
    return _asset(comparator, "user_collection", {"actor_handle": actor, "direction": direction})


def social_list(view: PostView, actors: list[str], comparator: str) -> Leaf:
    dids = tuple(sorted({a for a in actors if a.startswith(DID_PREFIX)}))
    handles = tuple(sorted({a for a in actors if not a.startswith(DID_PREFIX)}))
    if not handles and len(dids) <= INLINE_LIMIT:

        def inside():
            return view.did.isNotNull() & view.did.isin(list(dids)) if dids else F.lit(False)

        return _signed(Leaf(inside, COST_SCALAR, atoms=Atoms("did", lambda: F.array(view.did), dids)), comparator)
    return _member(comparator, SetNeed("did", handles=handles, literals=dids))


def starter_pack_member(view: PostView, url: str, comparator: str) -> Leaf:
    return _asset(comparator, "starter_pack", {"starter_pack_url": url})


def list_member(view: PostView, url: str, comparator: str) -> Leaf:
    return _asset(comparator, "user_list", {"list_url": url})


def magic_audience(view: PostView, audience_id: str, comparator: str) -> Leaf:
    return _asset(comparator, "magic_audience", {"audience_id": audience_id})


def _asset(comparator: str, asset_type: str, parameters: dict) -> Leaf:
    return _member(comparator, SetNeed("did", assets=((asset_type, asset_key(asset_type, parameters)),)))


def _member(comparator: str, need: SetNeed) -> Leaf:
    return _signed(Leaf(F.col(need.column), COST_SET, (need,), membership=need), comparator)


def _signed(leaf: Leaf, comparator: str) -> Leaf:
    if comparator in ("in", "=="):
        return leaf
    if comparator in ("not_in", "!="):
        return leaf.negate()
    raise ValueError(f"Unknown comparator '{comparator}'")
