"""The default registry."""

from __future__ import annotations

from postsieve.operators import attributes, authors, entities, models, texts
from postsieve.operators.labels import TEXT_OPERATORS
from postsieve.operators.registry import Registry


def default_registry() -> Registry:
    registry = Registry()
    for build in (
        attributes.attribute_compare,
        attributes.param_compare,
        attributes.post_type,
        attributes.embed_type,
        texts.regex_matches,
        texts.regex_negation_matches,
        texts.regex_any,
        texts.regex_none,
        entities.entity_matches,
        entities.entity_excludes,
        authors.social_graph,
        authors.social_list,
        authors.starter_pack_member,
        authors.list_member,
        authors.magic_audience,
    ):
        registry.register(build.__name__, build)
    for name, text_model in TEXT_OPERATORS.items():
        registry.register(name, models.text_classifier(text_model.model), needs_model=True)
    for build in (
        models.text_arbitrary,
        models.text_similarity,
        models.image_nsfw,
        models.image_arbitrary,
    ):
        registry.register(build.__name__, build, needs_model=True)
    # Counts as a plain operator when a feed's environment is reported, although it reads scores.
    registry.register(models.no_nsfw.__name__, models.no_nsfw)
    return registry


DEFAULT_REGISTRY = default_registry()
