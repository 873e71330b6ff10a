"""Regular-expression and term-list predicates."""

from __future__ import annotations

from postsieve.functions import text
from postsieve.operators.leaf import COST_REGEX, Atoms, Leaf, PostView
from postsieve.session import check_pattern


def regex_matches(view: PostView, path: str, pattern: str, insensitive: bool = True) -> Leaf:
    java = check_pattern(text.search_pattern(pattern, insensitive))
    value = view.shared_path(path)
    return Leaf(lambda: text.matches(value, java, view.missing_text), COST_REGEX)


def regex_negation_matches(view: PostView, path: str, pattern: str, insensitive: bool = True) -> Leaf:
    return regex_matches(view, path, pattern, insensitive).negate()


def regex_any(
    view: PostView, path: str, terms: list[str], insensitive: bool = True, treat_as_regex: bool = False
) -> Leaf:
    java = text.terms_pattern(terms, insensitive, treat_as_regex)
    if treat_as_regex:  # else every character is escaped
        check_pattern(java)
    value = view.shared_path(path)
    words = None if treat_as_regex else text.words_of_terms(terms)
    atoms = None
    if words is not None:

        def read():
            return text.text_of(value, view.missing_text)

        atoms = Atoms(f"words:{path}", lambda: text.folded_words(read()), words, read, java)
    return Leaf(lambda: text.matches(value, java, view.missing_text), COST_REGEX, atoms=atoms)


def regex_none(
    view: PostView, path: str, terms: list[str], insensitive: bool = True, treat_as_regex: bool = False
) -> Leaf:
    return regex_any(view, path, terms, insensitive, treat_as_regex).negate()
