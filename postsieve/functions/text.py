"""Regular-expression predicates: pattern translation and the bounded term list."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.functions.field import Field

# The boundary a listed term must have.  Terms which look like a domain or URL have
# no left boundary.  The classes are spelled out because Java's \w also takes combining marks.
LEFT_BOUNDARY = r"(?<![\p{L}\p{N}_\-/.])"
RIGHT_BOUNDARY = r"(?![\p{L}\p{N}_\-])"

# Unicode classes, and only "\n" ends a line.
_BASE_FLAGS = "dU"
_LOOKAROUND = re.compile(r"\(\?(?:=|!|<=|<!|P=)|\\[1-9]")
_TOKEN = re.compile(
    r"(?P<escape>\\.)"
    r"|(?P<group>\(\?P<(?P<name>\w+)>)"
    r"|(?P<backref>\(\?P=(?P<ref>\w+)\))"
    r"|(?P<posix>\[:(?P<neg>\^?)(?P<cls>[a-z]+):\])"
    r"|(?P<quantifier>\{\d+(?:,\d*)?\})"
    r"|(?P<char>.)",
    re.DOTALL,
)
# POSIX class names and their Java spelling.
_POSIX = {
    "alnum": "Alnum", "alpha": "Alpha", "ascii": "ASCII", "blank": "Blank", "cntrl": "Cntrl",
    "digit": "Digit", "graph": "Graph", "lower": "Lower", "print": "Print", "punct": "Punct",
    "space": "Space", "upper": "Upper", "xdigit": "XDigit",
}


def is_domain_like(term: str) -> bool:
    return "." in term or term.startswith("http")


def to_java(pattern: str) -> str:
    """Respell the parts of a Python/RE2 pattern which Java reads differently."""
    names: dict[str, str] = {}
    out: list[str] = []
    in_class = False
    at_class_start = False
    for token in _TOKEN.finditer(pattern):
        text = token.group()
        kind = next(k for k in ("escape", "group", "backref", "posix", "quantifier", "char") if token[k] is not None)
        if kind == "escape":
            out.append(r"\z" if text == r"\Z" else text)
            at_class_start = False
        elif in_class:
            if kind == "posix":
                out.append(rf"\{'P' if token['neg'] else 'p'}{{{_POSIX.get(token['cls'], token['cls'])}}}")
                at_class_start = False
            else:
                for char in text:
                    if char == "]" and not at_class_start:
                        in_class = False
                    out.append("\\" + char if char in "[&" or (char == "]" and at_class_start) else char)
                    at_class_start = at_class_start and char == "^"
        elif kind == "group":
            out.append(f"(?<{names.setdefault(token['name'], f'g{len(names)}')}>")
        elif kind == "backref":
            out.append(rf"\k<{names.get(token['ref'], token['ref'])}>")
        elif kind == "char" and text == "[":
            in_class = at_class_start = True
            out.append(text)
        elif kind == "posix":  # outside a class it is an ordinary class itself
            out.append(text)
        elif kind == "char" and text == "{":
            out.append(r"\{")
        else:
            out.append(text)
    return "".join(out)


def search_pattern(pattern: str, insensitive: bool = True) -> str:
    """A Java pattern for an unanchored search.

    Patterns with look-around or back-references are always case-sensitive.
    """
    case = "iu" if insensitive and not _LOOKAROUND.search(pattern) else ""
    return f"(?{_BASE_FLAGS}{case}){to_java(pattern)}"


def terms_pattern(terms: Iterable[str], insensitive: bool = True, treat_as_regex: bool = False) -> str:
    """One alternation which finds any of ``terms`` as a whole word.

    Literal terms are folded into a prefix tree, so the number of branches tried at a position
    depends on the distinct first letters and not on the length of the list.
    """
    terms = list(terms)
    case = "iu" if insensitive else ""
    if treat_as_regex:
        branches = [
            f"{'' if is_domain_like(t) else LEFT_BOUNDARY}{to_java(t)}{RIGHT_BOUNDARY}" for t in terms
        ]
        return f"(?{_BASE_FLAGS}{case})" + "|".join(branches)
    prefix = f"(?{case})" if case else ""
    words = {t for t in terms if not is_domain_like(t)}
    domains = {t for t in terms if is_domain_like(t)}
    branches = []
    if words:
        branches.append(f"{LEFT_BOUNDARY}{_prefix_tree(words)}{RIGHT_BOUNDARY}")
    if domains:
        branches.append(f"{_prefix_tree(domains)}{RIGHT_BOUNDARY}")
    return prefix + "|".join(branches)


def _prefix_tree(words: set[str]) -> str:
    """``{"car", "cat", "dog"}`` -> ``(?:ca(?:r|t)|dog)``."""
    return "(?:" + "|".join(_branches(sorted(words))) + ")"


def _branches(words: list[str]) -> list[str]:
    out = []
    start = 0
    while start < len(words):
        head = words[start][:1]
        end = start
        while end < len(words) and words[end][:1] == head:
            end += 1
        group = words[start:end]
        if not head:
            out.append("")
        elif len(group) == 1:
            out.append(escape(group[0]))
        else:
            first, last = group[0], group[-1]  # sorted: what these two share, all share
            shared = 0
            while shared < len(first) and first[shared] == last[shared]:
                shared += 1
            tails = _branches([w[shared:] for w in group])
            out.append(f"{escape(head + first[1:shared])}(?:{'|'.join(tails)})")
        start = end
    return out


def escape(text: str) -> str:
    """Escape a literal for Java: every ASCII character but letters, digits and ``_``."""
    return "".join("\\" + c if c.isascii() and not (c.isalnum() or c == "_") else c for c in text)


# Other letters than by case that a pattern without case takes for the same: iota is one with a mark
# that is no letter, so its words have other ends.
_NO_WORD_ENDS = frozenset("\u03b9\u0399\u0345\u1fbe")
_SHARP_S = "\u1e9e"
_FOLDED = {"\u03c2": "\u03c3", "\u0307": ""}


def fold(word: str) -> str:
    """Equal for words which a pattern without case takes for the same (and for some others)."""
    folded = word.upper().replace(_SHARP_S, "SS").lower()
    for old, new in _FOLDED.items():
        folded = folded.replace(old, new)
    return folded


def folded_words(text: Column) -> Column:
    """The distinct words of a text at whose start a listed term may stand, as :func:`fold` has them."""
    words = F.regexp_extract_all(text, F.lit(LEFT_BOUNDARY + r"[\p{L}\p{N}_\-]+"), F.lit(0))

    def folded(word: Column) -> Column:
        # The replacement in between also keeps the optimizer from taking lower(upper(x)) for lower(x).
        out = F.lower(F.replace(F.upper(word), F.lit(_SHARP_S), F.lit("SS")))
        for old, new in _FOLDED.items():
            out = F.replace(out, F.lit(old), F.lit(new))
        return out

    return F.array_distinct(F.transform(words, folded))


def words_of_terms(terms: Iterable[str]) -> tuple[str, ...] | None:
    """One folded word of each term, which every text that has the term has among its
    :func:`folded_words`; None if some term has no such word."""
    words = set()
    for term in terms:
        word = _bounded_word(term)
        if word is None:
            return None
        words.add(fold(word))
    return tuple(sorted(words)) or None


def _bounded_word(term: str) -> str | None:
    """The longest run of word characters of a literal term that begins and ends with its word.

    Characters younger than the oldest tables at hand may be letters in Python and not in Java.
    """
    old = unicodedata.ucd_3_2_0
    if is_domain_like(term) or any(c in _NO_WORD_ENDS or old.category(c) == "Cn" for c in term):
        return None
    inside = "".join(c if c in "_-" or unicodedata.category(c)[0] in "LN" else ("/" if c == "/" else " ") for c in term)
    runs = re.findall(r"(?<![^ ])[^ /]+", inside)
    return max(runs, key=len, default=None)


def text_of(value: Field, missing_text: str = "None") -> Column:
    """What a regular expression is matched against.

    A missing value reads as ``missing_text``; the values of an array are joined with blanks, and
    an empty array reads as ``''``.
    """
    if value.is_missing:
        return F.lit(missing_text)
    if isinstance(value.dtype, T.ArrayType):
        element = value.dtype.elementType
        words = F.transform(value.col, lambda x: text_of(Field(x, element), ""))
        return F.coalesce(F.array_join(words, " "), F.lit(missing_text))
    if isinstance(value.dtype, T.VariantType):
        items = F.try_variant_get(value.col, "$", "array<string>")
        joined = F.array_join(items, " ", "")
        return F.coalesce(joined, F.try_variant_get(value.col, "$", "string"), F.lit(missing_text))
    if isinstance(value.dtype, (T.StructType, T.MapType)):
        return F.coalesce(F.to_json(value.col), F.lit(missing_text))
    return F.coalesce(value.col.cast("string"), F.lit(missing_text))


def matches(value: Field, java_pattern: str, missing_text: str = "None") -> Column:
    """``rlike`` which is FALSE or TRUE; a plain string column is left bare below the null test."""
    if isinstance(value.dtype, T.StringType):
        found = value.col.rlike(java_pattern)
        return F.coalesce(found, F.lit(missing_text).rlike(java_pattern))
    return text_of(value, missing_text).rlike(java_pattern)
