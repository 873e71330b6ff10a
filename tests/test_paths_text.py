import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.functions import text
from postsieve.functions.field import Field, resolve, split_path
from postsieve.plans.match import filter_posts
from tests.posts import ids, posts, view

RECORD = {
    "langs": ["en", "fr"],
    "embed": {"images": [{"alt": "desc1"}, {"alt": "desc2"}, {}, {"alt": None}]},
    "nested": {"key": "value", "grid": [[1, 2], [3]], "$odd": {"it's": 4}},
}


def test_split_path():
    assert split_path("a.b[0].c[*].*") == ["a", "b", "0", "c", "*", "*"]
    assert split_path("a[b.c].d") == ["a", "b.c", "d"]


def strings(values):
    return F.transform(values, lambda v: F.try_variant_get(v, "$", "string"))


def test_paths_on_raw_json(spark):
    df = posts(spark, [RECORD])
    root = view(df).body
    scalar = {
        "langs[0]": "en",
        "langs[9]": None,
        "nested.key": "value",
        "nonexistent.key": None,
        "nested.grid[1][0]": "3",
        "nested.$odd.it's": "4",
        "langs.key": None,
        "nested[0]": None,
    }
    row = df.select(*[F.try_variant_get(resolve(root, p).col, "$", "string").alias(f"c{i}") for i, p in enumerate(scalar)]).first()
    assert list(row) == list(scalar.values())
    many = {
        "embed.images[*].alt": ["desc1", "desc2", None],  # absent ones vanish, nulls stay
        "langs[*]": ["en", "fr"],
        "nested.grid[*][*]": ["1", "2", "3"],
        "nested.key[*]": [],
        "missing[*].x": [],
        "embed.*[0].alt": ["desc1"],
    }
    row = df.select(*[strings(resolve(root, p).col).alias(f"c{i}") for i, p in enumerate(many)]).first()
    assert list(row) == list(many.values())


def test_paths_on_typed_columns(spark):
    schema = T.StructType.fromDDL(
        "langs array<string>, embed struct<images: array<struct<alt: string>>>, m map<string,int>, g array<array<int>>"
    )
    df = spark.createDataFrame([((["en"], ([("a",), (None,)],), {"k": 5}, [[1], [2, 3]]),)], T.StructType([T.StructField("r", schema)]))
    root = Field(F.col("r"), schema)
    paths = ["langs[0]", "langs[3]", "embed.images[*].alt", "m.k", "m.z", "g[*][*]", "m.*", "embed.images[0].alt", "no.such[*]"]
    row = df.select(*[resolve(root, p).col.alias(f"c{i}") for i, p in enumerate(paths)]).first()
    assert list(row) == ["en", None, ["a"], 5, None, [1, 2, 3], [5], "a", []]


TEXTS = [
    {"text": "a visit to obsidian.md today"},
    {"text": "see notobsidian.md5rocks.com"},
    {"text": "theapple"},
    {"text": "an Apple a day"},
    {"text": "hello.world"},
    {"text": "hello+world"},
    {"text": "hello*world"},
    {"text": "apple-pie /apple .apple"},
    {"text": None},
    {},
    {"text": "äapple ÜBER"},
    {"text": "snake_apple apple_x"},
]


@pytest.mark.parametrize(
    "condition, expected",
    [
        ({"regex_any": ["text", ["obsidian.md"]]}, [0]),
        ({"regex_any": ["text", ["apple"]]}, [3]),
        ({"regex_any": ["text", ["hello.world", "hello+world", "hello*world"]]}, [4, 5, 6]),
        ({"regex_any": ["text", ["über"]]}, [10]),
        ({"regex_any": ["text", ["über"], False]}, []),
        ({"regex_any": ["text", ["a.{3}e"], True, True]}, [2, 3, 7, 10, 11]),  # has a dot: no left boundary
        ({"regex_any": ["text", ["ap+le", "vis[i]t"], True, True]}, [0, 3]),
        ({"regex_any": ["text", []]}, list(range(12))),
        ({"regex_none": ["text", ["apple", "none"]]}, [0, 1, 2, 4, 5, 6, 7, 10, 11]),
        ({"regex_matches": ["text", "None"]}, [8, 9]),  # missing text reads "None"
        ({"regex_matches": ["text", "AN apple"]}, [3]),
        ({"regex_matches": ["text", "AN apple", False]}, []),
        ({"regex_matches": ["text", r"(?P<w>an) A(?=pple)"]}, [3]),
        ({"regex_matches": ["text", r"an a(?=pple)"]}, []),  # look-around: always case-sensitive
        ({"regex_negation_matches": ["text", "a"]}, [4, 5, 6, 8, 9]),
        ({"regex_matches": ["text", r"^[[:alpha:]]+$"]}, [2, 8, 9]),
        ({"regex_matches": ["text", r"\bÜBER\b"]}, [10]),
        ({"regex_matches": ["text", "[[+]world"]}, [5]),
    ],
)
def test_text_predicates(spark, condition, expected):
    df = posts(spark, TEXTS)
    assert ids(filter_posts(df, condition, view(df))) == expected


def test_negations_are_complements(spark):
    df = posts(spark, TEXTS)
    for name, other in (("regex_any", "regex_none"), ("regex_matches", "regex_negation_matches")):
        param = ["apple"] if name == "regex_any" else "apple"
        hit = ids(filter_posts(df, {name: ["text", param]}, view(df)))
        rest = ids(filter_posts(df, {other: ["text", param]}, view(df)))
        assert sorted(hit + rest) == list(range(len(TEXTS)))


def test_arrays_are_joined(spark):
    df = posts(spark, [{"tags": ["x", "y"]}, {"tags": []}, {}])
    assert ids(filter_posts(df, {"regex_matches": ["tags", "^x y$"]}, view(df))) == [0]
    assert ids(filter_posts(df, {"regex_matches": ["tags[*]", "^x y$"]}, view(df))) == [0]
    assert ids(filter_posts(df, {"regex_matches": ["tags", "^$"]}, view(df))) == [1]


def test_prefix_tree_equals_alternation():
    words = ["car", "cat", "cart", "dog", "do", "a+b", "a+c", "x"]
    tree = re.compile("^" + text._prefix_tree(set(words)) + "$")
    for candidate in words + ["ca", "carts", "d", "a+", "", "aab"]:
        assert bool(tree.match(candidate)) == (candidate in words)


def test_broken_pattern_fails_while_compiling(spark):
    df = posts(spark, TEXTS)
    with pytest.raises(ValueError, match="Invalid regular expression"):
        filter_posts(df, {"regex_matches": ["text", "(unclosed"]}, view(df))
