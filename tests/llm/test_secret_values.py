"""Values of secrets with any characters, and samples that don't rank all findings."""

import pytest
from pyspark.sql import functions as F

from postsieve.llm import secret_scan

CASES = [
    ("password: Tr0ub4dor&3x!y#z9", [("password", "Tr0ub4dor&3x!y#z9")]),
    ('{"user":"al","password":"p@ss!w0rd$long"}', [("password", "p@ss!w0rd$long")]),
    ('"DB_PASSWORD" : "a%b^c&d*1",', [("DB_PASSWORD", "a%b^c&d*1")]),
    ("https://x.org/?token=ab!cd12345&user=someone", [("https", "//x.org/"), ("token", "ab!cd12345")]),
    ("(api_key=k#1k#2k#3k#4)", [("api_key", "k#1k#2k#3k#4")]),
    ("password: required", []),
    ("the password is: unknown!", []),
    ("password: short!1", []),
    ("A token: yes", []),
    ("colour: Tr0ub4dor&3x!y#z9", []),
]


def test_values_of_any_characters(spark):
    rows = [(k, text, "s") for k, (text, _) in enumerate(CASES)]
    found = {}
    for r in secret_scan.candidates(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        found.setdefault(r["doc_id"], []).append((r["name"], r["candidate"]))
    assert {k: found.get(k, []) for k in range(len(CASES))} == {k: expected for k, (_, expected) in enumerate(CASES)}


@pytest.mark.parametrize("copies", [1, 5000])
def test_the_sample_is_bounded_and_whole(spark, monkeypatch, copies):
    """With more findings than the sample its bound holds, also for one finding many times; with fewer all are used."""
    taken = []
    original = secret_scan.written

    def spy(rows, name):
        result = original(rows, name)
        if name == "training":
            taken.append({r["label"]: r["count"] for r in result.groupBy("label").count().collect()})
        return result

    monkeypatch.setattr(secret_scan, "written", spy)
    features = [(F.col("id") % (k + 2)).cast("double").alias(f) for k, f in enumerate(secret_scan.FEATURES)]
    ids = F.col("id") if copies == 1 else (F.col("id") / copies).cast("long")
    rows = spark.range(20_000).select(
        ids.alias("doc_id"), F.lit(0).alias("pos"), F.lit(0).alias("nth"), F.lit("c").alias("candidate"),
        F.when(F.col("id") < 50, 1).when(F.col("id") > 60, 0).alias("label"), *features,
    )
    assert secret_scan.train(rows, sample=300, trees=2, depth=2) is not None
    assert taken == [{0.0: 300, 1.0: 50}]
