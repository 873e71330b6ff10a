"""Secret scan: candidates by pattern, false positives removed by a random forest.

Columns and Spark ML alone.  A candidate is a long run of characters with a digit, or a very long
one without.  The forest sees its length, its character classes and the turns between them, how
much of its letters are words of the corpus, whether it or its source looks like a path, and the
words around it.  It learns from labelled findings.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postsieve.llm.common import typed, written

RUN = "[A-Za-z0-9+/_=.@:-]"
#: Tried only where a run starts, so that a very long run is read once.
CANDIDATE = f"(?<!{RUN})(?=[A-Za-z+/_=.@:-]*+[0-9]){RUN}{{12,}}|[A-Za-z0-9+/_=-]{{16,}}"
#: Names that secrets are given, and words near things that only look like secrets.
SECRET = "pass(?:word|wd|phrase)?|pwd|token|secret|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key"
SECRET_NAME = f"(?i)(?:{SECRET})$"
#: The value of such a name may hold any characters but these; in an address it ends where the next name begins.
ANY = "(?:(?!&[A-Za-z_]+=)[^\\s\"',;<>])"
#: In a text, and in a word: such a name and a value, which isn't of letters alone.
NAMED = f"(?i)(?:{SECRET})[\"']?\\s*[=:]"
NAMED_VALUE = f"(?i)(?:{SECRET})[\"']?[=:]+[\"']?(?=[A-Za-z]*+[^A-Za-z\\s\"',;<>]){ANY}{{8}}"
#: A whole word after such a name and a colon, if it isn't a run.
WHOLE = f"^[\"']?((?={RUN}*+[^\\s\"',;<>])(?=[A-Za-z]*+[^A-Za-z\\s\"',;<>])[^\\s\"',;<>]{{8,}}+)[\"',;]*$"
#: Name and value, or a run alone; in a word with a candidate every one of them is looked at.  Parts:
#: a name of secrets and its value, any name and its run, a run.
FINDING = (
    rf"(?<!{RUN})(?:[+/=.@:-]*+(?:((?i:[A-Za-z0-9_.-]*?(?:{SECRET})))[\"']?[=:]+[\"']?({ANY}{{8,}}+)"
    rf"|([A-Za-z_][A-Za-z0-9_.-]*+)[\"']?[=:]+[\"']?({RUN}{{8,}}+))|({RUN}{{8,}}+))"
)
INNOCENT = "(?i)^(example|sample|dummy|test|placeholder|version|license|isbn|doi|sha|md5|commit|checksum|hash|uuid)"
PATHLIKE = "(?i)(test|example|sample|doc|mock|fixture)"
#: Words in fewer documents are no dictionary words.
COMMON = 3
#: Values of the hash that samples are drawn by; they are counted in 1024 parts.
SLOTS = 1 << 30
#: Broadcast only so many letter runs; more are joined by a shuffle.
RUNS = 200_000

FEATURES = """length digits uppers lowers turns variety hex dictionary slashes dots at
test_path named assigned quoted innocent before_digit after_digit""".split()


def share(pattern: str, text: Column) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))


def _outer(before: Column, second: Column) -> Column:
    """The name that the words before give to a word."""
    return F.when(before.isin("=", ":", ":="), second).when(before.rlike("[=:]$"), before)


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``pos`` (word number), ``nth`` (in the word), ``name``, ``candidate``, words around, ``quoted``."""
    rows = typed(docs, doc_id="long", source="string", text="string")
    rows = rows.where(F.col("text").rlike(CANDIDATE) | F.col("text").rlike(NAMED))
    rows = rows.withColumn("words", F.split(F.btrim("text", F.lit(" \t\r\n\f\x0b")), r"[ \t\r\n\f\x0b]+"))

    def whole(word: Column, before: Column, second: Column) -> Column:
        """The word as a value of any characters, after a name of secrets; empty if it is none."""
        name = F.regexp_replace(_outer(before, second), "[\"':=]+", "")
        value = F.regexp_extract(word, WHOLE, 1)
        return F.when(F.coalesce(name.rlike(SECRET_NAME), F.lit(False)), value).otherwise("")

    def is_place(i: Column) -> Column:
        word = F.get("words", i)
        value = whole(word, F.coalesce(F.get("words", i - 1), F.lit("")), F.coalesce(F.get("words", i - 2), F.lit("")))
        return word.rlike(CANDIDATE) | word.rlike(NAMED_VALUE) | (value != "")

    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), is_place)
    rows = rows.select("doc_id", "source", "words", F.explode(places).alias("pos"))
    word = F.get("words", F.col("pos"))
    before = F.coalesce(F.get("words", F.col("pos") - 1), F.lit(""))
    rows = rows.select(
        "doc_id",
        "source",
        F.col("pos").cast("long").alias("pos"),
        word.alias("word"),
        before.alias("before"),
        F.coalesce(F.get("words", F.col("pos") - 2), F.lit("")).alias("second"),
        F.coalesce(F.get("words", F.col("pos") + 1), F.lit("")).alias("after"),
    )
    parts = F.arrays_zip(*[
        F.regexp_extract_all("word", F.lit(FINDING), k).alias(f"p{k}") for k in range(1, 6)
    ])
    found = F.transform(parts, lambda m: F.struct(
        F.concat(m["p1"], m["p3"]).alias("own"), F.concat(m["p2"], m["p4"]).alias("value"), m["p5"].alias("bare")
    ))
    found = F.filter(found, lambda m: (m["value"] != "") | m["bare"].rlike(CANDIDATE))
    value = whole(F.col("word"), F.col("before"), F.col("second"))
    one = F.array(F.struct(F.lit("").alias("own"), value.alias("value"), F.lit("").alias("bare")))
    rows = rows.select("*", F.posexplode(F.when(value != "", one).otherwise(found)).alias("nth", "m"))
    outer = _outer(F.col("before"), F.col("second"))
    # The words before name the first finding of a word alone.
    name = F.when(F.col("m.own") != "", F.col("m.own")).when(F.col("nth") == 0, F.coalesce(outer, F.lit(""))).otherwise("")
    bare = F.regexp_extract("m.bare", f"([A-Za-z0-9+/_]{RUN}{{7,}})", 1)
    return rows.select(
        "doc_id",
        "source",
        "pos",
        F.col("nth").cast("long").alias("nth"),
        F.regexp_replace(name, "[\"':=]+", "").alias("name"),
        F.rtrim(F.when(F.col("m.value") != "", F.col("m.value")).otherwise(bare), F.lit(".:-)]}")).alias("candidate"),
        "before",
        "second",
        "after",
        F.col("word").rlike("[\"']").alias("quoted"),
    ).where("candidate <> ''")


def dictionary(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Letter runs of ``found`` (lower case, ``run``) that are words of ``COMMON`` documents or more."""
    runs = found.select(F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit("([a-z]{3,})"), 1)).alias("run")).distinct()
    runs = written(runs, "runs")
    if runs.count() <= RUNS:
        runs = F.broadcast(runs)
    text = typed(docs, text="string").where("text IS NOT NULL")
    words = text.select(F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("run"))
    return words.join(runs, "run", "left_semi").groupBy("run").count().where(F.col("count") >= COMMON).select("run")


def describe(docs: DataFrame) -> DataFrame:
    """Candidates with the columns ``FEATURES``, written once."""
    found = written(candidates(docs), "findings")
    runs = F.regexp_extract_all(F.lower("candidate"), F.lit("([a-z]{3,})"), 1)
    distinct = found.select("candidate").distinct()
    known = distinct.select("candidate", F.explode(runs).alias("run")).join(dictionary(docs, found), "run")
    known = known.groupBy("candidate").agg(F.sum(F.length("run")).alias("known"))
    c = F.col("candidate")
    turns = "(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])"
    values = {
        "length": F.length(c),
        "digits": share("[0-9]", c),
        "uppers": share("[A-Z]", c),
        "lowers": share("[a-z]", c),
        "turns": share(turns, c),
        "variety": F.size(F.array_distinct(F.split(c, ""))) / F.length(c),
        "hex": c.rlike("^[0-9a-f]+$|^[0-9A-F]+$"),
        "dictionary": F.least(F.coalesce(F.col("known"), F.lit(0)) / F.length(c), F.lit(1.0)),
        "slashes": share("/", c),
        "dots": share("[.]", c),
        "at": c.contains("@"),
        "test_path": F.coalesce(F.col("source"), F.lit("")).rlike(PATHLIKE) | c.rlike(f"/.*{PATHLIKE}"),
        "named": F.col("name").rlike(SECRET_NAME),
        "assigned": F.col("name") != "",
        "quoted": F.col("quoted"),
        "innocent": F.col("before").rlike(INNOCENT) | F.col("second").rlike(INNOCENT) | F.col("after").rlike(INNOCENT),
        "before_digit": F.col("before").rlike("[0-9]"),
        "after_digit": F.col("after").rlike("[0-9]"),
    }
    rows = found.join(known, "candidate", "left")
    columns = [values[f].cast("double").alias(f) for f in FEATURES]
    return written(rows.select("doc_id", "pos", "nth", "name", "candidate", *columns), "described")


def train(labelled: DataFrame, sample: int = 4000, trees: int = 30, depth: int = 7) -> RandomForestClassificationModel | None:
    """A forest over ``FEATURES`` and ``label`` (1: secret, 0: not; other rows are not used).

    At most ``sample`` findings of each label, chosen by a hash.  None unless both labels are there.
    """
    known = labelled.where(F.col("label").isin(0, 1)).withColumn("h", F.pmod(F.xxhash64("doc_id", "pos", "nth"), F.lit(SLOTS)))
    # Hashes up to the first that reaches the sample: only those few rows are ranked, however many there are.
    counted = known.groupBy("label", (F.col("h") / (SLOTS // 1024)).cast("int").alias("slot")).count().collect()
    bounds = {0: 0, 1: 0}
    for label in bounds:
        n = 0
        for r in sorted((r for r in counted if r["label"] == label), key=lambda r: r["slot"]):
            if n >= sample:
                break
            n, bounds[label] = n + r["count"], (r["slot"] + 1) * (SLOTS // 1024)
    near = F.col("h") < F.when(F.col("label") == 1, bounds[1]).otherwise(bounds[0])
    order = Window.partitionBy("label").orderBy("h", "doc_id", "pos", "nth", "candidate")
    chosen = known.where(near).withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample)
    chosen = written(chosen.select(F.col("label").cast("double").alias("label"), *FEATURES), "training")
    counts = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    weight = F.when(F.col("label") == 1, 1 / counts[1.0]).otherwise(1 / counts[0.0]) * sum(counts.values())
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(chosen.withColumn("weight", weight))
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, seed=11
    )
    return forest.fit(rows)


def judge(described: DataFrame, forest: RandomForestClassificationModel | None) -> DataFrame:
    """``doc_id``, ``pos``, ``nth``, ``name``, ``candidate``, ``probability`` of every described finding.

    Without a forest nothing is known to be false: ``probability`` is NULL.
    """
    if forest is None:
        return described.select("doc_id", "pos", "nth", "name", "candidate", F.lit(None).cast("double").alias("probability"))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(described)
    chance = vector_to_array("probability")[1]
    return forest.transform(rows).select("doc_id", "pos", "nth", "name", "candidate", chance.alias("probability"))


def weak_labels(described: DataFrame) -> DataFrame:
    """Described findings with ``label`` where the finding's own form settles it, else NULL.

    1: an issuer's fixed form (AKIA and sixteen characters), or a name of secrets before a long run
    with letters and digits.  0: a mail address, numbers and separators alone, letters alone.  The
    tables have no labels of their own; with labels from people, use those.
    """
    c = F.col("candidate")
    real = c.rlike("^AKIA[A-Z0-9]{16}$") | ((F.col("named") == 1) & c.rlike("^[A-Za-z0-9+/_=-]{12,}$") & c.rlike("[0-9]") & c.rlike("[a-z]"))
    false = c.rlike("^[^@]+@[^@]+$") | c.rlike("^[0-9.:/()+-]+$") | c.rlike("^[A-Za-z.]+$")
    return described.withColumn("label", F.when(real, 1).when(false, 0))


def scan(docs: DataFrame, labelled=weak_labels, least: float = 0.5) -> DataFrame:
    """Findings the forest takes for secrets: ``doc_id``, ``pos``, ``nth``, ``name``, ``candidate``, ``probability``.

    ``labelled`` gives described findings a ``label``.  ``pos`` counts the words before, ``nth`` the findings before in the word; a secret
    that stands in several places or repeated rows is reported each time.  NULL and empty texts
    have none; ids may be NULL; an empty table gives no rows.  Without findings of both labels all
    candidates are kept with a NULL probability.  ``doc_id``, ``source`` and ``text`` are read.
    """
    described = describe(docs)
    forest = train(labelled(described))
    return judge(described, forest).where(F.col("probability").isNull() | (F.col("probability") >= least))
