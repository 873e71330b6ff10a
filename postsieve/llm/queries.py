"""The corpus queries over the test tables."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import functions as F

from postsieve.llm import html_text, secret_scan
from postsieve.llm.common import QUERIES, ORACLES, corpus_query, read_table, shared_folder
from postsieve.llm.decontamination import contaminated
from postsieve.llm.embedding_links import link_vectors
from postsieve.llm.html_text import main_text
from postsieve.llm.improbable import Digester, likeness, rarity
from postsieve.llm.in_order import in_order
from postsieve.llm.language import identify, train
from postsieve.llm.line_spread import remove_boilerplate
from postsieve.llm.mixing import mix
from postsieve.llm.periodic_runs import periodic_runs
from postsieve.llm.phrases import mine_phrases
from postsieve.llm.simhash import near_duplicates
from postsieve.llm.substrings import remove_repeats
from postsieve.llm.token_files import read_token_files, write_token_files

__all__ = ["QUERIES", "ORACLES"]


@corpus_query("op1_token_files")
def op1_token_files(spark, folder):
    import public_tokenizers

    target = shared_folder(spark, "tokens")
    docs = read_table(spark, folder, "documents")
    write_token_files(docs, target, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, target)


@corpus_query("op9_simhash")
def op9_simhash(spark, folder):
    return near_duplicates(read_table(spark, folder, "documents"), radius=4, width=4, seed=42)


@corpus_query("op6_language")
def op6_language(spark, folder):
    docs = read_table(spark, folder, "documents")
    return identify(docs, train(docs))


@corpus_query("op2_decontaminate")
def op2_decontaminate(spark, folder):
    return contaminated(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


MIX_SQL = """
WITH sizes AS (
  SELECT source, sum(coalesce(length(text), 0) + 1)::BIGINT AS chars FROM documents GROUP BY source
), rated AS (
  SELECT source, (SELECT sum(chars) FROM sizes)::BIGINT
         * (1.0::DOUBLE / (SELECT count(*) FROM sizes)) / chars AS rate FROM sizes
), parted AS (
  SELECT source, rate, greatest(ceil(rate / 8), 1)::BIGINT AS parts FROM rated
), terms AS (
  SELECT source, k, sum(exp(k * ln(rate / parts) - rate / parts - lgamma(k + 1)))
         OVER (PARTITION BY source ORDER BY k) AS upto
  FROM parted, (SELECT unnest(range(0, 64)) AS k)
), numbers AS (
  SELECT d.doc_id, d.source, part,
         ('0x' || substr(md5('17:' || coalesce(d.doc_id::VARCHAR, '') || ':' || part), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM documents d JOIN parted p ON d.source IS NOT DISTINCT FROM p.source, unnest(range(1, parts + 1)) AS r(part)
), counted AS (
  SELECT n.doc_id, n.source, count(t.k) AS copies
  FROM numbers n JOIN terms t ON n.source IS NOT DISTINCT FROM t.source AND t.upto <= n.u
  GROUP BY n.doc_id, n.source
)
SELECT d.doc_id, d.source, copy, copies, length(d.text) AS n_chars, md5(d.text) AS text_md5,
       md5('17:place:' || coalesce(d.doc_id::VARCHAR, '') || ':' || copy) AS place
FROM documents d
JOIN counted c ON c.doc_id IS NOT DISTINCT FROM d.doc_id AND c.source IS NOT DISTINCT FROM d.source,
     unnest(range(1, copies + 1)) AS r(copy)
"""


@corpus_query("op10_mix", MIX_SQL)
def op10_mix(spark, folder):
    rows = mix(read_table(spark, folder, "documents"), seed=17)
    return rows.select(
        "doc.doc_id", "doc.source", "copy", "copies",
        F.length("doc.text").cast("long").alias("n_chars"), F.md5(F.col("doc.text").cast("binary")).alias("text_md5"), "place",
    )


@corpus_query("op3_substrings")
def op3_substrings(spark, folder):
    rows = remove_repeats(read_table(spark, folder, "documents"), width=13)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    sha = F.sha2(F.col("kept").cast("binary"), 256)
    return rows.select("doc_id", "n_words", removed.alias("n_removed"), sha.alias("kept_sha256"))


LINES_SQL = """
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS whole,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), keyed AS (
  SELECT doc_id, source, pos, whole, trim(whole, ' ' || chr(9) || chr(13)) AS line FROM lines
), common AS (
  SELECT line FROM keyed WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 5
)
SELECT doc_id, any_value(source) AS source, count(*) AS n_lines,
       count(*) FILTER (line IN (SELECT line FROM common)) AS n_removed,
       md5(coalesce(string_agg(whole, chr(10) ORDER BY pos) FILTER (line NOT IN (SELECT line FROM common)), '')) AS kept_md5
FROM keyed GROUP BY doc_id
"""


@corpus_query("op8_lines", LINES_SQL)
def op8_lines(spark, folder):
    rows = remove_boilerplate(read_table(spark, folder, "documents"), sites=5)
    removed, kept = F.size("removed").cast("long"), F.md5(F.col("text").cast("binary"))
    return rows.select("doc_id", "source", "n_lines", removed.alias("n_removed"), kept.alias("kept_md5"))


@corpus_query("op4_embedding_links")
def op4_embedding_links(spark, folder):
    return link_vectors(read_table(spark, folder, "embeddings"), least=0.95)


@corpus_query("op7_html")
def op7_html(spark, folder):
    pages = read_table(spark, folder, "pages")
    rows = main_text(pages, html_text.train(pages))
    return rows.withColumn("n_chars", F.length("text").cast("long"))


@corpus_query("op5_secrets")
def op5_secrets(spark, folder):
    rows = secret_scan.scan(read_table(spark, folder, "documents"))
    return rows.select(
        "doc_id", "pos", "nth", "name", F.length("candidate").cast("long").alias("n_chars"),
        F.sha2(F.col("candidate").cast("binary"), 256).alias("secret_sha256"), "probability",
    )


def looped(docs):
    """``doc_id`` and ``text``, where the end of every tenth document repeats a stretch of its words.

    Rows without an id, and texts without words, stay as they are.
    """
    split = F.expr(r"filter(split(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), x -> x <> '')")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, split).alias("words"))
    rows = rows.withColumn("n", F.nullif(F.size("words"), F.lit(0)).cast("long"))
    rows = rows.withColumn("a", F.col("g") % F.col("n"))
    rows = rows.withColumn("p", F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)) + 1)
    turned = F.expr("transform(words, (w, i) -> if(i < a, w, words[cast(a + (i - a) % p as int)]))")
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))


@corpus_query("op12_runs")
def op12_runs(spark, folder):
    found = periodic_runs(looped(read_table(spark, folder, "documents")), least=24, times=3)
    listed = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    lines = F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    # Of equal exponents the smallest start, then period, comes first, as in the list itself.
    more = F.expr("reduce(slice(runs, 2, size(runs)), runs[0], (b, r) -> if(r.length * b.period > b.length * r.period, r, b))")
    best = F.when(F.size("runs") > 0, more)
    return found.withColumn("best", best).select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


PHRASES_SQL = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, words FROM (
    SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS words FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents)) WHERE len(words) > 0
), placed AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces
), grams AS (
  SELECT lang, array_to_string(words[i:i + k - 1], ' ') AS phrase, k
  FROM placed, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(words)
), counted AS (
  SELECT lang, phrase, any_value(k) AS k, count(*) AS f FROM grams GROUP BY lang, phrase
), cuts AS (
  SELECT c.lang, c.phrase, c.k, c.f, j,
         array_to_string(string_split(c.phrase, ' ')[1:j], ' ') AS front, array_to_string(string_split(c.phrase, ' ')[j + 1:], ' ') AS back
  FROM counted c, (SELECT unnest([1, 2]) AS j) WHERE c.k >= 2 AND c.f >= 10 AND j < c.k
), scored AS (
  SELECT x.lang, x.phrase, x.k, x.f AS a, j, p.f AS l, q.f AS r, (1000000::HUGEINT * x.f * x.f) // (p.f::HUGEINT * q.f) AS score
  FROM cuts x JOIN counted p ON p.lang = x.lang AND p.phrase = x.front JOIN counted q ON q.lang = x.lang AND q.phrase = x.back
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS nth FROM scored
), candidates AS (SELECT * FROM lowest WHERE nth = 1
), parts AS (
  SELECT lang, array_to_string(string_split(phrase, ' ')[half:half + 1], ' ') AS phrase, max(a) AS around
  FROM candidates, (SELECT unnest([1, 2]) AS half) WHERE k = 3 GROUP BY 1, 2
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN parts p ON c.k = 2 AND p.lang = c.lang AND p.phrase = c.phrase
  WHERE p.around IS NULL OR 100::HUGEINT * p.around < 50::HUGEINT * c.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@corpus_query("op13_phrases", PHRASES_SQL)
def op13_phrases(spark, folder):
    rows = mine_phrases(read_table(spark, folder, "documents"), longest=3, least=10, inside=50, count=2000)
    return rows.select("lang", "rank", F.col("words").cast("string").alias("phrase"), "a", "l", "r", "n", "score")


#: Windows (bytes, about) of a range of documents, and bytes fingerprinted together.
RANGE, GROUP = 16_000_000, 1_000_000


@corpus_query("op11_fingerprints")
def op11_fingerprints(spark, folder):
    docs = read_table(spark, folder, "documents")
    ranks, windows = rarity(docs)

    def run(rows):
        digester, held, size, first = Digester(ranks), [], 0, None

        def answers():
            """The held rows but the last, which is the others' successor alone."""
            texts = [text.encode("utf-8", "surrogatepass") for _, text, _ in held]
            edited = []
            for (_, text, _), (_, after, _) in zip(held, held[1:]):
                gone = len(text) // 4
                edited.append((text[: len(text) - gone] + after[:gone]).encode("utf-8", "surrogatepass"))
            own = digester.fingerprints(texts if first is None else texts[1:])
            own = own if first is None else [first, *own]
            other = digester.fingerprints(edited)
            columns = {
                "doc_id": pa.array([key for key, _, _ in held[:-1]], pa.int64()),
                "n_chars": pa.array([len(text) for _, text, _ in held[:-1]], pa.int64()),
                "edited_sha256": [hashlib.sha256(text).hexdigest() for text in edited],
                "fingerprint": own[:-1],
                "edited_fingerprint": other,
                "near_edited": [likeness(a, b) for a, b in zip(own, other)],
                "near_next": [likeness(a, b) for a, b in zip(own, own[1:])],
            }
            return pa.RecordBatch.from_pydict(columns), own[-1]

        for row in rows:
            held.append(row)
            size += len(row[1])
            if len(held) > 1 and (size > GROUP or row[2]):
                batch, first = answers()
                yield batch
                held, size = held[-1:], len(row[1])

    kind = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    ranges = max(spark.sparkContext.defaultParallelism, -(-windows // RANGE))
    return in_order(docs, ranges, run, kind)
