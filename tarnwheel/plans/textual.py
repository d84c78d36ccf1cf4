"""Registered queries on texts and vectors: near-duplicate classes, personal data, languages, an index of vectors.

Where SQL can say it there is DuckDB text; the others are held against brute force in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwheel.functions import language, personal
from tarnwheel.operators import minhash, vectorindex
from tarnwheel.plans.registry import built
from tarnwheel.session import ship
from tarnwheel.sources.tables import table


@built(None)
def q_minhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's class of near duplicates (five words, 0.8), the class's rows and the document's links."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: What a match has to hold, as DuckDB conditions on `found`.
_CHECKS = {
    "ipv4": "list_max(list_transform(string_split(found, '.'), lambda x: x::INT)) < 256",
    "card": """list_sum(list_transform(range(1, len(regexp_extract_all(found, '[0-9]')) + 1), lambda i: CASE WHEN i % 2 = 1 THEN list_reverse(regexp_extract_all(found, '[0-9]'))[i]::INT
        WHEN list_reverse(regexp_extract_all(found, '[0-9]'))[i]::INT > 4 THEN 2 * list_reverse(regexp_extract_all(found, '[0-9]'))[i]::INT - 9 ELSE 2 * list_reverse(regexp_extract_all(found, '[0-9]'))[i]::INT END)) % 10 = 0""",
    "iban": """list_reduce(list_prepend(0, list_transform(string_split(substr(replace(found, ' ', ''), 5) || left(replace(found, ' ', ''), 4), ''), lambda c: CASE WHEN c <= '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)),
        lambda a, v: (a * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1""",
    "named_secret": """list_sum(list_transform(list_distinct(string_split(regexp_extract_all(found, '[A-Za-z0-9+/_=-]{16,}')[-1], '')), lambda x:
        -(len(list_filter(string_split(regexp_extract_all(found, '[A-Za-z0-9+/_=-]{16,}')[-1], ''), lambda y: y = x)) / length(regexp_extract_all(found, '[A-Za-z0-9+/_=-]{16,}')[-1])::DOUBLE)
        * log2(len(list_filter(string_split(regexp_extract_all(found, '[A-Za-z0-9+/_=-]{16,}')[-1], ''), lambda y: y = x)) / length(regexp_extract_all(found, '[A-Za-z0-9+/_=-]{16,}')[-1])::DOUBLE))) >= 3.0""",
}


def _kind(kind: str, pattern: str) -> str:
    p = pattern.replace("'", "''")
    return f"""SELECT doc_id, '{kind}' AS kind, start::INT AS start, (start + length(found))::INT AS stop, found FROM (
    SELECT doc_id, m[i] AS found, list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start FROM (
        SELECT doc_id, m, s, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{p}') AS m, string_split_regex(text, '{p}') AS s FROM documents WHERE regexp_matches(text, '{p}')))) WHERE {_CHECKS.get(kind, "true")}"""


@built("\nUNION ALL\n".join(_kind(kind, pattern) for kind, _, pattern, _ in personal.KINDS))
def q_personal_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data and secrets in all documents."""
    ship(spark)
    return personal.personal_spans(table(spark, sf_dir, "documents"))


@built(None)
def q_language_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language found for each document beside the given one, by a model of half of the table, and its lines that disagree."""
    ship(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    model = language.fit(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0))
    found = language.languages(docs, model, ["doc_id", "lang"])
    other = F.transform(F.filter("paragraphs", lambda p: ~p["found"].eqNullSafe(F.col("lang"))), lambda p: p["line"])
    return found.select("doc_id", "lang", "found", F.col("found").eqNullSafe(F.col("lang")).alias("agrees"), "n_paragraphs", F.size(other).alias("n_other"), other.alias("other_lines"))


@built(None)
def q_vector_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten vectors nearest to each whose id is divisible by 20, by the index; `q_nearest_vectors` has them by comparing all."""
    ship(spark)
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = vectorindex.nearest(vectors, vectors.where("vec_id % 20 = 0"), 10)
    return found.select("asked", "vec_id", F.round("similarity", 6).alias("similarity"))
