"""Classes of rows with the same text: digests first, the bytes themselves for those that share one.

1. Rows are counted by a 64-bit digest, summed where they are; a digest that is found once is a class.
2. The texts of the others are grouped by digest and text, again summed where they are, so a hot text leaves a task once.
   That compares bytes: two texts that share a digest are two classes.
3. Rows get their class by digest alone where a digest has one text, and by the text too where it has more.

Defined results: a null text is an empty one; a class is named after its least id, null ids last; repeated rows and equal
ids count each; texts are compared whole, of any length; an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwheel.session import Held

#: Bytes of a side that is broadcast.
MOST_BYTES = 16 << 20


def _small(df: DataFrame, size: int) -> DataFrame:
    most = MOST_BYTES // size
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def exact_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Column | None = None) -> DataFrame:
    """Each row's id, class_id and n_class, the rows of its class. digest: of text_col, in place of xxhash64."""
    held = Held(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("digest", F.xxhash64("text") if digest is None else digest)
    several = held(rows.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"), "digests")
    shared = rows.join(_small(several, 16), "digest")
    least = F.min(F.struct(F.col("id").isNull().alias("no"), "id")).alias("least")
    classes = shared.groupBy("digest", "text").agg(F.count("*").alias("n"), least)
    classes = held(classes.select("digest", "text", "n", F.col("least.id").alias("class_id")), "texts")
    texts = classes.groupBy("digest").agg(F.count("*").alias("texts"), F.first("class_id").alias("class_id"), F.first("n").alias("n_class"))
    texts = held(texts, "classes")
    plain = rows.select("id", "digest").join(_small(texts, 40), "digest", "left").where("texts is null or texts = 1")
    plain = plain.select("id", F.when(F.col("texts").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_class", F.lit(1).cast("long")).alias("n_class"))
    torn = texts.where("texts > 1").select("digest")
    both = shared.join(torn, "digest", "left_semi").join(classes.join(torn, "digest", "left_semi"), ["digest", "text"])
    out = plain.union(both.select("id", "class_id", F.col("n").alias("n_class"))).toDF(id_col, "class_id", "n_class")
    held.release(out)
    return out
