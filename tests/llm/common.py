"""Small tables with the odd cases, and plain versions of what operators share."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
# clashing names: columns that operators use inside
EXTRA = "row string, h int, n long, key string, gid int, start int, size int, doc string, at int"


def words(text):
    return WORD.findall(text or "")


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdeéß", k=rng.randint(1, 7))) for _ in range(n))


def odd_texts(seed=3):
    """Nulls, empty and very long texts, white space alone, repeated rows, copies, near copies, shared passages."""
    rng = random.Random(seed)
    base, passage = prose(rng, 120).split(), prose(rng, 60)
    near = [" ".join(base[:k] + ["zz"] + base[k + 1 :]) for k in (0, 60, 119)]
    texts = [None, "", " \n\t ", "one", "One two", "a b c", " ".join(base), " ".join(base), *near, prose(rng, 30_000)]
    texts += [prose(rng, rng.randint(5, 80)) + "\n" + passage + "\n" + prose(rng, rng.randint(5, 80)) for _ in range(4)]
    texts += ["spam spam " * 80, "日本語 テキスト ☃ " * 30, "x" * 5000, passage]
    return texts


def documents(spark, texts=None, extra=True):
    texts = odd_texts() if texts is None else texts
    rows = [(k, t, f"s{k % 3}" if k % 5 else None, "x", 1, 2, "k", 3, 4, 5, "d", 6) for k, t in enumerate(texts)]
    rows.append(rows[-1])  # a repeated row
    df = spark.createDataFrame(rows, f"doc_id long, text string, source string, {EXTRA}")
    return df if extra else df.select("doc_id", "text", "source")


def empty(spark):
    return spark.createDataFrame([], f"doc_id long, text string, source string, {EXTRA}")


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
