import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tarnwheel.llm import decontaminate, jaccard, mixing, quality

from .common import documents, odd_texts, prose

SF = "/root/testdata/sf0.001"


def test_stages_in_order_and_columns(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "token-ID / binary output"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns


def test_run_matches_a_plain_version(spark):
    """The decisions of each stage by that operator's own result, applied row by row."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    verdict = {r.doc_id: r.kept for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    left = {i: r for i, r in rows.items() if verdict[i]}
    frame = lambda: spark.createDataFrame(list(left.values()), docs.schema)

    def shingles(text):
        w = [x.lower() for x in text.split()]
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}

    sets, root = {i: shingles(r.text) for i, r in left.items()}, {i: i for i in left}
    for a in sorted(left):
        for b in sorted(left):
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and root[a] != root[b]:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {i: new if g == old else g for i, g in root.items()}
    assert {r.doc_id: r.component_id for r in jaccard.self_join(frame()).collect()} == root
    left = {i: r for i, r in left.items() if root[i] == i}

    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = [" ".join(t.text.split()) for t in items.collect()]
    copied = {i for i, r in left.items() if any(t in " ".join(r.text.split()) for t in whole)}
    assert copied <= {r.doc_id for r in decontaminate.matches(frame(), items).collect()}
    dirty = {r.doc_id for r in decontaminate.matches(frame(), items).collect()}
    left = {i: r for i, r in left.items() if i not in dirty}

    copies = {r.doc_id: r.copies for r in mixing.mixed(frame(), odds=mixing.short_odds()).select("doc.doc_id", "copies").collect()}
    library, want, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), [], 0
    for i in sorted(left):
        ids = np.array([*library.encode(left[i].text, add_special_tokens=False).ids, 0], "<u4")
        for _ in range(copies[i]):
            want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
    assert [tuple(r) for r in corpus_pipeline.run(spark, SF).orderBy("start").collect()] == want and want


def test_empty_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_odd_rows_in_every_stage(spark):
    """Nulls in any column, empty and very long texts, ties and repeated rows, clashing column names: stage by stage."""
    rng = random.Random(2)
    texts = [*odd_texts(), *(prose(rng, 80) for _ in range(4))]
    docs = documents(spark, texts)
    nulls = docs.limit(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema.fields))
    docs = docs.unionByName(nulls).unionByName(nulls)
    by_stage = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        by_stage[name] = [(r.doc_id, r.text) for r in out.collect()]
    every = [(r.doc_id, r.text) for r in docs.collect()]
    short = {t for _, t in every if len((t or "").split()) < 50}
    assert not short & {t for _, t in by_stage["quality rules"]}
    near = [t for _, t in by_stage["n-gram Jaccard join"]]
    assert near.count(texts[6]) + sum(near.count(t) for t in texts[8:11]) == 1 and near.count(None) == sum(t is None for _, t in every)
    assert sorted(by_stage["benchmark decontamination"], key=repr) == sorted(every, key=repr)
    assert {t for _, t in by_stage["mixing sources to target weights"]} <= {t for _, t in every}
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(rows) == len(every) and sum(r.n_tokens == 1 for r in rows) == sum(not t for _, t in every)
