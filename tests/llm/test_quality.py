import random
from collections import Counter

import numpy as np

from tarnwheel.llm import quality

from .common import documents, empty, odd_texts, prose, words


def plain(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    counts = Counter(windows)
    covered = {k + j for k, x in enumerate(windows) if counts[x] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_base_counts_match_a_plain_version(spark):
    texts = [*odd_texts(), "a b c a b c a b", "x\nx\n \n\nx y\nx y ", "##|a b& <c>*%$"]
    found = {r.doc_id: r for r in quality.score(documents(spark, texts), None).collect()}
    for k, text in enumerate(texts):
        r, want = found[k], plain(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)  # there is no model


def test_model_tells_held_out_rows_apart(spark):
    rng = random.Random(5)
    good = [prose(rng, rng.randint(60, 200)) for _ in range(160)]
    bad = [" ".join(w + rng.choice(["***", "$$$", "##"]) for w in prose(rng, rng.randint(60, 200)).split()) for _ in range(160)]
    texts = [t for pair in zip(good, bad, strict=True) for t in pair]
    docs = documents(spark, texts, extra=False).distinct()
    labels = docs.selectExpr("doc_id", "cast((doc_id + 1) % 2 as int) as quality").where("doc_id < 200")
    model = quality.fit(docs, labels)
    rows = [r for r in quality.score(docs, model).collect() if r.doc_id >= 200]
    assert np.mean([r.kept == (r.doc_id % 2 == 0) for r in rows]) > 0.95
    assert all(0 <= r.probability <= 1 for r in rows)
    again = {r.doc_id: r.probability for r in quality.score(docs.repartition(5), quality.fit(docs.repartition(7), labels)).collect()}
    assert all(abs(again[r.doc_id] - r.probability) < 1e-6 for r in rows)
    kept = quality.keep(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.score(docs, model).where("kept").collect()}


def test_sample_is_bounded_and_labels_may_be_missing(spark):
    docs = documents(spark, extra=False)
    none = spark.createDataFrame([(1, None), (None, 1), (999, 0)], "doc_id long, quality int")
    assert quality.fit(docs, none) is None
    one = spark.createDataFrame([(k, 1) for k in range(9)], "doc_id long, quality int")
    assert quality.fit(docs, one) is None


def test_repeated_ids_do_not_pass_the_bound(spark, monkeypatch):
    rng = random.Random(1)
    docs = spark.createDataFrame([(k % 2, f"{k} {prose(rng, 20)}", "x") for k in range(400)], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, quality int")
    # the fit runs in a worker, so it is looked at by what it gets
    seen, counted = [], quality._counted
    frame = type(docs)

    def noted(df, function, schema, *more):
        if function is counted:
            seen.append(df.count())
        return plain(df, function, schema, *more)

    plain = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", noted)
    quality.fit(docs, labels, sample=50)
    quality.fit(docs, labels, most_bytes=2000)
    quality.fit(docs.unionByName(docs), labels)
    assert seen[0] == 50 and 5 < seen[1] < 40 and seen[2] == 400


def plain_probability(text, model):
    """The model's verdict text by text, from dictionaries of buckets."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    total = 0.0
    for index, begin in quality.features(quality.Block(data, np.array([0, len(data)]))):
        counts = Counter(index[begin[0] : begin[1]].tolist())
        total += sum(model.weights[k] * n for k, n in counts.items()) / max(1, sum(counts.values()))
    return float(model.probability(np.array([total]))[0])


def test_query_against_a_plain_version(spark):
    """The whole query on a whole table: counts, base rules and verdict, row by row."""
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model, texts = quality.fit(docs, labels), {r.doc_id: r.text for r in docs.collect()}
    rows = quality.op2_quality_rules(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(texts[r.doc_id])
        p = plain_probability(texts[r.doc_id], model)
        assert abs(p - r.probability) < 1e-6
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert abs(p - quality.THRESHOLD) < 1e-6 or r.kept == (not r.base_failed and p >= quality.THRESHOLD)


def test_accuracy_and_calibration_on_labels_that_were_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    half = labels.where("pmod(xxhash64(doc_id), 2) = 0")
    model = quality.fit(docs, half)
    rest = labels.where("pmod(xxhash64(doc_id), 2) = 1")
    rows = quality.score(docs.join(rest.select("doc_id"), "doc_id", "left_semi"), model).join(rest, "doc_id").select("probability", "quality").collect()
    p, y = np.array([r.probability for r in rows]), np.array([r.quality for r in rows])
    bins = np.minimum((p * 10).astype(int), 9)
    error = sum(abs(p[bins == b].mean() - y[bins == b].mean()) * (bins == b).mean() for b in set(bins.tolist()))
    right = ((p >= quality.THRESHOLD) == (y == 1)).mean()
    balanced = np.mean([((p >= quality.THRESHOLD) == (y == 1))[y == k].mean() for k in (0, 1)])
    print(f"held out {len(y)}: accuracy {right:.3f}, balanced {balanced:.3f}, calibration error {error:.3f}")
    assert right > 0.85 and balanced > 0.8 and error < 0.15


def test_empty_table(spark):
    assert quality.score(empty(spark), None).collect() == []
    assert quality.keep(empty(spark), None).columns == empty(spark).columns
