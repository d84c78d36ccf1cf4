import random

from tarnwheel.llm import unigram as u

from .common import documents, empty, odd_texts, words


def plain(word, scores):
    """Viterbi for one pre-token: the best score, then the fewest pieces."""
    worst, best = min(scores.values()), [(0.0, 0)]
    for d in range(1, len(word) + 1):
        c = word[d - 1]
        size = len(c.encode())
        ways = [] if c in scores else [(best[d - 1][0] + size * worst, best[d - 1][1] - size)]
        ways += [(best[d - k][0] + scores[word[d - k : d]], best[d - k][1] - 1) for k in range(1, d + 1) if word[d - k : d] in scores]
        best.append(max(ways))
    return -best[-1][1]


def test_shared_prefixes_score_as_single_words():
    rng = random.Random(4)
    pieces = ["▁", *"abcd", *("".join(rng.choices("abcd▁", k=rng.randint(2, 6))) for _ in range(200))]
    scores = u.zipf(list(dict.fromkeys(pieces)))
    counter = u.Counter(scores)
    some = sorted("▁" + "".join(rng.choices("abcde☃", k=rng.randint(1, 14))) for _ in range(2000))
    assert counter.walk(some) == [plain(w, scores) for w in some]


def test_counts_of_whole_texts(spark):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    scores = u.vocabulary(path)
    texts = [t for t in odd_texts() if len(t or "") < 20_000]
    found = {r.doc_id: (r.n_words, r.n_tokens) for r in u.counted(documents(spark, texts), path).collect()}
    for k, text in enumerate(texts):
        w = words(text)
        assert found[k] == (len(w), sum(plain(u.MARK + x, scores) for x in w if len(x) < 500) + sum(u.Counter(scores).walk([u.MARK + x])[0] for x in w if len(x) >= 500))


def test_a_full_memory_changes_nothing(monkeypatch):
    import numpy as np

    scores = u.zipf(["▁", "a", "b", "ab", "▁a"])
    data = np.frombuffer(b"ab ba abab bb a", np.uint8)
    want = u.Counter(scores).block(data, np.array([0, 7, 15]))
    monkeypatch.setattr(u, "REMEMBERED", 0)
    counter = u.Counter(scores)
    for _ in range(2):
        assert all((a == b).all() for a, b in zip(counter.block(data, np.array([0, 7, 15])), want, strict=True))


def test_empty(spark):
    import public_tokenizers

    assert u.counted(empty(spark), public_tokenizers.path("piece_bpe_32k.model")).collect() == []


def test_scores_of_a_unigram_model_are_used():
    assert u.scored(["a", "b"], [-1.5, -2.25]) == {"a": -1.5, "b": -2.25}
    assert u.scored(["a", "b"], [-0.0, -1.0]) == u.zipf(["a", "b"])


def test_query_against_a_plain_version(spark):
    import public_tokenizers

    scores = u.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    sf, seen = "/root/testdata/sf0.001", {}
    texts = {r.doc_id: words(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for w in {w for found in texts.values() for w in found}:
        seen[w] = plain(u.MARK + w, scores)
    rows = u.op4_token_counts(spark, sf).collect()
    assert len(rows) == len(texts) and all((r.n_words, r.n_tokens) == (len(texts[r.doc_id]), sum(seen[w] for w in texts[r.doc_id])) for r in rows)
