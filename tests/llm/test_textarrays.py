"""Hashes that must not collide by construction, and what depends on them."""

import numpy as np
import pytest

from tarnwheel.llm import jaccard, pretokens, quality, records, unigram
from tarnwheel.llm.textarrays import Block, range_hashes


def regular(size):
    """The two Thue-Morse words of a size, over a and b: polynomials modulo 2**64 can't tell them apart."""
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(size))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("size", [1024, 2048])
def test_regular_words_have_hashes_of_their_own(size):
    one, two = regular(size)
    data = np.frombuffer(f"{one} {two} {one}".encode(), np.uint8)
    block = Block(data, np.array([0, len(data)]))
    a, b, c = block.hashes(*block.words()[:2])
    assert a == c != b


def test_long_ranges_and_many_ranges_hash_alike():
    values = np.random.default_rng(1).integers(0, 256, 1_500_000).astype(np.uint8)
    starts, ends = np.array([0, 5, 5, 700_000, 10]), np.array([1_500_000, 9, 5, 1_400_000, 1_500_000])
    together = range_hashes(values, starts, ends)
    for k in range(len(starts)):
        piece = values[starts[k] : ends[k]]
        assert range_hashes(piece, np.array([0]), np.array([len(piece)]))[0] == together[k]
    assert len(set(together.tolist())) == len(starts)


@pytest.mark.parametrize("size", [1024, 2048])
def test_regular_words_in_operators(spark, size):
    import public_tokenizers
    from tokenizers import Tokenizer

    one, two = regular(size)
    docs = spark.createDataFrame([(1, one), (2, two), (3, f"{one} x y z"), (4, f"{two} x y z"), (5, f"{one}\n{two}")], "doc_id long, text string").coalesce(1)
    # quality: the two lines of document 5 are no repeats
    block = Block(np.frombuffer(f"{one}\n{two}".encode(), np.uint8), np.array([0, 2 * size + 1]))
    assert quality.base_counts(block)["n_dup_lines"].tolist() == [0]
    # tokens
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, library = pretokens.Encoder(path), Tokenizer.from_file(path)
    for text in (one, two):
        data = np.frombuffer(text.encode(), np.uint8)
        assert encoder.block(data, np.array([0, len(data)]))[0].tolist() == library.encode(text, add_special_tokens=False).ids
    got = {r.doc_id: r.n_tokens for r in records.encoded(docs).collect()}
    assert all(got[k] == len(library.encode(t, add_special_tokens=False).ids) + 1 for k, t in ((1, one), (2, two)))
    scores = {"▁a": -1.0, "▁ab": -1.5, "a": -2.0, "b": -3.0, "ab": -4.5, "ba": -4.0, "abba": -7.0}
    together, alone = unigram.Counter(scores), [unigram.Counter(scores).walk([unigram.MARK + t])[0] for t in (one, two)]
    data = np.frombuffer(f"{one} {two}".encode(), np.uint8)
    assert together.block(data, np.array([0, size, len(data)]))[1].tolist() == alone
    # near copies
    groups = {r.doc_id: r.component_id for r in jaccard.self_join(docs, shingle=3).collect()}
    assert groups == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5}
