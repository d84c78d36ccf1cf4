"""Token counts under a unigram vocabulary, by dynamic programming over a trie of distinct pre-tokens.

A pre-token is a word [^\\x20\\x09-\\x0D]+ behind the word mark. Its best segmentation maximises the sum of its pieces'
log-probabilities (then has the fewest pieces). The forward score of a prefix depends on that prefix alone, so the
distinct pre-tokens of a block are put in a trie and each trie node is scored once, whatever number of pre-tokens pass
through it; a terminal node's number of pieces is stored under the pre-token's hash and looked up from then on.
The trie is walked in sorted order, depth first, and only the path to the current node is held.

A unigram model's own scores are used where the file has them. The scores of a byte-pair model are its pieces' ranks
and no probabilities; then by Zipf's law a piece of rank r has one in proportion to 1 / (r + 1), so that the counts are
those of a unigram model over that vocabulary and not those of the tokenizer that the file is for. A character that is
no piece is spelled by its UTF-8 bytes, each of the least probability.

Defined results: a null or empty text has no words and no tokens; repeated rows are counted each; an empty table gives
no rows; other columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwheel.llm.textarrays import Block, blocks, owners

MARK = "▁"
#: Distinct pre-tokens whose counts a worker remembers before it starts anew (12 bytes each).
REMEMBERED = 4_000_000


def zipf(pieces: list[str]) -> dict[str, float]:
    """Log-probabilities of pieces in order of rank."""
    total = math.log(sum(1 / (r + 1) for r in range(len(pieces))))
    return {p: -math.log(r + 1) - total for r, p in reversed(list(enumerate(pieces)))}


def vocabulary(path: str) -> dict[str, float]:
    """The pieces of a sentencepiece model, without its control, unknown and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    some = [k for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))]
    return scored([model.id_to_piece(k) for k in some], [model.get_score(k) for k in some])


def scored(pieces: list[str], scores: list[float]) -> dict[str, float]:
    """Log-probabilities from a model's scores, which are ranks if all are whole numbers."""
    if all(s == int(s) for s in scores):
        return zipf(pieces)
    return dict(zip(reversed(pieces), reversed(scores), strict=True))


class Counter:
    """Pieces in the best segmentation of pre-tokens."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.worst = min(scores.values(), default=0.0)
        # a piece is looked up only behind its last two characters, and in the lengths that occur there
        lengths: dict[str, set[int]] = {}
        for p in scores:
            lengths.setdefault(p[-2:], set()).add(len(p))
        self.lengths = {k: tuple(sorted(v)) for k, v in lengths.items()}
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def walk(self, words: list[str]) -> list[int]:
        """The number of pieces of each word; words sorted, so shared prefixes are neighbours."""
        best, pieces, before, out = [0.0], [0], "", []
        scores, lengths, worst = self.scores, self.lengths, self.worst
        for word in words:
            shared, end = 0, min(len(word), len(before))
            while shared < end and word[shared] == before[shared]:
                shared += 1
            del best[shared + 1 :], pieces[shared + 1 :]
            for d in range(shared + 1, len(word) + 1):
                last = word[d - 1]
                if last in scores:
                    top, n = best[d - 1] + scores[last], pieces[d - 1] + 1
                else:
                    size = len(last.encode())
                    top, n = best[d - 1] + size * worst, pieces[d - 1] + size
                if d > 1:
                    for k in lengths.get(word[d - 2 : d], ()):
                        if k > d:
                            break
                        piece = scores.get(word[d - k : d])
                        if piece is not None:
                            score = best[d - k] + piece
                            if score > top or (score == top and pieces[d - k] + 1 < n):
                                top, n = score, pieces[d - k] + 1
                best.append(top)
                pieces.append(n)
            out.append(pieces[-1])
            before = word
        return out

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words and tokens of each text of a block."""
        block = Block(data, offsets)
        starts, ends, firsts = block.words()
        keys, one, each = np.unique(block.hashes(starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self.keys, self.counts = self.keys[:0], self.counts[:0]
        where = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = where < len(self.keys)
        new[inside] = self.keys[where[inside]] != keys[inside]
        if new.any():
            raw = data.tobytes()
            words = [MARK + raw[a:b].decode() for a, b in zip(starts[one[new]].tolist(), ends[one[new]].tolist(), strict=True)]
            order = sorted(range(len(words)), key=words.__getitem__)
            found = np.zeros(len(words), np.int32)
            found[order] = self.walk([words[k] for k in order])
            self.keys, self.counts = np.insert(self.keys, where[new], keys[new]), np.insert(self.counts, where[new], found)
            where = np.searchsorted(self.keys, keys)
        tokens = self.counts[where][each] if len(keys) else np.zeros(0, np.int32)
        return np.diff(firsts), np.bincount(owners(firsts), tokens, len(offsets) - 1).astype(np.int64)


@cache
def counter(path: str) -> Counter:
    """One counter for each worker process."""
    return Counter(vocabulary(path))


def counted(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id, n_words and n_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, tokens = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for a, b, data, offsets in blocks(batch.column(1)):
                words[a:b], tokens[a:b] = counter(path).block(data, offsets)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), pa.array(tokens)], [id_col, "n_words", "n_tokens"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return counted(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
