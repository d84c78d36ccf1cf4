import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tarnwheel.llm import pretokens, records
from tarnwheel.session import scratch

from .common import documents, empty

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(texts):
    encoder, out = pretokens.Encoder(PATH), []
    for a, b, ids, begin in encoder.column(pa.array(texts, pa.string())):
        out += [ids[begin[r] : begin[r + 1]].tolist() for r in range(b - a)]
    return out


def test_every_character_and_random_mixes_encode_as_the_library_does():
    library = Tokenizer.from_file(PATH)
    rng = random.Random(1)
    parts = ["'s", "'", "'ll", "'re", "'ve", "'d'm", " ", "  ", "\n", "\t", "a", "Zé", "1", "½", "!", "<", "\xa0", "\x85", "\x1c", "\x00", "t"]
    texts = [f"{chr(c)} a{chr(c)}{chr(c)}1{chr(c)}!{chr(c)}" for c in range(0x300)]
    texts += ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(4000)]
    texts += ["".join(rng.choices([*parts, "日", "<|endoftext|>"], k=rng.randint(0, 12))) for _ in range(500)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(texts) == want
    assert ids_of([None]) == [[]]


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(pretokens, "REMEMBERED", 3)
    texts = ["one two three four", "five six one", "two two"] * 3
    assert ids_of(texts) == [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_files_hold_what_was_encoded(spark):
    docs, library = documents(spark), Tokenizer.from_file(PATH)
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    want, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = [tuple(r) for r in records.encoded(docs).orderBy("start").collect()]
    # rows with equal ids come in the order of a hash of their text
    assert sorted((a, c, d) for a, _, c, d in found) == sorted((a, c, d) for a, _, c, d in want)
    assert [a for a, *_ in found] == [a for a, *_ in want]
    assert [b for _, b, _, _ in found] == np.concatenate([[0], np.cumsum([c for _, _, c, _ in found])[:-1]]).tolist()


def test_index_serves_single_records(spark):
    folder = scratch(spark, "test-records")
    manifest = records.write(documents(spark), folder, PATH).collect()
    for m in manifest:
        every = records.fetch(folder, m.part, list(range(m.records)))
        back = records.fetch(folder, m.part, list(range(m.records))[::-1])
        assert [i for i, _ in every] == [i for i, _ in back[::-1]]
        assert sum(len(x) for _, x in every) == m.ids


def test_damage_is_found(spark, tmp_path):
    data = bytearray(records.frame(records.payload(5, np.arange(10))))
    (tmp_path / "part-000000.rec").write_bytes(data)
    (tmp_path / "part-000000.idx").write_bytes((0).to_bytes(8, "little"))
    assert records.fetch(str(tmp_path), 0, [0])[0][1].tolist() == list(range(10))
    for at in (0, len(data) - 6):
        broken = bytearray(data)
        broken[at] ^= 1
        (tmp_path / "part-000000.rec").write_bytes(broken)
        with pytest.raises(ValueError):
            records.fetch(str(tmp_path), 0, [0])


def test_wide_ids_and_null_ids_survive():
    for doc_id, ids in ((None, [1, 2]), (-3, [70_000, 0]), (2**62, [])):
        got, back = records.parsed(records.payload(doc_id, np.array(ids, np.int64)))
        assert got == doc_id and back.tolist() == ids


def test_empty_and_null_ids(spark):
    assert records.encoded(empty(spark)).collect() == []
    docs = spark.createDataFrame([(None, "b"), (1, "a"), (None, None)], "doc_id long, text string")
    assert [r.doc_id for r in records.encoded(docs).orderBy("start").collect()] == [None, None, 1]
