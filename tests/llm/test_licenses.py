import random

from tarnwheel.llm import licenses

from .common import documents, empty, prose


def test_every_wording_is_found_in_prose():
    rng = random.Random(6)
    for name, texts in licenses.WORDINGS.items():
        for text in texts:
            page = prose(rng, 40) + "\n" + text + "\n" + prose(rng, 40)
            found = licenses.scan(page)
            assert name in {r[2] for r in found}, (name, text, found)
            assert all(r[0] == 1 for r in found if r[2] == name)


def test_broken_lines_and_small_changes():
    text = licenses.WORDINGS["MIT"][4]
    words = text.split()
    lines = [" ".join(words[k : k + 11]) for k in range(0, len(words), 11)]
    broken = text.replace(", ", ",\n").replace("furnished", "given")
    for page in ("\n".join(lines), broken):
        assert "MIT" in {r[2] for r in licenses.scan("x\n" + page + "\ny")}, page
    (row,) = licenses.scan(broken)
    assert row[5] == "furnished" and row[6] == "given"


def test_telling_words_decide():
    assert {r[2] for r in licenses.scan("Licensed under CC BY-NC 4.0.")} == {"CC-BY-NC-4.0"}
    assert {r[2] for r in licenses.scan("Licensed under CC BY 4.0. Released under the MIT License.")} == {"CC-BY-4.0", "MIT"}
    assert {r[2] for r in licenses.scan("This work is licensed under the GNU General Public License, version 2.")} == {"GPL-2.0"}
    assert {r[2] for r in licenses.scan("Licensed under the Apache License, Version 1.1.")} == {"Apache-1.1"}
    assert licenses.scan("Licensed under the Apache License, Version 1.3.") == []


def test_expressions_titles_and_longer_names():
    def found(text):
        return sorted({r[2] for r in licenses.scan(f"// {text}\nint main")})

    head = "SPDX-License-Identifier: "
    assert found(head + "BSD-3-Clause-Clear") == ["BSD-3-Clause-Clear"]
    assert found(head + "BSD-3-Clause-Modification") == []
    assert found(head + "MIT OR Apache-2.0") == ["Apache-2.0", "MIT"]
    assert found(head + "(MIT AND (GPL-2.0-only WITH Classpath-exception-2.0))") == ["GPL-2.0", "MIT"]
    assert found(head + "GPL-3.0-or-later") == ["GPL-3.0"] and found(head + "mit") == ["MIT"]
    titles = {"Apache License Version 2.0, January 2004": "Apache-2.0", "Apache License 2.0": "Apache-2.0", "MIT License": "MIT", "The MIT License (MIT)": "MIT", "Boost Software License - Version 1.0": "BSL-1.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1": "LGPL-2.1", head + "LGPL-2.1-only": "LGPL-2.1", head + "EPL-2.0": "EPL-2.0", "Licensed under the EUPL, Version 1.2": "EUPL-1.2"}
    for text, name in titles.items():
        assert found(text) == [name], text


def test_clean_texts_have_none(spark):
    texts = ["She had poetic licence to write as is usual.", "My driving license expired.", "Copyright law is dull.", None, "", prose(random.Random(1), 500)]
    assert licenses.scanned(documents(spark, texts)).collect() == []
    assert licenses.scanned(empty(spark)).collect() == []


def test_hints_leave_nothing_out(spark):
    ways = ["LICENCE", "Licensed", "CopyRight", "copyleft", "WARRANTY", "redistribute", "Permissions", "spdx", "Public Domain", "ALL rights", "creative Commons", "CC BY", "CC-BY", "CCBY", "cc 0", "cc-0", "CC0", "AS IS"]
    assert all(licenses._CANDIDATE.search(w) for w in ways)
    assert all(any(h in w.lower() for h in licenses.HINTS) for w in ways)


def test_query_against_lines_known_by_sight(spark):
    import duckdb

    want = duckdb.sql("""select doc_id, count(*) from (select doc_id, unnest(string_split(text, chr(10))) as l from '/root/testdata/sf0.01/documents.parquet')
        where regexp_matches(l, '(GNU General Public License, version 3|CC BY-NC 4.0|under the MIT License|Apache License, Version 2.0|All rights reserved)') group by 1""").fetchall()
    found = licenses.op7_license_scan(spark, "/root/testdata/sf0.01").groupBy("doc_id").count().collect()
    assert sorted(tuple(r) for r in found) == sorted(want) and want


def test_every_wording_is_found_in_a_long_line():
    rng = random.Random(7)
    a, b = prose(rng, 12_000)[:50_000], prose(rng, 12_000)[:50_000]
    assert len(a) + len(b) == 100_000
    for name, texts in licenses.WORDINGS.items():
        for text in texts:
            assert name in {r[2] for r in licenses.scan(f"{a} {text} {b}")}, (name, text)


def test_every_wording_is_found_in_any_length_among_other_hits():
    """Matches of the vocabulary close to the wording, long words beside it, and a block of many long lines."""
    rng = random.Random(8)
    hits = " ".join(f"{prose(rng, 3)} permission {prose(rng, 2)} licensed" for _ in range(60))
    for name, texts in licenses.WORDINGS.items():
        for text in texts:
            for n in (20, 80, 140, 200, 300, 500, 800):
                assert name in {r[2] for r in licenses.scan(f"{prose(rng, n)} {text} {prose(rng, n)}")}, (name, text, n)
            assert name in {r[2] for r in licenses.scan(f"{hits} {text} {hits}")}, (name, text)
            assert name in {r[2] for r in licenses.scan(f"{'x' * 9000} {text} {'y' * 9000}")}, (name, text)
            half = max(text.find(" ", len(text) // 2), text.index(" "))
            lines = [prose(rng, 400), prose(rng, 400), text[:half], text[half + 1 :], prose(rng, 400)]
            assert name in {r[2] for r in licenses.scan("\n".join(lines))}, (name, text)


def plainly(text, wordings):
    """All blocks against all wordings, no compression: (first line, license, wording), best aligned first."""
    out = []
    for first, lines in licenses.candidates(text):
        left = [w for line in lines for w in licenses.words(line)]
        of = [first + k for k, line in enumerate(lines) for _ in licenses.words(line)]
        found = []
        for name, k, wording in wordings:
            for a in range(len(left)):
                if (hit := licenses.differences(left[a : a + 2 * len(wording) + 4], wording)) and hit[0] == 0:
                    found.append((-len(wording), len(hit[2]) + len(hit[3]), a, a + hit[1], name, k))
        taken = [False] * len(left)
        for _, _, a, b, name, k in sorted(found):
            if not any(taken[a:b]):
                taken[a:b] = [True] * (b - a)
                out.append((of[a], name))
    return out


def test_query_against_every_block_and_wording(spark):
    """The query on a whole table finds what the wordings find without any ranking by compression."""
    sf = "/root/testdata/sf0.001"
    wordings = [(name, k, licenses.words(t)) for name, texts in licenses.WORDINGS.items() for k, t in enumerate(texts)]
    want = sorted((r.doc_id, *x) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for x in plainly(r.text or "", wordings))
    got = sorted((r.doc_id, r.first_line, r.license) for r in licenses.op7_license_scan(spark, sf).collect())
    assert got == want and want


def test_long_blocks_take_time_in_proportion():
    """50,000 lines of one notice, and lines that merely use the vocabulary."""
    import time

    notice = licenses.WORDINGS["MIT"][4]
    began = time.perf_counter()
    assert len(licenses.scan("\n".join(["Released under the MIT License."] * 50_000))) == 50_000
    assert len([r for r in licenses.scan("\n".join([notice] * 1600)) if r[2] == "MIT"]) == 1600
    assert time.perf_counter() - began < 240
