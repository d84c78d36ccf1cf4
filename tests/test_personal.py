"""Spans of personal data: planted values, with and without right check digits."""

import random

import pytest

from tarnwheel.functions import personal as p


def card(rng, right=True):
    body = [rng.randint(0, 9) for _ in range(15)]
    body[0] = 4
    check = next(c for c in range(10) if p.luhn("".join(map(str, body)) + str(c)))
    digits = "".join(map(str, body)) + str(check if right else (check + 1) % 10)
    return digits if rng.random() < 0.5 else rng.choice(" -").join(digits[k : k + 4] for k in range(0, 16, 4))


def iban(rng, right=True):
    rest = "".join(rng.choices("0123456789", k=18))
    check = next(c for c in range(2, 99) if p.mod_97(f"DE{c:02d}{rest}"))
    plain = f"DE{(check if right else check - 1 if check > 2 else 98):02d}{rest}"
    return plain if rng.random() < 0.5 else " ".join(plain[k : k + 4] for k in range(0, len(plain), 4))


def key(rng, n=32):
    return "".join(rng.choices("0123456789abcdefABCDEFGHJKMNPQRSTUVWXYZ", k=n))


REAL = {
    "email": lambda r: f"a{r.randint(1, 999)}.b_c@mail{r.randint(1, 9)}.example.org",
    "phone": lambda r: f"+{r.randint(1, 99)} ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}",
    "ipv4": lambda r: ".".join(str(r.randint(0, 255)) for _ in range(4)),
    "card": card,
    "iban": iban,
    "aws_key": lambda r: "AKIA" + "".join(r.choices("ABCDEFGHIJ234567", k=16)),
    "github_token": lambda r: "ghp_" + key(r, 36),
    "jwt": lambda r: f"eyJ{key(r, 20)}.{key(r, 30)}.{key(r, 40)}",
    "private_key": lambda r: "-----BEGIN RSA PRIVATE KEY-----",
    "named_secret": lambda r: r.choice(["token = ", 'password: "', "API_KEY=", "db_secret='"]) + key(r),
}
FALSE = [lambda r: card(r, False), lambda r: iban(r, False), lambda r: "300.1.2.999", lambda r: "token = aaaaaaaaaaaaaaaaaaaaaaaa", lambda r: "secret of the garden", lambda r: "a@b", lambda r: "AKIA123", lambda r: "1 2 3", lambda r: "+4 apples (555)"]


def planted(seed=3, n=400):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        text, spans = "", []
        for _ in range(rng.randint(0, 5)):
            text += " ".join(rng.choices(["and", "Straße", "☃", "of", "x-y", "\n", "日本"], k=rng.randint(1, 12))) + " "
            kind = rng.choice([*REAL, None, None])
            value = REAL[kind](rng) if kind else rng.choice(FALSE)(rng)
            if kind:
                spans.append((kind, len(text), len(text) + len(value)))
            text += value + rng.choice([" ", "\n", ", ", " ;"])
        rows.append((k, text, spans))
    return rows


def test_planted_spans_are_found_and_nothing_else(spark):
    rows = planted()
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t, _ in rows], "doc_id long, text string, kind string, start int")
    got = {(r.doc_id, r.kind, r.start, r.stop) for r in p.personal_spans(docs).collect()}
    want = {(k, *s) for k, _, spans in rows for s in spans}
    right = len(got & want)
    print(f"precision {right / len(got):.4f}, recall {right / len(want):.4f} of {len(want)} planted spans")
    assert right / len(want) >= 0.99 and right / len(got) >= 0.98


def test_checks():
    assert p.luhn("4539 1488 0343 6467") and not p.luhn("4539 1488 0343 6468")
    assert p.mod_97("GB82 WEST 1234 5698 7654 32") and not p.mod_97("GB83 WEST 1234 5698 7654 32")
    assert p.octets("1.2.3.255") and not p.octets("1.2.3.256")
    assert p.bits("aaaa") == 0 and p.bits("abcd") == 2


def test_masks(spark):
    text = 'Call +1 (555) 555-1234 or a@b.example.org; token="' + key(random.Random(1)) + '"'
    assert p.masked(text) == 'Call [phone] or [email]; [named_secret]"'
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    assert [r.text for r in p.mask_personal(docs).orderBy("doc_id").collect()] == [p.masked(text), None, ""]


def test_odd_rows(spark):
    schema = "doc_id string, text string"
    assert p.personal_spans(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, "a@b.example.org"), ("x", None), ("x", ""), ("y", "12 " * 50_000 + "1.2.3.4"), ("y", "1.2.3.4"), ("y", "1.2.3.4")]
    got = sorted(map(tuple, p.personal_spans(spark.createDataFrame(rows, schema)).collect()), key=repr)
    assert got == sorted([(None, "email", 0, 15, "a@b.example.org"), ("y", "ipv4", 150_000, 150_007, "1.2.3.4"), *[("y", "ipv4", 0, 7, "1.2.3.4")] * 2], key=repr)


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_twin(spark, sf):
    import duckdb

    from tarnwheel.plans import catalog

    con = duckdb.connect()
    con.sql(f"create view documents as select * from '/root/testdata/{sf}/documents.parquet'")
    got = catalog.QUERIES["q_personal_spans"](spark, f"/root/testdata/{sf}").collect()
    assert sorted(map(tuple, got)) == sorted(con.sql(catalog.ORACLE["q_personal_spans"]).fetchall()) and len(got) > 50
