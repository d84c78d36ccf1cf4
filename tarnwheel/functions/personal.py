"""Personal data and secrets in texts, as spans: hints by an Aho-Corasick automaton, patterns, and checks of what they find.

One pass of the automaton over a text says which kinds can be there at all, so most texts are read once and no pattern is
tried on them. What a pattern finds has to pass its check: Luhn's sum for cards, mod 97 for IBANs, octets for addresses,
and at least LEAST_BITS bits a character (entropy of its own characters) for secrets that only their name gives away.

Defined results: a null or empty text has no spans; texts are read whole; spans of one kind don't overlap, those of
different kinds may; repeated rows give their spans each; other columns don't matter.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BITS = 3.0


def luhn(found: str) -> bool:
    """Luhn's check of the digits of a card number."""
    digits = [int(c) for c in reversed(found) if c.isdigit()]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def mod_97(found: str) -> bool:
    """The check digits of an IBAN: the country and check digits go last, letters count from A = 10."""
    plain = found.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def octets(found: str) -> bool:
    return all(int(x) < 256 for x in found.split("."))


def bits(found: str) -> float:
    """Entropy of a string's characters, in bits a character."""
    return -sum(n / len(found) * math.log2(n / len(found)) for n in Counter(found).values())


def _value(found: str) -> bool:
    """Whether what is named a secret is as uneven as one: the last run of key characters counts."""
    return bits(re.findall(r"[A-Za-z0-9+/_=-]{16,}", found)[-1]) >= LEAST_BITS


#: Kind, hints of which one has to be there in lower case, pattern, check.
KINDS = [
    ("email", ["@"], r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", None),
    ("phone", ["+"], r"\+[0-9]{1,3} ?\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}\b", None),
    ("ipv4", list("0123456789"), r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b", octets),
    ("card", list("0123456789"), r"\b[0-9](?:[ -]?[0-9]){12,18}\b", luhn),
    ("iban", list("0123456789"), r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", mod_97),
    ("aws_key", ["akia"], r"\bAKIA[0-9A-Z]{16}\b", None),
    ("github_token", ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"], r"\bgh[pousr]_[A-Za-z0-9]{36}\b", None),
    ("jwt", ["eyj"], r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", None),
    ("private_key", ["-----begin"], r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", None),
    ("named_secret", ["token", "secret", "passw", "pwd", "api_key", "api-key", "apikey"], r"(?i)\b(?:[a-z0-9]+[_-])*(?:token|secret|password|passwd|pwd|api[_-]?key)[\"']?[ \t]*[:=][ \t]*[\"']?[A-Za-z0-9+/_=-]{16,}", _value),
]


@cache
def _automaton():
    """The automaton over all hints; each stands for a number with the bits of its kinds."""
    import ahocorasick

    which: dict[str, int] = {}
    for k, (_, hints, _, _) in enumerate(KINDS):
        for h in hints:
            which[h] = which.get(h, 0) | 1 << k
    found = ahocorasick.Automaton()
    for h, kinds in which.items():
        found.add_word(h, kinds)
    found.make_automaton()
    return found


_PATTERNS = [(kind, re.compile(pattern, re.ASCII), check) for kind, _, pattern, check in KINDS]
_LOWER = {c: c + 32 for c in range(65, 91)}


def spans(text: str | None) -> Iterator[tuple[str, int, int]]:
    """(kind, start, stop) in code points."""
    kinds = 0
    for _, some in _automaton().iter((text or "").translate(_LOWER)):
        kinds |= some
        if kinds == (1 << len(KINDS)) - 1:
            break
    for k, (kind, pattern, check) in enumerate(_PATTERNS):
        if kinds >> k & 1:
            for m in pattern.finditer(text):
                if check is None or check(m[0]):
                    yield kind, m.start(), m.end()


def _found(batches: Iterator[pa.RecordBatch], id_col: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, row, kinds, starts, stops, parts = batch.column(1), [], [], [], [], []
        for k in range(batch.num_rows):
            text = texts[k].as_py()
            for kind, a, b in spans(text):
                row.append(k)
                kinds.append(kind)
                starts.append(a)
                stops.append(b)
                parts.append(text[a:b])
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(stops, pa.int32()), pa.array(parts, pa.string())], [id_col, "kind", "start", "stop", "found"])


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, kind, start, stop, found), a row for each span; start and stop count code points from 0."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(lambda it: _found(it, id_col), f"`{id_col}` {kind}, kind string, start int, stop int, found string")


def masked(text: str | None) -> str | None:
    """The text with each span replaced by its kind in brackets; of spans that overlap, the one that begins first goes, of those the longest."""
    if text is None:
        return None
    out, at = [], 0
    for kind, a, b in sorted(spans(text), key=lambda x: (x[1], -x[2])):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
            at = b
    return "".join([*out, text[at:]])


def mask_personal(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with `masked` texts; all other columns stay."""

    @F.pandas_udf("string")
    def mask(texts):
        return texts.map(masked, na_action="ignore")

    return docs.withColumn(text_col, mask(F.col(text_col)))
