"""Operator 3: personal data. Regular expressions propose spans, checksums confirm them, nearby words adjust the score."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, small_batches, text_or_empty

# The patterns and kinds of the contract.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone", "iban")
# End of the fixed values.

#: What the method proposes beyond them: numbers standing alone, and account numbers.
CARD_ALONE = re.compile(r"(?<![0-9A-Za-z])[0-9]{4}(?:[0-9]{9,15}|(?:-[0-9]{4}){2}-[0-9]{4}|(?: [0-9]{4}){3})(?![0-9A-Za-z])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
DIGIT = re.compile(r"[0-9]")
#: The same matches as those of EMAIL, IP and CARD, in time that follows the text's length: no run is tried from each of its places.
EMAIL_HERE = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP_ONCE = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD_ONCE = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
#: Places of the longest text that has 19 digits, with a separator between any two.
CARD_PLACES = 37
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Score before context, and words that raise or lower it when they stand within NEAR characters.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.9}
WORDS = {
    "email": (("mail", "contact", "write to"), ("example",)),
    "ip": (("ip", "host", "address", "server"), ("version", "release", "section")),
    "card": (("card", "visa", "credit", "carte", "karte", "tarjeta"), ("serial", "isbn", "order")),
    "phone": (("phone", "call", "tel", "mobile", "fax"), ("version", "score")),
    "iban": (("iban", "account", "bank", "konto", "cuenta", "compte"), ("serial",)),
}
NEAR, STEP, LEAST = 40, 0.1, 0.5


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def mod97(number: str) -> bool:
    """Account number: the first four characters go last, letters count from 10, and the remainder by 97 is 1."""
    moved = number[4:] + number[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def digits(text: str) -> str:
    return "".join(DIGIT.findall(text))


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of EMAIL: for each @, what precedes it since the last match, and what follows."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = EMAIL_HERE.match(text, start) if start < at else None
        done = m.end() if m else at + 1
        found += [m.span()] if m else []
        at = text.find("@", done)
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The contract's spans: leftmost non-overlapping matches of each kind that pass its check."""
    found = [("email", *s) for s in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        found += [("ip", *m.span()) for m in IP_ONCE.finditer(text) if all(int(p) <= 255 if len(p) < 9 else not p.strip("0") or int(p.lstrip("0")[:4]) <= 255 and len(p.lstrip("0")) < 4 for p in m[0].split("."))]
        found += [("card", *m.span()) for m in CARD_ONCE.finditer(text) if 16 <= m.end() - m.start() <= CARD_PLACES and 16 <= len(d := digits(m[0])) <= 19 and luhn(d)]
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15] if "+" in text else []
    return found


def more_spans(text: str) -> list[tuple[str, int, int]]:
    """What the method adds: checksummed numbers that the base patterns join with their neighbours, and account numbers."""
    if not DIGIT.search(text):
        return []
    found = [("card", *m.span()) for m in CARD_ALONE.finditer(text) if 13 <= len(d := digits(m[0])) <= 19 and d[0] in "23456" and luhn(d)]
    return found + [("iban", *m.span()) for m in IBAN.finditer(text) if 15 <= len(n := m[0].replace(" ", "")) <= 34 and mod97(n)]


def score(text: str, kind: str, start: int, end: int) -> float:
    near = (text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]).lower()
    good, bad = WORDS[kind]
    return round(min(1.0, max(0.0, PRIOR[kind] + STEP * any(w in near for w in good) - 2 * STEP * any(w in near for w in bad))), 3)


def spans(text: str) -> list[dict]:
    """All spans of a text, by kind and start; base: whether the contract's patterns give it."""
    if "@" not in text and not DIGIT.search(text):
        return []
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    starts, ends = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    added = [x for x in more_spans(text) if not (k := bisect_left(starts, x[2])) or ends[k - 1] <= x[1]]
    out = [{"kind": k, "start": a, "end": b, "score": score(text, k, a, b), "base": True} for k, a, b in base]
    out += [s for k, a, b in added if (s := {"kind": k, "start": a, "end": b, "score": score(text, k, a, b), "base": False})["score"] >= LEAST]
    return sorted(out, key=lambda s: (KINDS.index(s["kind"]), s["start"]))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]))


def personal_data(docs: DataFrame, text: str = "text", to: str = "spans") -> DataFrame:
    """`docs` with a column `to`: its text's spans as array<struct<kind, start, end, score, base>>.

    Places are code points, end exclusive; a null or empty text has an empty array. Base spans always stay; spans that
    the method adds overlap none of them and need a score of LEAST. A column of the same name as `to` is replaced.
    """
    small_batches(docs.sparkSession)

    def found(batches):
        for batch in batches:
            got = pa.array([spans(t or "") for t in batch.column(text).to_pylist()], _SPANS)
            keep = [k for k in batch.schema.names if k != to]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), got], [*keep, to])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != to), f"`{to}` array<struct<kind:string,start:bigint,end:bigint,score:double,base:boolean>>"])
    return docs.mapInArrow(found, schema)


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with each span of its texts replaced by the kind in angle brackets; null texts stay null."""

    def clean(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            out = []
            for t in batch.column(at).to_pylist():
                end = len(t or "")
                for s in sorted(spans(t or ""), key=lambda s: -s["start"]):
                    if s["end"] <= end:
                        t, end = f"{t[: s['start']]}<{s['kind']}>{t[s['end'] :]}", s["start"]
                out.append(t)
            yield batch.set_column(at, text, pa.array(out, batch.schema.field(at).type))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(clean, docs.schema)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", text_or_empty().alias("text"))
    found = personal_data(docs).drop("text")
    base = F.filter("spans", lambda s: s["base"])
    said = lambda xs: F.concat_ws(",", F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(k) for k in KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"), F.transform("spans", lambda s: s["score"]).alias("scores"))


def sha256(found: list[tuple[str, int, int]]) -> str:
    """base_sha256 of base_spans(), as the tests compute it."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest()
