"""Personal data: patterns propose spans, checksums confirm, context words score.

Base kinds (email, ip, card, phone) are found exactly as their patterns say,
leftmost and non-overlapping per kind; a proposal that fails its check is
dropped without a retry.  The method adds kinds whose form alone proves
little: an IBAN is confirmed by its country's length and mod 97, a national id
or a local phone number needs a context word near it.  Every span carries a score: the prior of its
kind, raised by a passed checksum and by context words of the kind within
``CONTEXT`` characters, lowered by words that speak against it.  Base spans
stay whatever their score; added spans need ``THRESHOLD``.

Patterns only start where a longer match could not have started, so a long
run of digits or letters is read a constant number of times.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTEXT = 40  # characters before and after a span whose words adjust its score
THRESHOLD = 0.6
BASE = ("email", "ip", "card", "phone")

# Prior score of each kind, in the order in which spans are listed.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.5, "phone": 0.7, "iban": 0.5, "national_id": 0.3, "local_phone": 0.3}
# Words near a span that speak for its kind.
FOR = {
    "email": {"email", "mail", "contact", "e-mail", "correo", "courriel"},
    "ip": {"ip", "address", "host", "server", "login", "adresse", "direccion"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "payment", "karte", "carte", "tarjeta"},
    "phone": {"phone", "call", "tel", "mobile", "fax", "telefon", "telephone", "telefono"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
    "national_id": {"ssn", "social", "security"},
    "local_phone": {"phone", "call", "tel", "mobile", "fax", "telefon", "telephone", "telefono"},
}
# Words near a span that speak against any kind.
AGAINST = {"version", "order", "isbn", "serial", "example", "invoice", "id"}

# Characters of an IBAN by its country.
IBAN_LENGTH = {c: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for c in codes.split()}

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
NATIONAL_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])")
ALNUM = re.compile(r"[A-Za-z0-9]")
WORD = re.compile(r"[^\W\d_][\w-]*")
NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for at, d in enumerate(reversed(digits)):
        v = int(d) * (1 + at % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The local part before an @ is the whole run of its characters since
    the last match, so only the @ signs need to be visited."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = floor + len(text[floor:at].rstrip(LOCAL))
        m = DOMAIN.match(text, at) if start < at else None
        floor = m.end() if m else at + 1
        if m:
            yield start, floor
        at = text.find("@", floor)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            d = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(d) <= 19 and luhn(d):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


def ibans(text: str) -> list[tuple[int, int]]:
    """An IBAN ends at a word's end, after as many characters as its country
    has; for other countries the ends are tried from long to short, and what
    overlaps a known country's IBAN is none."""
    known: list[tuple[int, int]] = []
    other: list[tuple[int, int]] = []
    m = IBAN.search(text)
    while m:
        start = m.start()
        ends = [i + 1 for i in range(start, m.end()) if text[i] != " "]  # after each character
        length = IBAN_LENGTH.get(text[start : start + 2])
        found = known if length else other
        for n in [length] if length else range(len(ends), 14, -1):
            if n <= len(ends) and not ALNUM.match(text, end := ends[n - 1]) and mod97(text[start:end]):
                if not found or found[-1][1] <= start:
                    found.append((start, end))
                break
        m = IBAN.search(text, start + 1)  # a start that fails hides none
    before = lambda end: known[max(0, bisect_left(known, (end, 0)) - 1) :][:1]
    return sorted(known + [s for s in other if all(b <= s[0] or a >= s[1] for a, b in before(s[1]))])


def score(kind: str, text: str, start: int, end: int) -> float:
    """Between 0 and 1."""
    near = {w.lower() for w in WORD.findall(text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT])}
    s = PRIOR[kind] + 0.3 * (kind in ("card", "iban"))  # these two have passed a checksum
    s += 0.4 * bool(near & FOR[kind]) - 0.2 * bool(near & AGAINST - FOR[kind])
    return round(min(1.0, max(0.0, s)), 2)


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in code points, end exclusive, by kind and start."""
    text = text or ""
    found = {k: [] for k in PRIOR}
    if "@" in text:
        found["email"] = [*emails(text)]
    if re.search("[0-9]", text):
        found["ip"], found["card"], found["phone"] = [*ips(text)], [*cards(text)], [*phones(text)]
        base = sorted(s for k in BASE for s in found[k])
        other = sorted(s for k in BASE if k != "card" for s in found[k])  # a confirmed IBAN stands beside a card
        free = lambda s, spans: not any(a < s[1] and s[0] < b for a, b in spans)
        for kind, spans in (("iban", ibans(text)), ("national_id", (m.span() for m in NATIONAL_ID.finditer(text))),
                            ("local_phone", (m.span() for m in LOCAL_PHONE.finditer(text)))):
            found[kind] = [s for s in spans if score(kind, text, *s) >= THRESHOLD and free(s, other if kind == "iban" else base)]
    return [(k, a, b, score(k, text, a, b)) for k in PRIOR for a, b in found[k]]


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): one row per input row; spans is an array of (kind, start,
    end, score), empty where a text is null, blank or clean.  Rows that repeat
    or have a null id each give a row; other columns are not read."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = ([dict(zip(("kind", "start", "end", "score"), s)) for s in find(t.as_py())] for t in b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(span))], ["id", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(
        run, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>")


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def op7_pii(spark, sf_dir: str) -> DataFrame:
    from starlens.llm.common import table

    found = personal_data(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    told = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        F.col("id").alias("doc_id"), *map(count, BASE),
        F.sha2(F.array_join(F.transform(base, told), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", told), ",").alias("spans"),
        F.transform("spans", lambda s: s["score"]).alias("scores"))
