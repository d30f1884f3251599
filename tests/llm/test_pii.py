import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from starlens.llm.common import table
from starlens.llm.pii import BASE, IBAN_LENGTH, find, ibans, luhn, mod97, op7_pii, personal_data, score


def naive(text):
    """The contract's patterns as they stand, with their checks."""
    text, out = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    checks = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15)}
    for kind, (pattern, check) in checks.items():
        out += [(kind, *m.span()) for m in re.finditer(pattern, text) if check(m[0])]
    return out


def base(text):
    return [s[:3] for s in find(text) if s[0] in BASE]


KNOWN = ["+1 (917) 555-2670", "4111 1111 1111 1111", "4111-1111-1111-1112", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.2.3.004",
         "a@b.c_d@e.f", "a@b@c.d", "@x.y", "x..y%z@a-b.c.d", "++12345678901", "+1" + "-" * 50 + "2345678 9", "a@b.", "Ünï@ex.org"]
PIECE = st.one_of(st.sampled_from(KNOWN), st.text(st.sampled_from("0123456789.@ +-()ab_%é\n"), max_size=25))


@settings(max_examples=600, deadline=None)
@given(st.lists(PIECE, max_size=5).map("".join))
def test_base_equals_patterns(text):
    assert base(text) == naive(text)


def test_long_runs_are_read_once():
    for text in ("1" * 300_000, "a" * 300_000, "a." * 150_000 + "@", "1." * 150_000, "+1" * 100_000, "1 " * 150_000, "@" * 200_000):
        find(text)


def test_checks_and_added_kinds():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert mod97("GB82 WEST 1234 5698 7654 32") and not mod97("GB82 WEST 1234 5698 7654 33")
    kinds = lambda t: [s[0] for s in find(t)]
    assert kinds("pay to IBAN GB82 WEST 1234 5698 7654 32.") == ["iban"]
    assert kinds("code GB82 WEST 1234 5698 7654 33.") == []
    assert kinds("social security 123-45-6789") == ["national_id"] and kinds("part 123-45-6789") == []
    assert kinds("call 917-555-2670") == ["local_phone"] and kinds("lot 917-555-2670") == []
    assert score("email", "mail me at ", 11, 11) > score("email", "version of ", 11, 11)


def test_documents_table(spark):
    got = {r.doc_id: r for r in op7_pii(spark, "/root/testdata/sf0.01").collect()}
    docs = table(spark, "/root/testdata/sf0.01", "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        spans, r = naive(d.text), got[d.doc_id]
        assert [r[f"n_{k}"] for k in BASE] == [sum(s[0] == k for s in spans) for k in BASE]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert r.spans.split(",")[: len(spans)] == [f"{k}:{a}:{b}" for k, a, b in spans] or not spans


def test_odd_rows(spark):
    rows = [(1, None), (None, "a@b.cd"), (2, ""), (2, ""), (3, "x" * 200_000 + " a@b.cd")]
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, spans string, id int")
    got = sorted((r.id if r.id is not None else -1, [(s.kind, s.start, s.end) for s in r.spans]) for r in personal_data(docs).collect())
    assert got == [(-1, [("email", 0, 6)]), (1, []), (2, []), (2, []), (3, [("email", 200_001, 200_007)])]
    assert personal_data(docs.limit(0)).count() == 0


def test_ibans_end_where_they_end():
    """An upper-case word or a number behind an IBAN is no part of it."""
    known = ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "NO93 8601 1117 947"]
    for iban in known:
        for after in ("", ".", " BIC COBADEFFXXX", " USD 500", " EUR 20", " 2024", " X", "\nREF 7", " " + known[0]):
            text = "to " + iban + after
            assert [text[a:b] for a, b in ibans(text)][0] == iban, text
    assert len([*ibans(" ".join(known))]) == len(known)
    assert [*ibans("REF AA11 BB22 CC33 DD44 " + known[1])] == [(24, 51)]  # a start that fails hides none
    assert [*ibans("DE89 3704 0044 0532 0130 00X")] == [*ibans("DE89 3704 0044 0532 0130 01")] == []
    check = next(c for c in range(2, 99) if mod97(f"XX{c:02}12345678901234567"))
    text = f"XX{check:02}12345678901234567 USD 5"  # no known country: the ends are tried
    assert [*ibans(text)] == [(0, 21)] and "XX" not in IBAN_LENGTH


def test_iban_stands_beside_a_card():
    for n in range(10**11, 10**11 + 5000):  # a Belgian number whose 14 digits pass as a card
        iban = next(f"BE{c:02}{n}" for c in range(2, 99) if mod97(f"BE{c:02}{n}"))
        if luhn(iban[2:]):
            break
    assert [s[:3] for s in find("account " + iban)] == [("card", 10, 24), ("iban", 8, 24)]
