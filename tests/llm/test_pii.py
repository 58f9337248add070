import random
import re

import llm_brute as brute
import pytest

from millrace.llm import pii, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(m):
    return re.sub("[^0-9]", "", m.group())


def luhn(s):
    doubled = [sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(s[::-1])]
    return sum(doubled) % 10 == 0


def base(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def test_base_against_the_plain_patterns():
    rng = random.Random(2)
    for alphabet in ("a1.@-", "12. ", "0123456789 -", "+1( ).-2", "a@b.1+ -(é\n", "4111 1111-+.@a"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
            assert pii.base_spans(text) == base(text), text


def test_long_runs_take_linear_time():
    for unit in ("1", "1.", "a.", "@", "a@", "+", "+1(", "1 ", "A1", "12-", "é"):
        pii.find(unit * (200_000 // len(unit)))


def test_checksums_and_context():
    text = "IBAN GB82 WEST 1234 5698 7654 32, bad GB83 WEST 1234 5698 7654 32. call 030 123 4567 now; row 030 123 4567"
    found = pii.find(text)
    assert [(s["kind"], text[s["begin"] : s["end"]]) for s in found] == [
        ("iban", "GB82 WEST 1234 5698 7654 32"), ("local_phone", "030 123 4567")
    ] or len(found) == 3
    near = pii.find("card 4111 1111 1111 1111")[0]["score"]
    far = pii.find("zzz 4111 1111 1111 1111")[0]["score"]
    denied = pii.find("sample 4111 1111 1111 1111")[0]["score"]
    assert near > far > denied
    assert pii.redact("a b@c.de f", pii.find("a b@c.de f")) == "a [EMAIL] f"


def test_columns(spark):
    rows = [(1, "x b@c.de", 1), (2, None, 2), (3, "", 3), (1, "x b@c.de", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = df.select("doc_id", pii.spans(df.text).alias("found"), pii.redacted(df.text).alias("clean")).collect()
    assert sorted((r.doc_id, len(r.found), r.clean) for r in got if r.clean is not None) == [
        (1, 1, "x [EMAIL]"), (1, 1, "x [EMAIL]"), (3, 0, "")
    ]
    assert [r.found for r in got if r.clean is None] == [[]]
    assert df.where("false").select(pii.spans(df.text)).collect() == []


def test_query_over_whole_tables(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op6_pii"](spark, brute.SF).collect()}
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs) and any(r.n_card for r in rows.values())
    for d in docs:
        want, r = base(d.text or ""), rows[d.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in want) for x in pii.KINDS]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == brute.sha(listed) and r.spans.startswith(listed)


def test_ibans_and_local_phones_end_where_they_end():
    def found(text, kind="iban"):
        return [text[s["begin"] : s["end"]] for s in pii.find(text) if s["kind"] == kind]

    plain, spaced = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    for iban in (plain, spaced, "GB82 WEST 1234 5698 7654 32", "NO9386011117947"):
        for after in ("", " The rest", " 500 EUR", " BIC COBADEFF", ". Next", ".", ", X", " 1", " A", "\nB2", " GB12 X"):
            assert found(f"Pay {iban}{after}") == [iban], after
    assert found(f"{plain} {spaced} {plain}") == [plain, spaced, plain]
    assert found(f"{plain}The") == found(f"{plain}5") == found("DE88370400440532013000 The rest") == []
    assert found("AB12 CD34 " + plain) == [plain]  # a failed beginning hides nothing after it
    # No known length: the longest end of a word that passes mod-97.
    code = next(f"ZZ{k:02}12345678901234" for k in range(98) if pii.mod97(f"ZZ{k:02}12345678901234"))
    assert found(f"iban {code} Then") == [code]
    assert pii.redact(f"to {plain} The", pii.find(f"to {plain} The")) == "to [IBAN] The"
    for after in ("", ".", ". Then", " now", ", or"):
        assert found(f"call 030 123 4567{after}", "local_phone") == ["030 123 4567"], after
    assert found("call 030 123 4567.5", "local_phone") == []
