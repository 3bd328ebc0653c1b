import hashlib
import re

import awkward

from tillroll.llm import pii

TEXTS = ["mail a.b+c@x.example.com, d@e.fr and @no.one x@y", "a@b.c@d.e f%g@h-i.j-k.", "ip 1.2.3.4.5.6.7.8 and 300.1.1.1 0001.255.0.9",
         "card 4111 1111 1111 1111 or 4111-1111-1111-1112 4379362835490466 12", "+1 (523) 555-1055 +49 30 123 +1.2.3.4.5.6.7.8.9.0",
         "IBAN DE89 3704 0044 0532 0130 00 AND GB82WEST12345698765432 and DE89370400440532013001",
         "ssn 123-45-6789 / 123-45-6789-0", "part 123-45-6780", "ÄÖ𝔘 +49 (30) 1234-5678 é a@b.co", "+ +1 +1-2", "9" * 3000, "@" * 500,
         "a" * 3000 + "@", "1." * 2000]
EXTRA = [(200 + k, t, "en", "a", len(t)) for k, t in enumerate(TEXTS)]


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    """The contract, word for word."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"\D", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_equals_the_contract_on_fixtures_and_a_whole_table(spark, sf_small):
    table = spark.read.parquet(f"{sf_small}/documents.parquet")
    for df in (awkward.docs(spark, EXTRA), table):
        text = {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}
        found = pii.digest(df).collect()
        assert len(found) == df.count()
        for r in found:
            want = base(text[r.doc_id])
            joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
            assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), r.doc_id
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in pii.BASE_KINDS]
            assert [s for s in r.spans.split(",") if s.split(":")[0] in pii.BASE_KINDS] == [x for x in joined.split(",") if x] or not joined


def test_checksums_and_context():
    kinds = lambda t: [(s.kind, t[s.start:s.end]) for s in pii.find_spans(t)]
    assert kinds(TEXTS[5]) == [("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432")]
    assert ("national_id", "123-45-6789") in kinds("my ssn 123-45-6789") and not kinds("serial 123-45-6780")
    near = {s.kind: s.score for t in ("visa card 4111111111111111", "host 10.0.0.1") for s in pii.find_spans(t)}
    far = {s.kind: s.score for t in ("order 4111111111111111", "version 10.0.0.1") for s in pii.find_spans(t)}
    assert all(near[k] > far[k] for k in near)


def test_redaction_keeps_rows_and_columns(spark):
    df = awkward.docs(spark, EXTRA)
    got = pii.redact_docs(df)
    assert got.columns == df.columns and got.count() == df.count()
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[200].text == "mail <email>, <email> and @no.one x@y" and rows[200].n_chars == len(rows[200].text)
    assert rows[0].text is None and rows[1].text == "" and rows[4].text == awkward.rows()[4][1]
    assert not [r for r in pii.detect(got).collect() if [s for s in r.spans if s.kind in ("email", "card")]]
    assert pii.digest(awkward.empty(spark)).count() == 0
