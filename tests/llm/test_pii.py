import hashlib
import os
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from inkwell.llm import pii
from inkwell.llm.queries import op9
from tests.llm.helpers import documents, save

SF = "/root/testdata/sf0.01"
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in twice) % 10 == 0


def slow_base(text):
    """(kind, start, end) by the plain patterns and checks."""
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0,
                    "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def check(rows, texts):
    for r in rows:
        base = slow_base(texts[r["doc_id"]] or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(x[0] == k for x in base) for k in PLAIN], texts[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert r["spans"].startswith(joined)


CASES = [
    "a@b.c_x@y.z", "a@b a@b.c@d.e", "x..y@z-.q.w.", "é@b.c 😀 me+you%@mail.example.com!", "@a.b", "a@.b", "foo@bar@baz.com",
    "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 001.02.3.0255 1.2.3", "9999999999999999999999.1.1.1", "1..2.3.4",
    "4111111111111111", "4111 1111-1111 1111", "4111  1111 1111 1111", "5 4111111111111111", "0000000000000", "1", "12",
    "+1 (609) 555-7932 and +49.30.123456-", "+1", "+12", "++12 34 56 78 9", "+1234567890123456", "+4111111111111111",
    "IBAN GB82 WEST 1234 5698 7654 32 x", "GB82WEST12345698765432", "GB83WEST12345698765432", "phone: 609-555-7932",
    "609-555-7932", "ssn 123-45-6789", "123-45-6789", "SSN 000-12-3456", "tel (609) 555 7932 mail me@x.org",
]


def test_query_against_the_plain_patterns(spark, tmp_path):
    rnd = random.Random(7)
    pool = list("0123456789+@. -()aZ_%") + ["4111111111111111", "é", "10.0.0.1", "x@y.z", "\n", "+49 30 1234567"]
    texts = dict(enumerate([*CASES, None, "", *["".join(rnd.choices(pool, k=rnd.randint(1, 60))) for _ in range(400)]]))
    df = documents(spark, list(texts.items()), kind="1", email="2", proposed="3", added="4", spans="5")
    check(op9(spark, save(spark, tmp_path, documents=df)).collect(), texts)


def test_whole_table_against_the_plain_patterns(spark):
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = op9(spark, SF).collect()
    assert len(rows) == len(texts) and sum(r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] for r in rows) > 20
    check(rows, texts)


def test_added_spans_and_scores(spark, tmp_path):
    rows = list(enumerate(CASES))
    got = {CASES[r["doc_id"]]: r["spans"] for r in op9(spark, save(spark, tmp_path, documents=documents(spark, rows))).collect()}
    assert got["IBAN GB82 WEST 1234 5698 7654 32 x"] == "iban:5:32"
    assert got["GB82WEST12345698765432"] == "iban:0:22" and got["GB83WEST12345698765432"] == ""
    assert got["phone: 609-555-7932"] == "local_phone:7:19" and got["609-555-7932"] == ""
    assert got["ssn 123-45-6789"] == "social_security:4:15" and got["123-45-6789"] == got["SSN 000-12-3456"] == ""
    found = pii.find(documents(spark, [(1, "server 10.0.0.1"), (2, "10.0.0.1")])).collect()
    assert {r["doc_id"]: r["ip"][0]["score"] for r in found} == {1: 1.0, 2: 0.6}


def test_redaction(spark):
    rows = [(1, "Write me@x.org or 10.0.0.1 or +1 (609) 555-7932."), (2, "card 4111 1111 1111 1111 ok 1.2.3.999"), (3, None),
            (4, "clean text 12 + 3"), (5, ""), (6, "iban GB82 WEST 1234 5698 7654 32, tel 609-555-7932")]
    df = documents(spark, rows, gaps="x", matches="y")
    got = pii.redact(df)
    assert got.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {
        1: "Write [EMAIL] or [IP] or [PHONE].", 2: "card [CARD] ok 1.2.3.999", 3: None, 4: "clean text 12 + 3", 5: "",
        6: "iban [IBAN], tel [LOCAL_PHONE]"}
    texts = [(i, t) for i, t in enumerate(CASES)]
    for r in pii.redact(documents(spark, texts)).collect():
        assert not slow_base(r["text"])


def test_long_runs_and_empty(spark, tmp_path):
    long = {1: "a" * 300_000, 2: "1" * 300_000, 3: "+1" + "-" * 300_000, 4: "1." * 150_000, 5: "a@b.c " * 3_000, 6: "a@" * 100_000}
    df = documents(spark, list(long.items()))
    rows = op9(spark, save(spark, tmp_path, documents=df)).collect()
    counts = {r["doc_id"]: (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in rows}
    assert counts[1] == counts[2] == counts[3] == counts[6] == (0, 0, 0, 0)
    assert counts[4] == (0, 37_500, 0, 0) and counts[5] == (3_000, 0, 0, 0)
    repeated = documents(spark, [(None, "a@b.c"), (1, "a@b.c"), (1, "a@b.c")])
    assert [r["n_email"] for r in op9(spark, save(spark, tmp_path / "r", documents=repeated)).collect()] == [1, 1, 1]
    assert op9(spark, save(spark, tmp_path / "none", documents=df.limit(0))).count() == 0


def test_ibans_end_where_their_country_says(spark, tmp_path):
    de, spaced, gb, fr = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "FR14 2004 1010 0505 0001 3M02 606"
    cases = [(f"IBAN {de} BIC COBADEFFXXX", [de]), (f"{de} EUR 500", [de]), (f"{spaced} 2024-01-05", [spaced]), (f"{de} {gb}", [de, gb]),
             (f"{spaced} {spaced} {fr} X1", [spaced, spaced, fr]), (f"REF GB12 ORDER 12345 {spaced} EUR", [spaced]), (f"XX12 3456 7890 123 {de}", [de]),
             (f"{de}1", []), (f"{de[:-1]} 1 EUR", []), (f"X{de}", []), ("NO93 8601 1117 947 KTO 1", ["NO93 8601 1117 947"]),
             ("MT84 MALT 0110 0001 2345 MTLC AST0 01S A B", ["MT84 MALT 0110 0001 2345 MTLC AST0 01S"])]
    docs = documents(spark, [(i, t) for i, (t, _) in enumerate(cases)])
    spans = {r["doc_id"]: [x[len("iban:"):].split(":") for x in r["spans"].split(",") if x.startswith("iban")]
             for r in op9(spark, save(spark, tmp_path, documents=docs)).collect()}
    assert [[cases[i][0][int(a):int(b)] for a, b in spans[i]] for i in range(len(cases))] == [want for _, want in cases]
    redacted = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert redacted[0] == "IBAN [IBAN] BIC COBADEFFXXX" and redacted[3] == "[IBAN] [IBAN]"


def test_many_matches_in_one_text(spark):
    """200,000 matches of a base kind and of an added one: linear but for a logarithm."""
    n = 200_000
    text = "1.2.3.4," * n + "123-45-6789 ssn " * (n // 10)
    start = time.time()
    found = pii.find(documents(spark, [(1, text), (2, "12," * n), (3, "a@b.c " * n)]))
    sizes = [F.size(c).alias(c) for c in ("ip", "email", "added")]
    got = {r["doc_id"]: r for r in found.select("doc_id", *sizes, F.try_element_at("ip", F.lit(-1))["end"].alias("end")).collect()}
    assert (got[1]["ip"], got[1]["added"], got[1]["end"]) == (n, n // 10, 8 * n - 1)
    assert (got[2]["ip"], got[2]["email"], got[2]["added"], got[3]["email"]) == (0, 0, 0, n)
    assert time.time() - start < 60
