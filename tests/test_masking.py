from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from dockhand.functions import masking
from dockhand.sources.logs import sanitize_lines

LOG_VECTORS = [
    ("from 10.0.0.12 ok", "from xx.x.x.xx ok"),
    ("10.1.1.1", "xx.x.x.x"),
    ("mac 00:1A:2b:3c:4D:5e up", "mac xx:xx:xx:xx:xx:xx up"),
    ("login password=hunter2 x", "login password=**** x"),
    ("login password= x", "login password=**** x"),
    ("mail bob.x@mail.corp.com end", "mail bob.x@****.corp.com end"),
    ("call 555-123-4567 now", "call 555-***-**** now"),
    ("card 1234567890123456 z", "card 123-***-****123456 z"),
    ("card 1234-5678-9012-3456 z", "card 1234-5678-9012-3456 z"),
    ("card 1 1234567890123456 z", "card 1 **** **** **** 3456 z"),
    ("short 1234 z", "short 1234 z"),
    ("", ""),
    (None, None),
]
DOCUMENT_VECTORS = [
    ("c 1234-5678-9012-3456", "c XXXX-XXXX-XXXX-XXXX", "c 1234-5678-9012-3456"),
    ("c 1234567890123456", "c XXXX-XXXX-XXXX-XXXX", "c [CREDIT_CARD]"),
    ("s 123-45-6789", "s XXX-XX-XXXX", "s [SSN]"),
    ("a.b@c.org", "XXXX@XXXX.com", "[EMAIL]"),
    (
        "paid with 1234-5678-9012-3456, holder no. 123-45-6789 on file",
        "paid with XXXX-XXXX-XXXX-XXXX, holder no. XXX-XX-XXXX on file",
        "paid with 1234-5678-9012-3456, holder no. [SSN] on file",
    ),
    (None, None, ""),
]


def test_log_vectors(spark):
    df = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(LOG_VECTORS)], "i int, value string")
    got = {r.i: r.value for r in sanitize_lines(df).collect()}
    assert [got[i] for i in range(len(LOG_VECTORS))] == [want for _, want in LOG_VECTORS]


def test_document_vectors(spark):
    df = spark.createDataFrame([(i, v[0]) for i, v in enumerate(DOCUMENT_VECTORS)], "i int, t string")
    rows = df.select("i", masking.mask_document_a(F.col("t")), masking.mask_document_b(F.col("t"))).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == {i: v[1:] for i, v in enumerate(DOCUMENT_VECTORS)}


@pytest.mark.parametrize("mask", [masking.mask_document_a, masking.mask_document_b])
def test_masking_twice_changes_nothing(spark, checked, mask):
    docs = spark.read.parquet(f"{checked}/documents.parquet")
    once = docs.select(mask(F.col("text")).alias("once"))
    assert once.filter(mask(F.col("once")) != F.col("once")).isEmpty()


def test_log_rules_follow_a_match_callback(spark, checked):
    """Whole texts and awkward address runs against Python's own substitution."""
    awkward = [
        "a@.b.com a@b.comx@c.org x@y.zz@w.co .a@b.io %x@q-r.s.travel",
        "ü1234567890123456 ٣٣٣-٣٣٣-٣٣٣٣ 999.1.2.3.4 +1 (555) 123-4567",
        "A" * 200_000 + "@",
    ]
    docs = [r.text for r in spark.read.parquet(f"{checked}/documents.parquet").select("text").collect()] + awkward

    def expected(line):
        def inside(pattern, change):
            return lambda s: re.sub(pattern, lambda m: change(m.group()), s)

        steps = [
            inside(r"\b(?:\d{1,3}\.){3}\d{1,3}\b", lambda m: re.sub(r"\d", "x", m)),
            inside(r"\b(?:[0-9a-fA-F]{2}:){5}[0-9a-fA-F]{2}\b", lambda m: re.sub("[0-9a-fA-F]", "x", m)),
            lambda s: re.sub(r"(?<=password=)\S*", "****", s),
            lambda s: s
            if len(s) > 100_000
            else re.sub(
                r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,4}",
                lambda m: re.sub(r"(?<=@)[^.]+(?=\.)", "****", m.group()),
                s,
            ),
            inside(
                r"\+?\d{1,3}[-.\s]?\(?\d{1,4}?\)?[-.\s]?\d{1,4}[-.\s]?\d{1,4}",
                lambda m: re.sub(r"(\d{3})[-.\s]?(\d{3})[-.\s]?(\d{4})", r"\1-***-****", m),
            ),
            inside(r"\b(?:\d{4}[-\s]?){3}\d{4}\b", lambda m: re.sub(r"\d{12}(\d{4})", r"**** **** **** \1", m)),
        ]
        for step in steps:
            line = step(line)
        return line

    df = spark.createDataFrame(list(enumerate(docs)), "i int, value string")
    got = {r.i: r.value for r in sanitize_lines(df).collect()}
    assert [got[i] for i in range(len(docs))] == [expected(d) for d in docs]


def test_pii_hits(spark):
    df = spark.createDataFrame([("1.2.3.4 a@b.cc 123-45-6789 password=x 00:11:22:33:44:55",)], "t string")
    row = df.select(*[c.alias(n) for n, c in masking.pii_hits(F.col("t")).items()]).first()
    assert row.asDict() == {"card": 0, "ssn": 1, "email": 1, "ip": 1, "mac": 1, "password": 1, "phone": 0}
