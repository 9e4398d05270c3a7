"""Spans against the plain patterns run over whole texts; masking; edge cases."""

import hashlib
import re

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from chartloom.llm import pii
from chartloom.llm.catalog import QUERIES

FOLDER = "/root/testdata/sf0.01"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    text = text or ""
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m.group())) <= 15]
    return out


def base(text):
    return [s for s in pii.find(text) if s[0] in pii.BASE_KINDS]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="0123459.@+- ()aZ%_é\n", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert base(text) == brute(text)


def test_cases():
    for text in ["a@b.c@d.e", "a@b", "1.2.3.4.5.6.7.8", "256.1.1.1.9.9.9.9", "0001.2.3.255", "+1 (555) 123-4567", "++12 345 678 9",
                 "4111 1111 1111 1111", "4111-1111-1111-1112", "x" * 5000 + "@" + "y.z" * 2000, "9" * 4000, None, ""]:
        assert base(text) == brute(text)
    assert pii.find("pay GB82 WEST 1234 5698 7654 32 now")[-1] == ("account", 4, 31)
    assert ("ssn", 3, 14) in pii.find("id 219-09-9999.")
    assert ("secret", 9, 49) in pii.find('token = "' + "5fa2b6cd0b" * 4 + '"')
    assert ("url", 0, 26) in pii.find("ftp://me:pass@host.org/dir")
    assert [s for s in pii.find("a plain text about tokens: nothing here, GB12 neither") if s] == []


def test_mask():
    assert pii.masked("write a.b@c.org or +1 (555) 123-4567!") == "write <EMAIL> or <PHONE>!"
    assert pii.masked(None) is None and pii.masked("") == "" and pii.masked("fine") == "fine"


def test_query_on_whole_table(spark):
    rows = {r.doc_id: r for r in QUERIES["op9_pii"](spark, FOLDER).collect()}
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    assert len(rows) == len(texts)
    for doc_id, text in texts:
        expected = brute(text)
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in expected)
        row = rows[doc_id]
        assert row.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == kind for k, _, _ in expected) for kind in pii.BASE_KINDS]
        assert row.spans.startswith(line)


def test_frame(spark):
    rows = [(1, None, "a"), (1, None, "a"), (None, "", None), (2, "é me@x.org", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = {(r.doc_id, r.spans) for r in pii.digest(pii.spans(df)).collect()}
    assert got == {(1, ""), (None, ""), (2, "email:2:10")}
    assert pii.spans(df.limit(0)).count() == 0
    assert sorted(pii.mask(df).collect(), key=str)[-1].text in ("é <EMAIL>", "", None)
    assert {r.text for r in pii.mask(df).collect()} == {None, "", "é <EMAIL>"}
    assert pii.mask(df).columns == df.columns


def test_very_long_parts_of_dotted_numbers():
    zeros = "0" * 5000
    assert ("ip", 0, len(zeros) + 7) in pii.find(zeros + "1.2.3.4")
    assert ("ip", 0, len(zeros) + 6) in pii.find("1.2.3." + zeros)
    assert [s for s in pii.find(zeros + "256.2.3.4") if s[0] == "ip"] == []


def test_time_follows_the_length():
    import time

    for text in ("token=" * 200_000, "sk-" * 300_000, "a@" * 300_000, "+1" * 300_000, "1." * 300_000, "AB12 " * 200_000, "://a:b" * 150_000, "password: " * 100_000):
        started = time.perf_counter()
        pii.find(text)
        assert time.perf_counter() - started < 6, text[:12]
    # a value beyond one that was dropped is still found
    text = "token=abcdefghijklmnopqrst; sk-aaaaaaaaaaaaaaaaaatoken=abcdef1234567890abcd secret=ABCDEFGHIJKLMNOPtoken: abc123abc123abc123"
    assert [text[s:e] for k, s, e in pii.find(text) if k == "secret"] == ["abcdef1234567890abcd", "abc123abc123abc123"]
