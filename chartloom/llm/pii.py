"""Personal data: anchors found by one Aho-Corasick pass, expanded and checked by local parsers.

The automaton finds at-signs, plus signs, digits, schemes and identifier cues. Around an
anchor a parser reads only the characters its kind may consist of, and checks the value
(octets, Luhn, digit counts, IBAN remainder, length of a secret). Each kind is read from
left to right without overlaps; a value that fails its check is dropped and not retried.

Base kinds: email, ip, card, phone. Added kinds: account (IBAN), ssn (United States),
secret (a long value after a cue such as `token =`, or a well-known key prefix) and url
(an address that carries a user and a password).

Defined results: a null or empty text has no spans and stays as it is; positions are code
points, ends exclusive; repeated rows give equal rows; other columns are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.llm.catalog import query
from chartloom.llm.common import documents, sliced, with_made

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("account", "ssn", "secret", "url")
KINDS = BASE_KINDS + ADDED_KINDS

# Characters and forms of the kinds, cue words, and prefixes of well-known keys.
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])*")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
SECRET_SIGN = re.compile(r"[\"']?[ \t]{0,4}[=:][ \t]{0,4}[\"']?")
SECRET = re.compile(r"[A-Za-z0-9+/_=.~-]{16,}")
KEY_TAIL = re.compile(r"[A-Za-z0-9_-]{16,}")
LOGIN = re.compile(r"://[^\s/@:]+:[^\s/@]+@[^\s/@]+(?:/\S*)?")
SECRET_CUES = ("token", "Token", "TOKEN", "api_key", "API_KEY", "apikey", "secret", "SECRET", "password", "PASSWORD", "passwd")
KEY_PREFIXES = ("AKIA", "ghp_", "gho_", "github_pat_", "sk-", "xoxb-", "xoxp-")

_MACHINE: list[ahocorasick.Automaton] = []


def _machine() -> ahocorasick.Automaton:
    if not _MACHINE:
        machine = ahocorasick.Automaton()
        for kind, anchors in (("@", ["@"]), ("+", ["+"]), ("0", list("0123456789")), ("://", ["://"]),
                              ("cue", SECRET_CUES), ("key", KEY_PREFIXES)):
            for anchor in anchors:
                machine.add_word(anchor, (kind, len(anchor)))
        machine.make_automaton()
        _MACHINE.append(machine)
    return _MACHINE[0]


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def iban(value: str) -> bool:
    moved = value[4:] + value[:4]
    return 15 <= len(value) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def find(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every span, by kind in the order of `KINDS`, then by start."""
    if not text:
        return []
    spans: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    email_end = ip_end = card_end = secret_end = account_end = ssn_end = 0
    value_end = key_end = 0  # of the last value and key tail looked at: what ends in a dropped one is no better
    for last, (kind, length) in _machine().iter(text):
        at = last + 1 - length
        if kind == "0":
            if at >= ip_end:  # a chain of dotted numbers is read four parts at a time
                parts = list(re.finditer(r"[0-9]+", chain.group())) if (chain := DOTTED.match(text, at)) else []
                ip_end = chain.end()
                for k in range(0, len(parts) - 3, 4):
                    if all(len(p.group().lstrip("0")) <= 3 and int(p.group().lstrip("0") or "0") <= 255 for p in parts[k : k + 4]):
                        spans["ip"].append((at + parts[k].start(), at + parts[k + 3].end()))
            if at >= card_end:
                run = DIGITS.match(text, at)
                card_end = run.end()
                digits = run.group().replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    spans["card"].append((at, card_end))
            before = text[at - 1] if at else " "
            if at >= account_end and at >= 2 and "A" <= before <= "Z" and "A" <= text[at - 2] <= "Z":
                if (at == 2 or not text[at - 3].isalnum()) and (found := IBAN.match(text, at - 2)):
                    if iban(found.group().replace(" ", "")):
                        spans["account"].append((at - 2, account_end := found.end()))
            if at >= ssn_end and not before.isdigit() and before != "-" and (found := SSN.match(text, at)):
                spans["ssn"].append((at, ssn_end := found.end()))
        elif kind == "@":
            start = at
            while start > email_end and text[start - 1] in LOCAL_PART:
                start -= 1
            if start < at and (host := HOST.match(text, at + 1)):
                spans["email"].append((start, email_end := host.end()))
        elif kind == "+":
            if found := PHONE.match(text, at):
                if 8 <= sum("0" <= c <= "9" for c in found.group()) <= 15:
                    spans["phone"].append(found.span())
        elif kind == "cue":
            if at >= secret_end and (sign := SECRET_SIGN.match(text, last + 1)) and sign.end() >= value_end and (found := SECRET.match(text, sign.end())):
                value, value_end = found.group(), found.end()
                if any("0" <= c <= "9" for c in value) and any(c.isalpha() for c in value):
                    spans["secret"].append((found.start(), secret_end := value_end))
        elif kind == "key":
            if at >= secret_end and last + 1 >= key_end and not (at and text[at - 1].isalnum()) and (found := KEY_TAIL.match(text, last + 1)):
                key_end = found.end()
                if any("0" <= c <= "9" for c in found.group()):
                    spans["secret"].append((at, secret_end := key_end))
        elif found := LOGIN.match(text, at):
            start = at
            while start and text[start - 1].isascii() and text[start - 1].isalpha():
                start -= 1
            if start < at:
                spans["url"].append((start, found.end()))
    return [(kind, start, end) for kind in KINDS for start, end in spans[kind]]


def masked(text: str | None, mark: str = "<{}>") -> str | None:
    """The text with every span replaced by its kind; overlapping spans become one, named after the first longest."""
    spans = sorted(((start, -end, kind) for kind, start, end in find(text)))
    if not spans:
        return text
    out, at, i = [], 0, 0
    while i < len(spans):
        start, end, kind = spans[i][0], -spans[i][1], spans[i][2]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, -spans[i][1])
            i += 1
        out += [text[at:start], mark.format(kind.upper())]
        at = end
    return "".join([*out, text[at:]])


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])


def spans(df: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", name: str = "spans") -> DataFrame:
    """`keep` and the array of spans of each row's whole text."""
    def run(texts: pa.Array) -> list[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        return [pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in find(t.as_py())] for t in texts], kind)]

    return with_made(df, keep, text, {name: T.ArrayType(SPAN)}, run)


def mask(df: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns with personal data in `text` replaced by its kind."""
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, place):
            clean = pa.array([masked(t.as_py()) for t in batch.column(place)], batch.schema.field(place).type)
            yield batch.set_column(place, batch.schema.field(place), clean)

    return df.mapInArrow(run, df.schema)


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, their digest, and all spans as text."""
    def lines(kinds: tuple[str, ...]):
        own = F.filter("spans", lambda s: s["kind"].isin(*kinds))
        return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, BASE_KINDS), F.sha2(lines(BASE_KINDS).cast("binary"), 256).alias("base_sha256"), lines(KINDS).alias("spans"))


@query("op9_pii")
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    return digest(spans(documents(spark, folder)))
