"""Personal data: patterns propose spans, checksums confirm them, and words
close by move the score.

Kinds with a fixed meaning (``BASE``): email, ip, card, phone. Their spans are
always reported, the score only says how sure the finding is. The kinds of
``ADDED`` are reported from a score of ``min_score``:

* iban must pass mod-97, ssn (a national number) needs a context word;
* secret is a value assigned to a name like token or password; it must look
  random: ``RANDOM`` different characters, a digit among them;
* key has the prefix and length of a well-known kind of access key;
* private_key is a block between its BEGIN and END lines (or the text's end);
* url_login is the part of a URL that holds a user's name and password;
* ipv6 must be a valid address with at least three groups.

All work is per row, and every scan is linear in the text: possessive patterns
and look-behinds keep long runs of digits or name characters from being scanned
again from each of their characters.
"""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "secret", "key", "private_key", "url_login", "ipv6")
KINDS = BASE + ADDED
#: Different characters that the value of a secret has at least.
RANDOM = 10
#: Code points before a span in which context words count.
CONTEXT = 48

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NAME_END = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
# Names of secrets, prefixes and lengths of access keys.
_SECRET = re.compile(r"(?i:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential)"
                     r"[\"']?[\x20\t]{0,3}[:=][\x20\t]{0,3}[\"']?[A-Za-z0-9+/_=-]{16,}")
_VALUE = re.compile(r"[A-Za-z0-9+/_=-]{16,}\Z")
_KEY = re.compile(r"(?<![A-Za-z0-9_])(?:AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{60,90}|AIza[A-Za-z0-9_-]{35}|"
                  r"xox[abprs]-[A-Za-z0-9-]{10,80}|[rs]k_live_[A-Za-z0-9]{24,99}|glpat-[A-Za-z0-9_-]{20}|"
                  r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,})(?![A-Za-z0-9_])")
_BLOCK = re.compile(r"-----BEGIN (?:[A-Z]+\x20){0,3}PRIVATE KEY(?:\x20BLOCK)?-----")
_BLOCK_END = re.compile(r"-----END (?:[A-Z]+\x20){0,3}PRIVATE KEY(?:\x20BLOCK)?-----")
_LOGIN = re.compile(r"(?<=://)[^\s/:@\"'<>]{1,64}:[^\s/@\"'<>]{1,128}@")
_IPV6 = re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Fa-f:.])")
_HINTS = {
    "email": re.compile(r"mail|contact|write|@", re.I | re.ASCII),
    "ip": re.compile(r"\bip\b|address|host|server|login", re.I | re.ASCII),
    "card": re.compile(r"card|visa|master|credit|payment|cvv", re.I | re.ASCII),
    "phone": re.compile(r"phone|\btel\b|call|mobile|fax|contact", re.I | re.ASCII),
    "iban": re.compile(r"iban|account|bank|transfer", re.I | re.ASCII),
    "ssn": re.compile(r"\bssn\b|social|security|national", re.I | re.ASCII),
    "secret": re.compile(r"api|auth|login|config|env", re.I | re.ASCII),
    "key": re.compile(r"key|token|aws|secret", re.I | re.ASCII),
    "private_key": re.compile(r"key|ssh|pem", re.I | re.ASCII),
    "url_login": re.compile(r"https?|ftp|mongodb|postgres|mysql|redis|amqp", re.I | re.ASCII),
    "ipv6": re.compile(r"ipv6|address|host|server", re.I | re.ASCII),
}
#: Score of a bare match, after its checksum where the kind has one.
_PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3,
          "secret": 0.6, "key": 0.8, "private_key": 0.8, "url_login": 0.6, "ipv6": 0.5}
_DROP = str.maketrans("", "", " -().+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(code: str) -> bool:
    """Checksum of an IBAN without spaces: letters count 10 to 35."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > end and _NAME_END.match(text, first - 1):
            first -= 1
        if first < at and (m := _DOMAIN.match(text, at + 1)):
            yield first, m.end()
            end = m.end()
            at = text.find("@", end)
        else:
            end = at + 1  # "@" is in no name, so no match can start before it
            at = text.find("@", at + 1)


def proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans by kind, then start."""
    if "@" in text:
        yield from (("email", a, b) for a, b in _emails(text))
    for m in _IP.finditer(text):
        if all(len(x) < 4 and int(x or 0) <= 255 for x in (part.lstrip("0") for part in m[0].split("."))):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].translate(_DROP)
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield "card", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(m[0].translate(_DROP)) <= 15:
                yield "phone", *m.span()
    for m in _IBAN.finditer(text):
        code = m[0].replace(" ", "")
        if 15 <= len(code) <= 34 and mod97(code):
            yield "iban", *m.span()
    for m in _SSN.finditer(text):
        yield "ssn", *m.span()
    yield from _secrets(text)


def _secrets(text: str) -> Iterator[tuple[str, int, int]]:
    for m in _SECRET.finditer(text):
        value = _VALUE.search(m[0])[0]
        if len(set(value)) >= RANDOM and any("0" <= c <= "9" for c in value):
            yield "secret", *m.span()
    for m in _KEY.finditer(text):
        yield "key", *m.span()
    at = 0
    while "-----BEGIN" in text and (m := _BLOCK.search(text, at)):
        end = _BLOCK_END.search(text, m.end())
        at = end.end() if end else len(text)
        yield "private_key", m.start(), at
    if "://" in text:
        for m in _LOGIN.finditer(text):
            yield "url_login", *m.span()
    if ":" in text:
        for m in _IPV6.finditer(text):
            if sum(map(bool, m[0].split(":"))) >= 3 and _is_ipv6(m[0]):
                yield "ipv6", *m.span()


def _is_ipv6(text: str) -> bool:
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return True


def spans(text: str | None, min_score: float = 0.5) -> list[dict]:
    found = []
    for kind, start, end in proposals(text or ""):
        near = text[max(0, start - CONTEXT):start]
        score = min(1.0, _PRIOR[kind] + 0.2 * bool(_HINTS[kind].search(near)) + 0.1 * (kind == "ssn" and bool(_HINTS[kind].search(near))))
        if kind in BASE or score >= min_score:
            found.append({"kind": kind, "start": start, "end": end, "score": score})
    return found


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = 0.5) -> DataFrame:
    """One row per document: its id and ``pii``, an array of (kind, start, end,
    score) ordered by kind as in ``KINDS``, then start; code points, end
    exclusive.

    A null or empty text has no spans. Repeated rows are treated one by one;
    other columns are not read, so their names cannot clash. Overlaps between
    kinds are all reported.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [spans(t, min_score) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(found, _SPANS)], names=["id", "pii"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, pii array<struct<kind:string,start:bigint,end:bigint,score:double>>")
            .withColumnRenamed("id", id_col))


def redact(docs: DataFrame, text_col: str = "text", min_score: float = 0.5) -> DataFrame:
    """``docs`` with every span replaced by ``<KIND>``; overlapping spans become
    one replacement named after the first. Null texts stay null."""
    def clean(text: str | None) -> str | None:
        if text is None:
            return None
        out, end = [], 0
        for s in sorted(spans(text, min_score), key=lambda x: (x["start"], -x["end"])):
            if s["start"] >= end:
                out += [text[end:s["start"]], f"<{s['kind'].upper()}>"]
            end = max(end, s["end"])
        return "".join([*out, text[end:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array([clean(t) for t in b.column("text").to_pylist()], pa.string())],
                names=["row", "text"])

    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text"))
    done = whole.mapInArrow(run, whole.schema)
    return done.select(*(F.col("text" if c == text_col else f"row.`{c}`").alias(c) for c in docs.columns))
