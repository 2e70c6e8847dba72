"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust a score.

Base kinds (email, ip, card, phone) follow fixed rules and always stay. Further kinds are kept if their score reaches
``THRESHOLD``: iban (ISO 13616 shape; mod-97 decides), ssn (three dashed groups; valid ranges, and context decides),
phone_local (dashed or dotted national numbers that no base span covers; context decides), secret (20 characters or more as
in keys and tokens; letters and digits mixed with enough entropy, and context decides).

Defined cases: null and empty texts have no spans; places are code points, the end is exclusive; repeated rows give
repeated results; leading zeros of an address's parts, however many, don't count; other columns are ignored; an empty table gives no rows. Every rule takes time in proportion to the
text, long digit runs included.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from lacuna.llm.text import doc_texts, mapped, with_texts

SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
BASE = ("email", "ip", "card", "phone")
MORE = ("iban", "ssn", "phone_local", "secret")
#: Score that a span of a further kind must reach; bits a character that a secret must have.
THRESHOLD, ENTROPY = 0.5, 2.8

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9-])")
SECRET = re.compile(r"(?<![A-Za-z0-9+/_=.@-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=@-])")
#: Words within WINDOW code points before a span, and what they add to its score.
WINDOW = 40
CONTEXT = {
    "iban": (re.compile(r"(?i)iban|account|bank|konto|compte|cuenta"), 0.2),
    "ssn": (re.compile(r"(?i)\bssn\b|social|security|tax"), 0.5),
    "secret": (re.compile(r"(?i)token|secret|passw|credential|bearer|auth|(?:api|access|private)[ _-]?key"), 0.4),
    "phone_local": (re.compile(r"(?i)tel|phone|call|mobile|fax|numéro|telefon|teléfono"), 0.4),
}
PRIOR = {"iban": 0.6, "ssn": 0.2, "phone_local": 0.2, "secret": 0.2}


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def entropy(text: str) -> float:
    """Bits a character of the text's own distribution."""
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def emails(text: str) -> list[tuple[int, int]]:
    """Each @ in turn: the longest run of local characters before it that no earlier match has taken, then a domain."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        i = at
        while i > free and text[i - 1] in LOCAL:
            i -= 1
        m = DOMAIN.match(text, at) if i < at else None
        if m:
            out.append((i, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free)
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    out: dict[str, list[tuple[int, int]]] = {"email": emails(text)}
    out["ip"] = [m.span() for m in IP.finditer(text) if all(len(q := p.lstrip("0")) <= 3 and int(q or "0") <= 255 for p in m[0].split("."))]
    out["card"] = []
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
    out["phone"] = [m.span() for m in PHONE.finditer(text) if 9 <= sum(map(m[0].count, "0123456789")) <= 15]
    return out


def score(kind: str, text: str, start: int, valid: bool) -> float:
    """Prior of the kind, more for a confirming word nearby, nothing if its validator fails."""
    if not valid:
        return 0.0
    words, weight = CONTEXT[kind]
    return PRIOR[kind] + (weight if words.search(text, max(0, start - WINDOW), start) else 0.0)


def all_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end), base kinds first, by start within a kind."""
    if not text:
        return []
    base = base_spans(text)
    out = [(k, a, b) for k in BASE for a, b in base[k]]
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in MORE}
    for m in IBAN.finditer(text):
        plain = m[0].replace(" ", "")
        if score("iban", text, m.start(), 15 <= len(plain) <= 34 and mod97(plain)) >= THRESHOLD:
            found["iban"].append(m.span())
    for m in SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if score("ssn", text, m.start(), area not in ("000", "666") and area < "900" and group != "00" and serial != "0000") >= THRESHOLD:
            found["ssn"].append(m.span())
    starts = [a for a, _ in base["phone"]]  # in order, and apart from each other
    for m in LOCAL_PHONE.finditer(text):
        i = bisect_right(starts, m.end() - 1)
        if not (i and base["phone"][i - 1][1] > m.start()) and score("phone_local", text, m.start(), True) >= THRESHOLD:
            found["phone_local"].append(m.span())
    for m in SECRET.finditer(text):
        mixed = any(map(str.isdigit, m[0])) and any(map(str.isalpha, m[0]))
        if mixed and score("secret", text, m.start(), entropy(m[0]) >= ENTROPY) >= THRESHOLD:
            found["secret"].append(m.span())
    return out + [(k, a, b) for k in MORE for a, b in found[k]]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def mask(text: str) -> str:
    """The text with each span, overlapping ones together, replaced by its first kind in angle brackets."""
    out, at = [], 0
    for kind, a, b in sorted(all_spans(text), key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]]) if out else text


def span_digests(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans of each document. Keys: SCHEMA."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                spans = all_spans(text.as_py())
                base = [s for s in spans if s[0] in BASE]
                rows.append((*(sum(s[0] == k for s in base) for k in BASE), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return mapped(doc_texts(docs), run, SCHEMA)


def mask_documents(docs: DataFrame) -> DataFrame:
    """docs with personal data masked in ``text`` and ``n_chars`` counted anew, if there is such a column. A null text stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column("text").to_pylist()
            new = [t if t is None else mask(t) for t in old]
            out = with_texts(batch, "text", pa.array(new, batch.schema.field("text").type))
            if "n_chars" in batch.schema.names:
                kind = batch.schema.field("n_chars").type
                counts = pa.array([c if a == b else len(b) for a, b, c in zip(old, new, batch.column("n_chars").to_pylist(), strict=True)], kind)
                out = with_texts(out, "n_chars", counts)
            yield out

    return mapped(docs, run, docs.schema)
