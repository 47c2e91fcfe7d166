"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.llm.slices import text_slices

# The four base kinds, in the order spans are listed, then the added ones.
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "local_phone", "national_id")
KINDS = BASE + ADDED

# A base match passes its own check and stays whatever its score; an added one needs the threshold.
THRESHOLD = 0.7
PRIOR = {"email": 0.9, "ip": 0.8, "card": 0.8, "phone": 0.7, "iban": 0.8, "local_phone": 0.4, "national_id": 0.4}
NEAR, BOOST = 40, 0.35

# Words near a span that speak for its kind.
CONTEXT = {
    "email": r"e-?mail|contact|correo|courriel",
    "ip": r"ip|address|host|server",
    "card": r"card|credit|visa|mastercard|carte|karte|tarjeta",
    "phone": r"phone|call|tel|mobile|fax|telefon|téléphone|teléfono",
    "iban": r"iban|account|bank|konto|compte|cuenta",
    "local_phone": r"phone|call|tel|mobile|fax|telefon|téléphone|teléfono",
    "national_id": r"ssn|social security|tax id|passport|national id",
}
CONTEXT_PATTERNS = {kind: re.compile(rf"(?<!\w)(?:{words})(?!\w)", re.IGNORECASE) for kind, words in CONTEXT.items()}

LOCAL_PART = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
LOCAL_PHONE = re.compile(r"(?<![\w+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![\w-])")
NATIONAL_ID = re.compile(r"(?<![\w-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![\w-])")
NOT_DIGIT = re.compile(r"[^0-9]+")
# Characters of an account number by country.
IBAN_SIZES = {country: int(size) for size, countries in (part.split(":") for part in (
    "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA "
    "23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM "
    "28:AL,AZ,BY,CY,DO,GT,HN,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU"
).split()) for country in countries.split(",")}
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Whether the weighted digit sum is a multiple of ten."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def mod97(code: str) -> bool:
    """Whether an account number's check digits hold: letters as two-digit numbers, remainder 1."""
    code = code.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Found from each @ outwards, so that a long run without one is not tried from each of its places."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > done and text[start - 1] in LOCAL_CHARS:
                start -= 1
            if start < at:
                yield start, domain.end()
                done = domain.end()
        at = text.find("@", max(at + 1, done))


def _byte_sized(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _base(text: str) -> Iterator[tuple[str, int, int]]:
    for start, end in _emails(text):
        yield "email", start, end
    for m in IP.finditer(text):
        if all(map(_byte_sized, m[0].split("."))):
            yield "ip", *m.span()
    for m in CARD.finditer(text):
        # the shortest match has 13 characters, the longest 19 digits and a separator between any two
        if 13 <= m.end() - m.start() <= 37:
            digits = NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield "card", *m.span()
    for m in PHONE.finditer(text):
        if 9 <= sum(map(m[0].count, "0123456789")) <= 15:
            yield "phone", *m.span()


def _iban_end(run: str) -> int:
    """Where the account number ends that a run of groups starts with, 0 if with none.

    A run can hold words and numbers that follow. The number ends where its
    country's size does, or else with the run; that of an unknown country may end
    with any group.
    """
    ends = [i for i, c in enumerate(run) if c == " "] + [len(run)]
    size = {end: end - spaces for spaces, end in enumerate(ends)}
    known = IBAN_SIZES.get(run[:2])
    tried = [end for end in reversed(ends) if known in (None, size[end])] + [len(run)] * (known is not None)
    return next((end for end in tried if 15 <= size[end] <= 34 and mod97(run[:end])), 0)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """A run without one is tried again from its next group on."""
    m = IBAN.search(text)
    while m:
        end = m.start() + _iban_end(m[0])
        if end > m.start():
            yield m.start(), end
        m = IBAN.search(text, max(end, m.start() + 1))


def _added(text: str) -> Iterator[tuple[str, int, int]]:
    for start, end in _ibans(text):
        yield "iban", start, end
    for m in LOCAL_PHONE.finditer(text):
        yield "local_phone", *m.span()
    for m in NATIONAL_ID.finditer(text):
        yield "national_id", *m.span()


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - NEAR) : start] + "\n" + text[end : end + NEAR]
    return min(1.0, PRIOR[kind] + BOOST * bool(CONTEXT_PATTERNS[kind].search(near)))


def find(text: str | None) -> list[Span]:
    """All spans by kind as listed, then start, in code points with the end exclusive.

    An added span that lies over another found before it is left out.
    """
    if not text:
        return []
    spans = [Span(kind, a, b, _score(text, kind, a, b)) for kind, a, b in _base(text)]
    taken = bytearray()
    for kind, a, b in _added(text):
        if not taken:
            taken = bytearray(len(text))
            for s in spans:
                taken[s.start : s.end] = b"\x01" * (s.end - s.start)
        score = _score(text, kind, a, b)
        if score >= THRESHOLD and not any(taken[a:b]):
            taken[a:b] = b"\x01" * (b - a)
            spans.append(Span(kind, a, b, score))
    return spans


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with each stretch covered by spans replaced by the first span's kind in angle brackets."""
    if not spans:
        return text
    out, done = [], 0
    for span in sorted(spans, key=lambda s: (s.start, -s.end)):
        if span.start >= done:
            out += [text[done : span.start], f"<{span.kind.upper()}>"]
        done = max(done, span.end)
    return "".join([*out, text[done:]])


SPAN = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType()),
]))
SPAN_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
)


def with_personal_data(docs: DataFrame, text_col: str = "text", spans_col: str = "spans", redacted_col: str | None = None) -> DataFrame:
    """Add the spans of each whole text and, where a column is named for it, the text without them.

    A null or empty text has none and stays as it is. Columns of the names given
    are replaced; ``redacted_col`` may be the text column itself. One pass, no shuffle.
    """
    others = [c for c in docs.columns if c not in (spans_col, redacted_col) or c == text_col]
    text_at = others.index(text_col)
    kept = [i for i, c in enumerate(others) if c != redacted_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_at):
            texts = batch.column(text_at).to_pylist()
            found = [find(t) for t in texts]
            columns = [batch.column(i) for i in kept]
            names = [others[i] for i in kept]
            columns.append(pa.array([[s._asdict() for s in spans] for spans in found], SPAN_ARROW))
            names.append(spans_col)
            if redacted_col:
                columns.append(pa.array(map(redact, texts, found), pa.string()))
                names.append(redacted_col)
            yield pa.RecordBatch.from_arrays(columns, names)

    fields = [docs.schema[others[i]] for i in kept] + [T.StructField(spans_col, SPAN)]
    if redacted_col:
        fields.append(T.StructField(redacted_col, T.StringType()))
    return docs.select(*[F.col(f"`{c}`") for c in others]).mapInArrow(run, T.StructType(fields))
