"""Personal data by anchor expansion: find cues with one automaton, parse around each of them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base kinds in the order of the contract, then those that cues add.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account", "iban")
DIGITS = "0123456789"
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
ACCOUNT_CUES = ("account", "acct", "konto", "compte", "cuenta", "passport", "ssn")
IBAN_CUES = ("iban",)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL_REST = re.compile(r"[^\s<>\"'`]+")
_ACCOUNT = re.compile(r"(?i:\s*(?:no|nr|number|id)\b\.?)?[\s:#=]{1,3}([A-Z]{0,2}[0-9](?:[ -]?[0-9]){4,16})(?![0-9A-Za-z])")
_IBAN = re.compile(r"[\s:#=]{1,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![0-9A-Za-z])")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    cues = [("@", "@"), ("+", "+"), *((d, "digit") for d in DIGITS), *((s, "url") for s in SCHEMES)]
    cues += [(c, "account") for c in ACCOUNT_CUES] + [(c, "iban") for c in IBAN_CUES]
    for cue, kind in cues:
        found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


AUTOMATON = _automaton()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = ord(d) - 48
        if i % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _digits(text: str) -> str:
    return text.replace(" ", "").replace("-", "")


def valid_ip(found: str) -> bool:
    parts = [part.lstrip("0") for part in found.split(".")]
    return all(len(part) <= 3 and int(part or "0") <= 255 for part in parts)


def valid_card(found: str) -> bool:
    digits = _digits(found)
    return 12 <= len(digits) <= 19 and luhn(digits)


def valid_phone(found: str) -> bool:
    return 9 <= sum(c in DIGITS for c in found) <= 15


def valid_iban(found: str) -> bool:
    plain = found.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of everything found, sorted.

    Each parser reads the characters around its cue once and in one direction, so that long runs cost
    their length. A match ends at or before the next cue of its kind that is looked at.
    """
    spans = []
    # Cues may be spelled in any case; a lower-cased text of the same length has the same places.
    lower = text.lower()
    if len(lower) != len(text):
        lower = text.translate(_LOWER)
    past_email = past_chain = past_card = past_phone = past_url = 0
    for last, (kind, length) in AUTOMATON.iter(lower):
        if kind == "digit":
            if last >= past_chain:
                # A chain of n dotted numbers holds n // 4 addresses, one after the other.
                chain = _CHAIN.match(text, last)
                past_chain, start = chain.end(), last
                parts = chain.group().split(".")
                for i in range(0, len(parts) - 3, 4):
                    four = ".".join(parts[i : i + 4])
                    if valid_ip(four):
                        spans.append((start, 1, start + len(four)))
                    start += len(four) + 1
            if last >= past_card:
                past_card = last + 1
                if m := _CARD.match(text, last):
                    past_card = m.end()
                    if past_card - last >= 12 and valid_card(m.group()):
                        spans.append((last, 2, past_card))
        elif kind == "@":
            begin = last
            while begin > past_email and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin < last and (m := _DOMAIN.match(text, last + 1)):
                past_email = m.end()
                spans.append((begin, 0, past_email))
        elif kind == "+":
            if last >= past_phone and (m := _PHONE.match(text, last)):
                past_phone = m.end()
                if valid_phone(m.group()):
                    spans.append((last, 3, past_phone))
        elif kind == "url":
            start = last + 1 - length
            if start >= past_url and (m := _URL_REST.match(text, last + 1)):
                past_url = last + 1 + len(m.group().rstrip(".,;:!?)]}"))
                if past_url > last + 1:
                    spans.append((start, 4, past_url))
        elif m := (_ACCOUNT if kind == "account" else _IBAN).match(text, last + 1):
            if kind == "account" or valid_iban(m.group(1)):
                spans.append((m.start(1), KINDS.index(kind), m.end(1)))
    return sorted(set(spans))


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for value in batch.column("text"):
            text = value.as_py()
            rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in find_spans(text)] if text else [])
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(rows, pa.list_(span))], names=["doc_id", "found"]
        )


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, found``: per document the spans (kind, start, end) of personal data, in code points, end
    exclusive, by start and then kind.

    Base kinds are matched leftmost and without overlap within a kind; matches that fail validation are
    dropped without another try. URLs, accounts after a cue word and valid IBANs after a cue are added and
    may overlap the others. Whole texts are searched, however long; a null or empty text has no spans. Rows are
    independent, repeated ones have the same spans each; an empty table gives an empty result.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _found, "doc_id long, found array<struct<kind: string, start: bigint, end: bigint>>"
    )


def _joined(spans: Column) -> Column:
    texts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(texts, ",")


def digests(found: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans as one string."""
    base = F.filter("found", lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in BASE_KINDS], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans")
    )
