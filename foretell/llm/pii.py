"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score.

Base kinds, leftmost matches that do not overlap within a kind; a match that fails is dropped
and not tried again at another length:
  email   local part, ``@`` and a domain of at least two labels
  ip      four numbers of at most 255
  card    16 to 19 digits, single blanks or hyphens between them, that pass Luhn
  phone   ``+`` and 8 to 15 digits
Further kinds, kept only if their score reaches ``THRESHOLD``; spans that overlap a base span
or an earlier one of these are dropped:
  iban          country, check digits and account that pass mod-97
  ipv6          groups of hexadecimal digits that form an address
  national_id   ddd-dd-dddd with parts that are issued
  local_phone   ten digits grouped as a telephone number
A kind starts at ``PRIOR`` and gains ``CHECKED`` if a checksum holds (without it, iban is no
span at all). A word of the kind within ``NEAR`` code points before or half as many behind
adds ``HELPS``; a word that speaks against it takes ``HINDERS``. So iban and ipv6 stand by
themselves, while national_id and local_phone need a word that names them.
Base spans always stay, whatever their score.

Matching is linear in the text: each pattern starts at a character that no earlier attempt of
it has read through. Offsets are code points, ends exclusive. A null text is empty; an empty
one has no spans. Rows without id or with a repeated id give a row each; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from bisect import bisect_left
from typing import NamedTuple

from pyspark.sql import DataFrame

from foretell.llm.common import map_texts, texts_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ipv6", "national_id", "local_phone")
THRESHOLD, CHECKED, HELPS, HINDERS, NEAR = 0.5, 0.4, 0.35, 0.3, 48
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.4, "phone": 0.6, "iban": 0.4, "ipv6": 0.6, "national_id": 0.25, "local_phone": 0.25}
_HELP = {
    "email": "email e-mail mail contact correo courriel kontakt",
    "ip": "ip host server address client adresse dirección serveur",
    "card": "card credit visa mastercard amex payment karte kreditkarte carte tarjeta",
    "phone": "phone tel telephone call mobile fax telefon téléphone teléfono móvil handy",
    "iban": "iban account bank konto compte cuenta bic",
    "ipv6": "ip ipv6 host server address",
    "national_id": "ssn social security sozialversicherung taxpayer",
    "local_phone": "phone tel telephone call mobile fax cell telefon téléphone teléfono",
}
_HINDER = {
    "ip": "version release section chapter",
    "card": "order isbn invoice tracking serial",
    "phone": "order isbn invoice",
    "national_id": "part model isbn order serial",
    "local_phone": "part model isbn order serial invoice",
}
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*|ipv6")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a run of digits is read once: a match begins where a run does and takes it whole
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:.])")
_NATIONAL = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")
_PHONE_HERE = re.compile(r"(?<![0-9A-Za-z(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])")
_NOT_DIGITS = re.compile("[^0-9]+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Every second digit from the right is doubled; the digits of all numbers sum to a multiple of ten."""
    total = sum(map(int, digits[-1::-2]))
    for digit in digits[-2::-2]:
        total += sum(divmod(2 * int(digit), 10))
    return total % 10 == 0


def mod97(account: str) -> bool:
    """An IBAN, its first four characters moved behind the others and letters read as 10 to 35, leaves 1."""
    rest = 0
    for char in account[4:] + account[:4]:
        value = int(char, 36)
        rest = (rest * (100 if value > 9 else 10) + value) % 97
    return rest == 1


def _emails(text: str):
    free = 0
    for found in _DOMAIN.finditer(text):
        at = begun = found.start()
        while begun > free and text[begun - 1] in _LOCAL:
            begun -= 1
        if begun < at:
            free = found.end()
            yield begun, free


def _ips(text: str):
    for found in _IP.finditer(text):
        parts = [part.lstrip("0") for part in found.group().split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            yield found.span()


def _cards(text: str):
    for found in _CARD.finditer(text):
        # shorter matches cannot hold 16 digits
        if found.end() - found.start() >= 16:
            digits = _NOT_DIGITS.sub("", found.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield found.span()


def _phones(text: str):
    for found in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGITS.sub("", found.group())) <= 15:
            yield found.span()


def _ibans(text: str):
    for found in _IBAN.finditer(text):
        whole, end = found.group(), len(found.group())
        # words behind an account may look like part of it; it ends before a blank then
        while end > 0:
            account = whole[:end].replace(" ", "")
            if 15 <= len(account) <= 34 and mod97(account):
                yield found.start(), found.start() + end
                break
            end = whole.rfind(" ", 0, end)


def _ipv6s(text: str):
    for found in _IPV6.finditer(text):
        try:
            ipaddress.IPv6Address(found.group())
        except ValueError:
            continue
        if len(found.group()) > 6:
            yield found.span()


def _national_ids(text: str):
    for found in _NATIONAL.finditer(text):
        area, group, serial = found.group().split("-")
        if area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000":
            yield found.span()


def _local_phones(text: str):
    return (found.span() for found in _PHONE_HERE.finditer(text))


#: By kind: the characters one of which a text must hold, the proposals, whether a checksum confirms them.
_PROPOSE = {
    "email": ("@", _emails, False),
    "ip": (".", _ips, False),
    "card": ("", _cards, True),
    "phone": ("+", _phones, False),
    "iban": ("", _ibans, True),
    "ipv6": (":", _ipv6s, False),
    "national_id": ("-", _national_ids, False),
    "local_phone": ("", _local_phones, False),
}
_HELPERS = {kind: frozenset(words.split()) for kind, words in _HELP.items()}
_HINDERERS = {kind: frozenset(words.split()) for kind, words in _HINDER.items()}
_NO_WORDS: frozenset = frozenset()


def score(text: str, kind: str, start: int, end: int, checked: bool) -> float:
    """Between 0 and 1, from the kind, its checksum and the words nearby."""
    low, high = max(0, start - NEAR), min(len(text), end + NEAR // 2)
    near = {*_WORD.findall(text[low:start].lower()), *_WORD.findall(text[end:high].lower())}
    value = PRIOR[kind] + (CHECKED if checked else 0.0)
    value += HELPS if near & _HELPERS[kind] else 0.0
    value -= HINDERS if near & _HINDERERS.get(kind, _NO_WORDS) else 0.0
    return round(min(1.0, max(0.0, value)), 4)


_DIGIT = re.compile("[0-9]")


def _apart(spans: list[Span], taken: list[tuple[int, int]]) -> list[Span]:
    """Those that overlap none of the stretches, which come in order and apart from each other."""
    starts = [start for start, _ in taken]
    found = []
    for span in spans:
        n = bisect_left(starts, span.end)
        if not n or taken[n - 1][1] <= span.start:
            found.append(span)
    return found


def _covered(spans: list[Span]) -> list[tuple[int, int]]:
    """The stretches that spans cover, in order and apart from each other."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s.start, s.end) for s in spans):
        if out and start < out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def find(text: str) -> list[Span]:
    """All spans, by kind in the order of ``KINDS``, then start."""
    digits = _DIGIT.search(text) is not None
    found: list[Span] = []
    for kind, (needs, propose, checked) in _PROPOSE.items():
        if (needs and needs not in text) or not (digits or kind in ("email", "ipv6")):
            continue
        spans = [Span(kind, start, end, score(text, kind, start, end, checked)) for start, end in propose(text)]
        if spans and kind not in BASE:
            spans = _apart([span for span in spans if span.score >= THRESHOLD], _covered(found))
        found += spans
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def pii_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the spans with their scores, one row for each row."""

    def work(text):
        return ([span._asdict() for span in find(text)],)

    schema = "spans array<struct<kind: string, start: bigint, end: bigint, score: double>>"
    return map_texts(texts_of(df, id_col, text_col), lambda: work, schema)


def redact(text: str, spans: list[Span]) -> str:
    """The text with a placeholder like ``<email>`` for each stretch that spans cover, named after its first one."""
    parts, at = [], 0
    for span in sorted(spans, key=lambda s: (s.start, -s.end)):
        if span.start >= at:
            parts += [text[at : span.start], f"<{span.kind}>"]
        at = max(at, span.end)
    return "".join([*parts, text[at:]])


def redacted(df: DataFrame, least: float = 0.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the text without the spans that score at least ``least``."""

    def work(text):
        return (redact(text, [span for span in find(text) if span.score >= least]),)

    return map_texts(texts_of(df, id_col, text_col), lambda: work, "text string")


def pii_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base spans counted by kind and as a digest, and all spans as ``kind:start:end``."""

    def work(text):
        spans = find(text)
        base = [span for span in spans if span.kind in BASE]
        counts = [sum(span.kind == kind for span in base) for kind in BASE]
        return (*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))

    columns = ", ".join(f"n_{kind} bigint" for kind in BASE)
    return map_texts(texts_of(df, id_col, text_col), lambda: work, f"{columns}, base_sha256 string, spans string")
