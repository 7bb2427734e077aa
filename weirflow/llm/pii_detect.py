"""Personal data in a text: where it stands, of what kind, and which entity it names."""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Iterator
from typing import NamedTuple


class Mention(NamedTuple):
    """A stretch of bytes, its kind, and the entity: the same for every way to write it."""

    start: int
    stop: int
    kind: str
    entity: str


_EMAIL = re.compile(rb"[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}")
_LOCAL = re.compile(rb"[A-Za-z0-9._%+-]{1,64}$")
_IP = re.compile(rb"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)")
_SSN = re.compile(rb"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_CARD = re.compile(rb"(?<![\w+])\d(?:[ -]?\d){12,18}(?!\w)")
_IBAN = re.compile(rb"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_PHONE = re.compile(
    rb"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|(?:\(\d{3}\) ?|\d{3}[-.])\d{3}[-.]\d{4})(?!\w)"
)
_CLOUD_KEY = re.compile(rb"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])")
_SECRET = re.compile(
    rb"(?i)(?<![a-z0-9])(?:password|passwd|pwd|token|secret|api[_-]?key)[\"']?\s{0,3}[:=]\s{0,3}[\"']?([^\s\"',;]{6,})"
)
_HEX = re.compile(rb"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![A-Za-z0-9])")

#: Titles and what they say about gender. Fixed values.
TITLES = {
    "Mr": "m", "Mister": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "x", "Prof": "x",
    "Herr": "m", "Herrn": "m", "Frau": "f", "Monsieur": "m", "Mme": "f", "Madame": "f", "Mlle": "f",
    "Señor": "m", "Señora": "f", "Señorita": "f", "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f",
}
#: Small words that stand within names. Fixed values.
PARTICLES = ("von", "van", "vom", "zu", "zum", "der", "den", "de", "del", "della", "di", "da", "do", "dos", "das", "du", "la", "le", "los", "y")

_GENDER = {title.casefold(): gender for title, gender in TITLES.items()}
_SPELT = sorted({*TITLES, *(title.upper() for title in TITLES)}, key=len, reverse=True)
_TITLE = re.compile("|".join(_SPELT).encode())
_SMALL = {*PARTICLES, *(p.upper() for p in PARTICLES if len(p) > 1)}
_TITLED = re.compile(rf"(?<!\w)({'|'.join(_SPELT)})\b\.?[ \u00a0]")
#: A word, the full stop behind it, and what leads on to the next word.
_NEXT = re.compile(r"([^\W\d_][\w'’-]*)(\.?)([ \u00a0-]?)")
_WORD = re.compile(r"[^\W\d_][\w'’-]*")
#: What stands between an initial and the name that goes on behind it.
_AFTER_INITIAL = re.compile(r"\.[ \u00a0-]?")


def _digits(data: bytes) -> str:
    return "".join(chr(c) for c in data if 48 <= c <= 57)


def _emails(data: bytes) -> Iterator[Mention]:
    at = data.find(b"@")
    while at >= 0:
        local = _LOCAL.search(data[max(0, at - 64) : at])
        found = _EMAIL.match(data, at - len(local[0])) if local else None
        if found:
            yield Mention(found.start(), found.end(), "email", found[0].decode().lower())
        at = data.find(b"@", max(at + 1, found.end() if found else 0))


def _numbers(data: bytes) -> Iterator[Mention]:
    for found in _IP.finditer(data):
        try:
            yield Mention(*found.span(), "ip", str(ipaddress.IPv4Address(found[0].decode())))
        except ValueError:
            pass  # no address: a part is over 255 or starts with 0
    for kind, pattern in (("ssn", _SSN), ("card", _CARD), ("phone", _PHONE)):
        for found in pattern.finditer(data):
            digits = _digits(found[0])
            if kind != "phone" or 7 <= len(digits) <= 15:
                yield Mention(*found.span(), kind, digits)
    for found in _IBAN.finditer(data):
        yield Mention(*found.span(), "iban", found[0].decode().replace(" ", ""))


def _secrets(data: bytes) -> Iterator[Mention]:
    for found in _CLOUD_KEY.finditer(data):
        yield Mention(*found.span(), "cloud_key", found[0].decode())
    for found in _HEX.finditer(data):
        yield Mention(*found.span(), "secret", found[0].decode())
    if b"=" in data or b":" in data:
        for found in _SECRET.finditer(data):
            value = found[1].rstrip(b".!?)]}>*#$%&")
            if len(value) >= 6:
                yield Mention(found.start(1), found.start(1) + len(value), "secret", value.decode("utf-8", "replace"))


def _name_behind(text: str, at: int) -> list[tuple[str, bool]]:
    """The words of the name that starts there, with whether each is an initial.

    A name goes on over initials and particles, and ends before a word in small
    letters or another title, or with a sign; it may have any number of words.
    """
    words: list[tuple[str, bool]] = []
    while (found := _NEXT.match(text, at)) is not None:
        word, stop, gap = found.groups()
        initial = len(word) == 1 and bool(stop)
        if word in _SMALL:
            if not gap or stop:
                break
        elif not word[0].isupper() or word.casefold() in _GENDER:
            break
        else:
            words.append((word, initial))
            if not initial and (stop or not gap):
                break
        at = found.end()
    return words


def _names(data: bytes) -> Iterator[Mention]:
    """Words after a title, and the same words wherever else they stand in the text.

    Initials are part of the name they lead up to, and mentions only there: a
    single letter that stands elsewhere is no name.
    """
    text = data.decode("utf-8", "replace")
    kinds: dict[str, str] = {}
    for found in _TITLED.finditer(text):
        words = _name_behind(text, found.end())
        for i, (word, initial) in enumerate(words):
            last = i == len(words) - 1
            if last or not initial:
                kinds.setdefault(word, "surname" if last else f"given_{_GENDER[found[1].casefold()]}")
    if not kinds:
        return
    place, at = 0, 0
    initials: list[re.Match[str]] = []
    for found in _WORD.finditer(text):
        if initials and not _AFTER_INITIAL.fullmatch(text, initials[-1].end(), found.start()):
            initials = []
        if found[0] not in kinds:
            initials = [*initials, found] if len(found[0]) == 1 and found[0].isupper() else []
            continue
        for part in [*initials, found]:
            at += len(text[place : part.start()].encode("utf-8", "replace"))
            size = len(part[0].encode())
            yield Mention(at, at + size, kinds.get(part[0], "given_x"), part[0].casefold())
            at, place = at + size, part.end()
        initials = []


def find_mentions(data: bytes | None) -> list[Mention]:
    """All mentions of a text in order; of those that overlap, the first and longest stays."""
    if not data:
        return []
    found = list(_emails(data)) if b"@" in data else []
    if re.search(rb"\d", data):
        found += _numbers(data)
    found += _secrets(data)
    if _TITLE.search(data):
        found += _names(data)
    found.sort(key=lambda m: (m.start, -m.stop))
    kept: list[Mention] = []
    for mention in found:
        if not kept or mention.start >= kept[-1].stop:
            kept.append(mention)
    return kept
