"""Which encoding 8-bit text is in: candidates are dropped where they fail, and the least bad survivor is taken."""

from __future__ import annotations

import re

from .once import once
from .tables import G3, from_sjis, jis_to_unicode, unicode_to_jis

#: What makes a candidate less likely, the higher the bit the worse.
LEVEL2, HALF_KANA, VENDOR, IBM, X0212, X0213, MISSING, UNMARKED, FAILED = (1 << k for k in range(9))
#: Marks of plane-1 rows 0x20 to 0x2F and 0x70 to 0x7F, and of plane-2 rows by their low digit.
ROWS_2 = [0] * 9 + [VENDOR] * 6 + [X0213]
ROWS_7 = [LEVEL2] * 5 + [VENDOR, X0213, X0213, VENDOR, VENDOR, IBM, IBM, IBM, X0213, X0213, FAILED]
PLANE2 = {
    2: [0, X0213, X0212, X0213, X0213, X0213, X0212, X0212, X0213, X0212, X0212, X0212, X0213, X0213, X0213, X0213],
    6: [X0212] * 14 + [X0213] * 2,
    7: [X0213] * 3 + [X0212] * 2 + [X0213] * 11,
}

#: How much text is looked at before a choice is made.
HOLD = 2048
CHARS = {
    "euc": rb"[\x8e\xa1-\xfe][\xa1-\xfe]|\x8f[\xa1-\xfe][\xa1-\xfe]",
    "sjis": rb"[\xa1-\xdf]|[\x81-\x9f\xe0-\xea\xed\xee\xf0-\xfc][\x40-\x7e\x80-\xfc]",
    "utf8": rb"[\xc0-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}",
}
WHOLE = {k: re.compile(rb"(?:[\x00-\x7f]++|%b)*+" % v) for k, v in CHARS.items()}
BEYOND_ASCII = re.compile(rb"[\x80-\xff]")
EACH = {k: re.compile(v) for k, v in CHARS.items()}
#: What may still become a character.
PARTIAL = {
    "euc": re.compile(rb"[\x8e\xa1-\xfe]|\x8f[\xa1-\xfe]?"),
    "sjis": re.compile(rb"[\x81-\x9f\xe0-\xea\xed\xee\xf0-\xfc]"),
    "utf8": re.compile(rb"[\xc0-\xdf]|[\xe0-\xef][\x80-\xbf]?|[\xf0-\xf4][\x80-\xbf]{0,2}"),
}
NAMES = {"euc": "EUC-JP", "sjis": "Shift_JIS", "utf8": "UTF-8", "jis": "ISO-2022-JP", "utf16": "UTF-16", "utf32": "UTF-32", "ascii": "ASCII"}


def _plane1(code: int) -> int:
    row = code >> 8 & 0x7F
    if (code & 0x7F7F) not in jis_to_unicode("ascii"):
        return MISSING
    high, low = row >> 4, row & 15
    return ROWS_2[low] if high == 2 else ROWS_7[low] if high == 7 else LEVEL2 if high >= 5 else 0


def mark(kind: str, char: bytes) -> int:
    """How unlikely a character is."""
    if kind == "euc":
        if char[0] == 0x8E:
            return HALF_KANA
        if char[0] == 0x8F:
            return PLANE2.get(char[1] >> 4 & 7, [X0212] * 16)[char[1] & 15]
        return _plane1((char[0] & 0x7F) << 8 | char[1] & 0x7F)
    if kind == "sjis":
        if len(char) == 1:
            return HALF_KANA
        if char[0] in (0xED, 0xEE) or char[0] >= 0xFA:
            return IBM
        return _plane1(from_sjis(*char))
    if len(char) == 4 or char == b"\xef\xbb\xbf":
        return 0
    u = ord(char.decode("utf-8", "replace")[0])
    code = unicode_to_jis("ascii", True, True).get(u)
    if code is None:
        return MISSING
    if code >= G3:
        return PLANE2.get(code >> 12 & 7, [X0212] * 16)[code >> 8 & 15] if code < 0x900000 else HALF_KANA
    return _plane1(code) if code >= 0x2121 else 0


@once
def known_marks(kind: str) -> dict[bytes, int]:
    """The marks of characters that the worker process has met."""
    return {}


def marks(kind: str, data: bytes) -> int:
    out, met = 0, known_marks(kind)
    for char in set(EACH[kind].findall(data)):
        if (m := met.get(char)) is None:
            m = met[char] = mark(kind, char)
        out |= m
    return out


def choose(data: bytes, start: int) -> str:
    """The candidate for 8-bit text at ``start``: the only one left, or that with the least marks (EUC, SJIS, UTF-8 at ties)."""
    end = min(len(data), start + HOLD)
    if (escape := data.find(b"\x1b", start, end)) >= 0:
        end = escape
    held = data[start:end]
    reach = {}
    for kind, pattern in WHOLE.items():
        at = pattern.match(held).end()
        rest = PARTIAL[kind].match(held, at)
        reach[kind] = len(held) if at == len(held) or (rest and rest.end() == len(held)) else at
    left = [k for k, at in reach.items() if at == len(held)]
    if len(left) == 1:
        return left[0]
    longest = max(reach.values())
    lone = [k for k, at in reach.items() if at == longest]
    if not left and len(lone) == 1 and sorted(reach.values())[1] < longest:
        return lone[0]
    scores = {k: marks(k, held[: reach[k]]) | (FAILED if reach[k] < len(held) else 0) for k in reach}
    return min(scores, key=lambda k: scores[k])


def refined(name: str | None, marks_seen: int) -> str:
    """The name that is told, from the family's name and what characters were seen."""
    if name is None:
        return "ASCII"
    if name == "":
        return "BINARY"
    if name == "Shift_JIS" and marks_seen & (VENDOR | IBM):
        return "CP932"
    if name == "EUC-JP":
        if marks_seen & X0213:
            return "EUC-JIS-2004"
        if marks_seen & X0212:
            return "EUCJP-MS"
        if marks_seen & (VENDOR | IBM):
            return "CP51932"
    if name == "ISO-2022-JP":
        if marks_seen & HALF_KANA:
            return "CP50221"
        if marks_seen & (VENDOR | IBM):
            return "CP50220"
    return name


