"""Plans, or transforms of text, that need nothing but built-in expressions.

``lower`` gives a guard and an expression for a plan: rows for which the guard holds convert by built-in functions
alone. Beyond ASCII a conversion from UTF-8 to UTF-8 isn't an identity (characters pass the code tables), so the
guard asks for ASCII. The text functions below are for text known to be Unicode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.plan import Plan
from .transform import FULL, SIGNS, WITH_HALF_VOICE, WITH_VOICE

#: Of ASCII text, these make no difference or are built-in.
UNICODE_TARGETS = ("utf8", "utf16", "utf32")


def lower(data: Column, plan: Plan) -> tuple[Column, Column] | None:
    p = plan.settled()
    family = p.source.family if p.source else None
    if family in ("utf16", "utf32") or p.fold or p.mime_out or p.mime in ("B", "Q") or p.cap or p.url or p.numchar or p.broken or p.strict_jis or p.escapes:
        return None
    text = F.decode(data, "ISO-8859-1")
    unsafe = "[^\\x00-\\x7F]|[\\x0E\\x0F\\x1B]" + ("|=\\?" if p.mime != "off" else "")
    guard = ~F.coalesce(text.rlike(unsafe), F.lit(False))
    if p.width & 8:
        for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            text = F.replace(text, F.lit(sign), F.lit(entity))
    if p.rot:
        text = rot13(text)
    if p.eol:
        text = eol(text, p.eol.decode())
    bom = {("utf8", False): b"\xef\xbb\xbf", ("utf16", False): b"\xfe\xff", ("utf16", True): b"\xff\xfe", ("utf32", False): b"\0\0\xfe\xff", ("utf32", True): b"\xff\xfe\0\0"}
    target = p.target.family
    if target == "utf32" and p.out_little:
        return None
    codec = {"utf16": "UTF-16LE" if p.out_little else "UTF-16BE", "utf32": "UTF-32"}.get(target, "US-ASCII")
    out = F.encode(text, codec)
    if p.bom:
        out = F.concat(F.lit(bom[target, p.out_little]), out)
    return guard, out


def eol(text: Column, to: str) -> Column:
    return F.regexp_replace(text, "\r\n|\r|\n", to)


def rot13(text: Column) -> Column:
    low, high = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, low + high, low[13:] + low[:13] + high[13:] + high[:13])


#: Full-width letters and signs, and their ASCII.
WIDE = "".join(chr(c + 0xFEE0) for c in range(0x30, 0x7B) if chr(c).isalnum()) + "".join(SIGNS)
NARROW = "".join(chr(c) for c in range(0x30, 0x7B) if chr(c).isalnum()) + "".join(SIGNS.values())


def narrow(text: Column) -> Column:
    """-Z: full-width letters, digits and signs to ASCII."""
    return F.translate(text, WIDE, NARROW)


def wide_blank(text: Column, blanks: int) -> Column:
    """-Z1 and -Z2: the ideographic space to one or two blanks."""
    return F.replace(text, F.lit("　"), F.lit(" " * blanks))


def html_escape(text: Column) -> Column:
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(sign), F.lit(entity))
    return text


HALF = "".join(chr(0xFF61 + k) for k in range(len(FULL)))
_half = dict(zip(FULL, HALF, strict=True))


def full_kana(text: Column) -> Column:
    """-X: half-width kana to full width, those before a sound mark with it."""
    for marks, mark in ((WITH_VOICE, "ﾞ"), (WITH_HALF_VOICE, "ﾟ")):
        for plain, voiced in marks.items():
            text = F.replace(text, F.lit(_half[plain] + mark), F.lit(voiced))
    return F.translate(text, HALF, FULL)


def half_kana(text: Column) -> Column:
    """-Z4: full-width kana and their punctuation to half width."""
    for marks, mark in ((WITH_VOICE, "ﾞ"), (WITH_HALF_VOICE, "ﾟ")):
        for plain, voiced in marks.items():
            text = F.replace(text, F.lit(voiced), F.lit(_half[plain] + mark))
    return F.translate(text, FULL, HALF)


HIRAGANA = "".join(chr(c) for c in range(0x3041, 0x3094)) + "ゝゞ"
KATAKANA = "".join(chr(c) for c in range(0x30A1, 0x30F4)) + "ヽヾ"


def hiragana(text: Column) -> Column:
    return F.translate(text, KATAKANA + "ヴ", HIRAGANA + "ゔ")


def katakana(text: Column) -> Column:
    return F.translate(text, HIRAGANA + "ゔ", KATAKANA + "ヴ")


def swap_kana(text: Column) -> Column:
    return F.translate(text, HIRAGANA + "ゔ" + KATAKANA + "ヴ", KATAKANA + "ヴ" + HIRAGANA + "ゔ")
