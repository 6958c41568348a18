"""Conversion character by character, for plans and documents in which no character depends on another.

Most documents are valid text of one encoding, without escapes, encoded words or numbered characters. There every
character converts alike wherever it stands (a carriage return before a line feed, and half-width kana before a
sound mark, being one character). So a worker process keeps a table for each plan, filled by the kernel's own steps as
characters turn up, and a document is a decoding, a translation and an encoding in C. All other documents are
left to the kernel's whole-document path: the functions here return None for them.
"""

from __future__ import annotations

import re
from itertools import groupby
from operator import itemgetter

from ..plans.plan import Plan
from . import detect
from .decode import BOMS, EIGHT_BIT, text_codes
from .encode import _user, euc_bytes, known, sjis_bytes, to_text
from .once import once
from .tables import G3, KANA, LATIN, UNICODE, combined
from .transform import HALF_VOICED, VOICED, kana_tables, transform

CODECS = {"utf8": "utf-8", "utf16": ("utf-16-be", "utf-16-le"), "utf32": ("utf-32-be", "utf-32-le")}
TOKENS = {"sjis": rb"[\x00-\x80\xa0-\xdf\xfd-\xff]|[\x80-\xff].", "euc": rb"[\x00-\x7f]|\x8f..|[\x80-\xff]."}
BEYOND_ASCII = re.compile("[^\x00-\x7f]+")


class Filled(dict):
    """A table whose entries are made when they are asked for."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        made = self[key] = self.make(key)
        return made


def simple(plan: Plan) -> bool:
    """Whether a settled plan can be followed character by character."""
    return not (plan.cap or plan.url or plan.nfc or plan.broken or plan.fold or plan.mime_out or plan.latin or plan.mime in ("B", "Q") or plan.no_output)


def payload(data: bytes, plan: Plan) -> tuple[str, str | bytes] | None:
    """The family of a document that is plain text of one encoding, and its text, or its bytes if they are of two-byte codes."""
    if plan.mime in ("strict", "loose") and b"=?" in data or plan.numchar and b"&#" in data:
        return None
    family, little = plan.source.family if plan.source else None, plan.in_little
    if data[:1] in (b"\x00", b"\xfe", b"\xff", b"\xef"):
        for bom, kind, way in BOMS:
            if data.startswith(bom) and family in (None, kind):
                if way in ("2143", "3412"):
                    return None
                data, family, little = data[len(bom) :], kind, way == "little" if way else little
                break
    if family in ("utf16", "utf32"):
        unit = 2 if family == "utf16" else 4
        return family, data[: len(data) // unit * unit].decode(CODECS[family][little], "ignore")
    if b"\x1b" in data or b"\x0e" in data and family != "utf8":
        return None
    if data.isascii():
        return "ascii", data.decode("ascii")
    if family is None:
        at = detect.BEYOND_ASCII.search(data).start()
        family = detect.choose(data, at)
        if family == "utf8" and not detect.WHOLE[family].fullmatch(data):
            return None
    if family == "utf8":
        return family, data.decode("utf-8", "ignore")
    return (family, data) if family in TOKENS and detect.WHOLE[family].fullmatch(data) else None


class Converter:
    """A plan's tables: of scalars, of pairs of scalars, and of the bytes of characters."""

    def __init__(self, plan: Plan):
        self.plan = plan
        family = plan.target.family
        self.codec = CODECS.get(family, "latin-1")
        if isinstance(self.codec, tuple):
            self.codec = self.codec[plan.out_little]
        marks = {"utf-8": b"\xef\xbb\xbf", "utf-16-be": b"\xfe\xff", "utf-16-le": b"\xff\xfe", "utf-32-be": b"\0\0\xfe\xff", "utf-32-le": b"\xff\xfe\0\0"}
        self.mark = marks[self.codec] if plan.bom and family in CODECS else b""
        self.shifts = family == "jis"
        self.of_scalar = Filled(lambda u: self.out(text_codes(chr(u), plan)))
        self.of_text = Filled(lambda t: self.out(text_codes(t, plan)))
        self.of_bytes = {kind: Filled(lambda b, read=EIGHT_BIT[kind]: self.read(read(b, plan))) for kind in TOKENS}
        plain, pairs = {"sjis": lambda c: bytes((c & 0x7F | 0x80,)), "euc": lambda c: bytes((0x8E, c & 0x7F | 0x80))}, []
        if not plan.keep_kana:
            _, voiced, half_voiced, _ = kana_tables()
            pairs = [(c, VOICED) for c in voiced] + [(c, HALF_VOICED) for c in half_voiced]
        self.tokens = {kind: re.compile(b"|".join([re.escape(plain[kind](a) + plain[kind](b)) for a, b in pairs] + [TOKENS[kind]]), re.S) for kind in TOKENS}
        in_text = ["".join(chr(0xFF40 + (c & 0x7F)) for c in pair) for pair in pairs] + ([*combined().values()] if plan.x0213 else [])
        self.joined = re.compile("|".join(map(re.escape, in_text))) if in_text else None
        self.units = re.compile("|".join([*map(re.escape, in_text), "(?s:.)"]))
        self.same_ascii = not self.shifts and all(self.of_scalar[c] == chr(c) for c in range(128) if not (plan.eol and c in (10, 13)))

    def out(self, codes: list[int]):
        """What characters become: text of the target, or bytes as Latin-1, or (shift, bytes) where the target has shifts."""
        codes = transform(codes, self.plan)
        family = self.plan.target.family
        if family in CODECS:
            return to_text(codes, self.plan)
        codes = known(codes, self.plan)
        if not self.shifts:
            make = sjis_bytes if family == "sjis" else euc_bytes
            return b"".join(make(c, self.plan) for c in codes).decode("latin-1")
        units = [self.shift(c) for c in codes]
        units = [u for u in units if u[0]]
        if len({u[0] for u in units}) > 1:
            raise ValueError("a character in several shifts")
        return (units[0][0], b"".join(u[1] for u in units)) if units else ("", b"")

    def read(self, codes: list[int]):
        """Like ``out``; None for what isn't a character, and so would bring kana and a sound mark together."""
        return self.out(codes) if codes or self.plan.keep_kana else None

    def shift(self, c: int) -> tuple[str, bytes]:
        if c < 0x80:
            return "(", bytes((c,))
        if c >= UNICODE:
            return "$", _user(c & 0xFFFFFF, self.plan)
        if c >= LATIN:
            return ".", bytes((c & 0x7F | 0x80,))
        if c >= KANA:
            return "I", bytes((c & 0x7F,))
        if c >= G3:
            return "D", bytes((c >> 8 & 0x7F, c & 0x7F))
        fits = 0x20 <= c >> 8 <= (0x92 if self.plan.ucs_map != "ascii" else 0x7E) and 0x20 <= c & 0xFF <= 0x7E
        return ("$", bytes((c >> 8, c & 0xFF))) if fits else ("", b"")

    def shifted(self, units) -> bytes:
        """The bytes of (shift, bytes), with an escape where the shift changes."""
        p = self.plan
        plain = b"\x1b(" + p.ascii_in
        escapes = {"$": b"\x1b" + (b"$(Q" if p.x0213 else b"$" + p.kanji_in), "D": b"\x1b" + (b"$(P" if p.x0213 else b"$(D"), "I": b"\x1b(I"}
        out, mode = [], "("
        for now, run in groupby((u for u in units if u[0]), key=itemgetter(0)):
            if now in escapes:
                out.append(escapes[now])
            elif mode in escapes:
                out.append(plain)
            mode = now
            out.append(b"".join(map(itemgetter(1), run)))
        if mode in escapes:
            out.append(plain)
        return b"".join(out)

    def convert(self, data: bytes) -> bytes | None:
        if (found := payload(data, self.plan)) is None:
            return None
        family, text = found
        if isinstance(text, bytes):
            if self.plan.eol:
                text = text.replace(b"\r\n", b"\n")
            units = list(map(self.of_bytes[family].__getitem__, self.tokens[family].findall(text)))
            if not self.plan.keep_kana and None in units:
                return None
        else:
            if self.plan.eol:
                text = text.replace("\r\n", "\n")
            if "\U0010ffff" in text:  # which isn't a character either
                return None
            if self.joined and self.joined.search(text):
                units = map(self.of_text.__getitem__, self.units.findall(text))
            elif self.shifts:
                units = map(self.of_scalar.__getitem__, map(ord, text))
            elif self.same_ascii:
                if self.plan.eol and self.plan.eol != b"\n":
                    text = text.replace("\r", "\n").replace("\n", self.plan.eol.decode())
                elif self.plan.eol:
                    text = text.replace("\r", "\n")
                units = BEYOND_ASCII.sub(lambda m: m[0].translate(self.of_scalar), text)
            else:
                units = text.translate(self.of_scalar)
        return self.shifted(units) if self.shifts else self.mark + "".join(units).encode(self.codec, "ignore")


@once
def converter(plan: Plan) -> Converter | None:
    """The plan's tables, kept by the worker process; None if the plan isn't a simple one."""
    return Converter(plan) if simple(plan) else None


def guess(data: bytes, plan: Plan) -> tuple[str, str | None] | None:
    """The names of a document's encoding and line ends; of valid text of one encoding that isn't declared as another."""
    if not simple(plan) or plan.numchar or plan.source and plan.source.family != "utf8":
        return None
    for bom, _, _ in BOMS:
        if data.startswith(bom):
            return None
    if (found := payload(data, plan)) is None:
        return None
    family, _ = found
    if family == "utf8" and plan.source and not detect.WHOLE["utf8"].fullmatch(data):
        return None
    if family == "ascii" or plan.source:
        name, marks = None, 0
    else:
        at = detect.BEYOND_ASCII.search(data).start()
        name, marks = detect.NAMES[family], detect.marks(family, data[at:])
    pairs, cr, lf = data.count(b"\r\n"), data.count(b"\r"), data.count(b"\n")
    kinds = ["CRLF"] * (pairs > 0) + ["CR"] * (cr > pairs) + ["LF"] * (lf > pairs)
    return detect.refined(name, marks), None if not kinds else kinds[0] if len(kinds) == 1 else "MIXED"
