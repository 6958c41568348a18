"""Bytes to characters (see ``tables``), with or without a declared encoding."""

from __future__ import annotations

import base64
import re
import unicodedata
from dataclasses import dataclass, field

from ..plans.encodings import find
from ..plans.plan import Plan
from . import detect
from .tables import G3, GETA, KANA, LATIN, UNICODE, combined, from_sjis, g3_to_unicode, ibm_to_jis, ibm_to_nec, jis_to_ibm, jis_to_unicode, nec_to_ibm, to_sjis, unicode_to_jis

BOMS = [
    (b"\x00\x00\xfe\xff", "utf32", "big"), (b"\xff\xfe\x00\x00", "utf32", "little"), (b"\x00\x00\xff\xfe", "utf32", "2143"), (b"\xfe\xff\x00\x00", "utf32", "3412"),
    (b"\xfe\xff", "utf16", "big"), (b"\xff\xfe", "utf16", "little"), (b"\xef\xbb\xbf", "utf8", ""),
]
MODES = {b"$@": "x0208", b"$B": "x0208", b"$(@": "x0208", b"$(B": "x0208", b"$(D": "x0212", b"$(O": "x0213", b"$(Q": "x0213", b"$(P": "x0213-2", b"(I": "kana", b"(B": "ascii", b"(J": "ascii", b"(H": "ascii"}
ESCAPE = re.compile(rb"\x1b(\$\(?[@B]|\$\([DOPQ]|\([BIJH])")
PHONE = re.compile(rb"\x1b\$([E-GO-Q])([\x20-z]*)")
#: Where a carrier's pictures lie, by the letter that opens their group.
PICTURES = {"G": 0xE001, "E": 0xE101, "F": 0xE201, "O": 0xE301, "P": 0xE401, "Q": 0xE501}
WORD = re.compile(rb"=\?(ISO-8859-1|ISO-2022-JP|UTF-8|EUC-JP|SHIFT_JIS|US-ASCII)\?([BQ])\?", re.I)
ALLOWED = {(b"EUC-JP", b"B"), (b"SHIFT_JIS", b"B"), (b"ISO-8859-1", b"Q"), (b"ISO-8859-1", b"B"), (b"ISO-2022-JP", b"B"), (b"ISO-2022-JP", b"Q"), (b"UTF-8", b"B"), (b"UTF-8", b"Q"), (b"US-ASCII", b"Q")}
LOOSE = re.compile(rb"=\?[\w\n\r -]{1,60}\?([BQbq])\?")
BETWEEN = re.compile(rb"(?:[ \t]*\r?\n)?[ \t]+(?==\?)")
CONTROLS, GROUPS = bytes(range(0x21)), re.compile(rb"[A-Za-z0-9+/]*={0,2}")
BASE64 = {c: i for i, c in enumerate(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")} | {ord("-"): 62, ord("_"): 63}


@dataclass
class Seen:
    """What a document showed: the names of its encodings, and its characters' marks."""

    name: str | None = None
    marks: int = 0
    kinds: set = field(default_factory=set)

    def saw(self, name: str) -> None:
        self.name = name if self.name in (None, name) else ""


def ucs(plan: Plan) -> str:
    return plan.ucs_map if plan.ucs_map != "ascii" else "x0213" if plan.x0213 else "ascii"


def _sjis_code(lead: int, trail: int, plan: Plan) -> int:
    """A plane-1 or plane-2 code of two bytes of Shift_JIS."""
    code = lead << 8 | trail
    if plan.x0213:
        if lead < 0xF0:
            return from_sjis(lead, trail)
        raw = bytes((lead, trail)).decode("shift_jis_2004", "ignore").encode("euc_jis_2004", "ignore")
        return G3 | (raw[1] & 0x7F) << 8 | raw[2] & 0x7F if len(raw) == 3 else from_sjis(lead, trail)
    if lead >= 0xFA and not plan.invert:
        code = ibm_to_nec().get(code, code)
    if plan.invert and lead in (0xED, 0xEE):
        code = nec_to_ibm().get(code, code)
    if code >= 0xFA00:
        return ibm_to_jis().get(code, 0)
    return from_sjis(*divmod(code, 256))


def vendor(code: int, plan: Plan) -> int:
    """A code of the vendor rows as this plan holds it: through Shift_JIS and back."""
    if code >= G3:
        return _sjis_code(*divmod(jis_to_ibm()[code], 256), plan) if code in jis_to_ibm() else code
    return _sjis_code(*to_sjis(code), plan) if 0x79 <= code >> 8 <= 0x7C else code


def each(chars: list[bytes], code_of, plan: Plan) -> list[int]:
    """The codes of characters, each distinct one looked up once; those without a code go."""
    known = {c: code_of(c, plan) for c in set(chars)}
    return [k for k in map(known.__getitem__, chars) if k is not None]


def euc(data: bytes, plan: Plan) -> list[int]:
    return each(re.findall(rb"[\x00-\x7f]|\x8f..|[\x80-\xff].", data, re.S), euc_code, plan)


def euc_code(char: bytes, plan: Plan) -> int | None:
    lead = char[0]
    if lead < 0x80:
        return lead
    if lead == 0x8E:
        return GETA if plan.strict_jis and plan.keep_kana else KANA | char[1] & 0x7F
    if lead == 0x8F:
        if len(char) < 3 or min(char[1:]) < 0xA1:
            return None
        if not plan.ibm_to_g3 and not plan.x0213 and char[1] >= 0xF5:
            return UNICODE | (char[1] - 0xF5) * 94 + char[2] - 0xA1 + 0xE3AC
        code = G3 | (char[1] & 0x7F) << 8 | char[2] & 0x7F
        return vendor(code, plan) if plan.ibm_to_g3 and not plan.x0213 else code
    if char[1] < 0x40:
        return None  # no trail byte: both go
    if not plan.ibm_to_g3 and plan.ucs_map != "ascii" and lead >= 0xF5 and char[1] >= 0xA1:
        return UNICODE | (lead - 0xF5) * 94 + char[1] - 0xA1 + 0xE000
    code = (lead & 0x7F) << 8 | char[1] & 0x7F
    return vendor(code, plan) if plan.ibm_to_g3 else code


def sjis(data: bytes, plan: Plan) -> list[int]:
    return each(re.findall(rb"[\x00-\x80\xa0-\xdf\xfd-\xff]|[\x80-\xff].", data, re.S), sjis_char, plan)


def sjis_char(char: bytes, plan: Plan) -> int | None:
    lead = char[0]
    if lead < 0x80:
        return lead
    if 0xA0 <= lead <= 0xDF or plan.ucs_map == "mac" and lead >= 0xFD and len(char) == 1:
        return KANA | lead & 0x7F
    if len(char) == 1 or not 0x40 <= char[1] <= 0xFC:
        return None
    if not plan.x0213 and 0xF0 <= lead <= 0xF9:
        return None if char[1] == 0x7F else UNICODE | (lead - 0xF0) * 188 + char[1] - 0x40 - (char[1] > 0x7E) + 0xE000
    return _sjis_code(lead, char[1], plan) or None


def _plane2(code: int, u: int, plan: Plan) -> int:
    """A plane-2 code of a scalar, unless the output can't say it and falls back, or has it in the vendor rows."""
    if plan.invert:
        return UNICODE | u if plan.fallback else code
    return vendor(code, plan) if code in jis_to_ibm() else UNICODE | u


def text_codes(text: str, plan: Plan) -> list[int]:
    """Codes of Unicode text."""
    table = unicode_to_jis(ucs(plan), plan.best_fit, plan.cp932_extensions)

    def code_of(char: str) -> int | None:
        u = ord(char[0])
        if len(char) > 1:
            return pairs[char]
        if u < 0x80:
            return u
        if 0xD800 <= u < 0xE000 or u == 0x10FFFF:
            return None
        code = table.get(u)
        if code is None or (u > 0xFFFF and not plan.x0213):
            return UNICODE | u
        return _plane2(code, u, plan) if G3 <= code < KANA and not plan.x0213 else code

    chars: list[str] | str = text
    if plan.x0213:
        pairs = {v: k for k, v in combined().items()}
        chars = re.findall("|".join(map(re.escape, pairs)) + "|(?s:.)", text)
    known = {c: code_of(c) for c in set(chars)}
    return [k for k in map(known.__getitem__, chars) if k is not None]


def utf8(data: bytes, plan: Plan) -> list[int]:
    return text_codes(data.decode("utf-8", "ignore"), plan)


def utf16(data: bytes, plan: Plan, order: str) -> list[int]:
    data = data[: len(data) // 2 * 2]
    return text_codes(data.decode("utf-16-le" if order == "little" else "utf-16-be", "ignore"), plan)


def utf32(data: bytes, plan: Plan, order: str) -> list[int]:
    data = data[: len(data) // 4 * 4]
    if order in ("2143", "3412"):
        swapped = bytearray(data)
        for k, j in enumerate((1, 0, 3, 2) if order == "2143" else (2, 3, 0, 1)):
            swapped[j::4] = data[k::4]
        data, order = bytes(swapped), "big"
    return text_codes(data.decode("utf-32-le" if order == "little" else "utf-32-be", "ignore"), plan)


EIGHT_BIT = {"euc": euc, "sjis": sjis, "utf8": utf8, "jis": euc, "ascii": euc}


def decode_words(data: bytes, plan: Plan) -> tuple[bytes, list[tuple[int, str, bytes]]]:
    """Encoded words taken out of a text: what is left, and (place, charset, bytes) of each run of words."""
    out, words, at = bytearray(), [], 0
    pattern = LOOSE if plan.mime == "loose" else WORD
    after_word = False
    while m := pattern.search(data, at):
        if plan.mime == "loose":
            charset, method = b"", m[1].upper()  # the charset isn't trusted
        else:
            charset, method = m[1].upper(), m[2].upper()
        end = data.find(b"?=", m.end())
        body = data[m.end() : end] if end >= 0 else data[m.end() :]
        fits = plan.mime == "loose" or ((charset, method) in ALLOWED and (method == b"Q" or plan.unbuffered or (0 <= end and re.fullmatch(rb"[A-Za-z0-9+/=]*", body) and len(body) < 1000)))
        if method == b"Q" and plan.mime != "loose" and re.search(rb"[\x00-\x20\x7f-\xff]", body):
            stop = re.search(rb"[\x00-\x20\x7f-\xff]", body).start()  # a blank ends the word
            body, end = body[:stop], m.end() + stop - 2
        if not fits:
            out += data[at : m.end()]
            at, after_word = m.end(), False
            continue
        gap = data[at : m.start()]
        if not (after_word and re.fullmatch(rb"(?:(?:\r?\n)?[ \t]+)?", gap)):
            out += gap
        raw = from_base64(body) if method == b"B" else from_quoted(body.replace(b"_", b" "))
        if words and words[-1][0] == len(out) and words[-1][1] == charset.decode():
            words[-1] = (len(out), words[-1][1], words[-1][2] + raw)
        else:
            words.append((len(out), charset.decode(), raw))
        at, after_word = (end + 2 if end >= 0 else len(data)), True
    out += data[at:]
    return bytes(out), words


def from_base64(body: bytes) -> bytes:
    """Base64 of either alphabet; = ends a group, blanks are passed over, other bytes go on counting from the nearest range."""
    plain = body.translate(None, CONTROLS)
    if len(plain) % 4 == 0 and GROUPS.fullmatch(plain):
        return base64.b64decode(plain)
    bits, n, out = 0, 0, bytearray()
    for c in body:
        if c <= 0x20:
            continue
        if c == 0x3D:
            bits, n = 0, 0
            continue
        six = BASE64.get(c, (c - 0x47 if c > 0x5A else c + 4 if c > 0x2F else 63) & 63)
        bits, n = bits << 6 | six, n + 6
        if n >= 8:
            n -= 8
            out.append(bits >> n & 0xFF)
            bits &= (1 << n) - 1
    return bytes(out)


def from_quoted(body: bytes) -> bytes:
    body = re.sub(rb"=[ \t]*\r?\n", b"", body)
    return re.sub(rb"=([0-9A-Fa-f]{2})", lambda m: bytes((int(m[1], 16),)), body)


def prepare(data: bytes, plan: Plan) -> bytes:
    """The input's own escapes undone: :HH, %HH, lost ESC, decomposed letters, whole-input MIME."""
    if plan.cap:
        data = re.sub(rb":([0-9A-Fa-f]{2})", lambda m: bytes((int(m[1], 16),)), data)
    if plan.url:
        data = re.sub(rb"%([0-9A-Fa-f]{2})", lambda m: bytes((int(m[1], 16),)), data)
    if plan.nfc:
        text = data.decode("utf-8", "surrogateescape")
        data = re.sub("[̀-゙゚ͯ]+", lambda m: m[0], text).encode("utf-8", "surrogateescape")
        data = unicodedata.normalize("NFC", data.decode("utf-8", "surrogateescape")).encode("utf-8", "surrogateescape")
    if plan.mime == "B":
        data = from_base64(data)
    elif plan.mime == "Q":
        data = from_quoted(data)
    if plan.broken & 1:
        data = re.sub(rb"(?<!\x1b)(\$[@B]|\([BJ])", lambda m: b"\x1b" + m[0], data)
    return data


def decode(data: bytes, plan: Plan) -> tuple[list[int], Seen]:
    """The characters of a document under a settled plan."""
    seen = Seen()
    data = prepare(data, plan)
    family = plan.source.family if plan.source else None
    order = "little" if plan.in_little else "big"
    for bom, kind, way in BOMS:
        if data.startswith(bom) and (family is None or family == kind):
            data, family, order = data[len(bom) :], kind, way or order
            seen.saw(detect.NAMES[kind])
            if kind == "utf8" and plan.source is None:
                break
            break
    if family in ("utf16", "utf32"):
        if plan.source:
            seen.saw(detect.NAMES[family])
        return (utf16 if family == "utf16" else utf32)(data, plan, order), seen
    words: list[tuple[int, str, bytes]] = []
    if plan.mime in ("strict", "loose") and b"=?" in data:
        data, words = decode_words(data, plan)
    out, at = [], 0
    for place, charset, raw in words:
        out += body(data[at:place], plan, family, seen)
        out += word_codes(raw, charset, plan, seen)
        at = place
    out += body(data[at:], plan, family, seen)
    return out, seen


def word_codes(raw: bytes, charset: str, plan: Plan, seen: Seen) -> list[int]:
    encoding = find(charset) if charset else None
    family = encoding.family if encoding else None
    if charset == "ISO-8859-1":
        return [c if c < 0x80 else LATIN | c & 0x7F for c in raw]
    return body(raw, plan, family if family in EIGHT_BIT and family != "jis" else None, seen)


def body(data: bytes, plan: Plan, family: str | None, seen: Seen) -> list[int]:
    """8-bit text and ISO-2022-JP: runs between escapes, each in the mode that the escape before it set."""
    if data.isascii() and b"\x1b" not in data and b"\x0e" not in data and not plan.numchar:
        return list(data)
    out: list[int] = []
    mode, at = "ascii", 0
    g2 = False
    while at < len(data):
        m = ESCAPE.match(data, at)
        if m:
            mode = MODES[m[1]]
            seen.saw("ISO-2022-JP")
            seen.kinds.add("jis")
            at = m.end()
            continue
        if data[at] == 0x1B:
            if family == "sjis" or "sjis" in seen.kinds:
                if p := PHONE.match(data, at):
                    first = PICTURES[chr(p[1][0])]
                    out += [UNICODE | first + c - 0x21 for c in p[2]]
                    at = p.end() + (data[p.end() : p.end() + 1] == b"\x0f")
                    continue
            if data.startswith(b"\x1b.A", at):
                g2, at = True, at + 3
                continue
            if g2 and data.startswith(b"\x1bN", at) and at + 2 < len(data):
                out.append(LATIN | data[at + 2] & 0x7F)
                at += 3
                continue
            if data.startswith(b"\x1b&", at):
                at += 3
                continue
            if plan.broken & 2 and data[at + 1 : at + 2] in (b"$", b"("):
                mode, at = ("x0208" if data[at + 1] == 0x24 else "ascii"), at + 3
                continue
            out.append(0x1B)
            at += 1
            continue
        stop = data.find(b"\x1b", at)
        run = data[at : stop if stop >= 0 else len(data)]
        if mode == "ascii":
            out += eight_bit(run, plan, family, seen)
        else:
            used = _shifted(run, mode, plan, out)
            if used < len(run):  # broken text: a newline ends the mode
                mode, stop = "ascii", at + used
        at = stop if stop >= 0 else len(data)
    return out


def _shifted(run: bytes, mode: str, plan: Plan, out: list[int]) -> int:
    """Characters of a run in a two-byte or kana mode; how much of the run was used."""
    at = 0
    while at < len(run):
        c = run[at]
        if c <= 0x20 or c == 0x7F and mode == "kana":
            if plan.broken & 4 and c in b"\r\n":
                return at
            if c not in b"\x0e\x0f":
                out.append(c)
            at += 1
        elif mode == "kana":
            if 0x21 <= c & 0x7F <= 0x5F:
                out.append(KANA | c & 0x7F)
            at += 1
        elif at + 1 < len(run):
            pair = c << 8 | run[at + 1] & 0x7F if c >= 0x80 else (c & 0x7F) << 8 | run[at + 1] & 0x7F
            if c >= 0xA1:
                pair = (c & 0x7F) << 8 | run[at + 1] & 0x7F
            if plan.ucs_map != "ascii" and 0x7F <= c <= 0x92:
                out.append(UNICODE | (c - 0x7F) * 94 + run[at + 1] - 0x21 + 0xE000)
            else:
                out.append(pair if mode in ("x0208", "x0213") else G3 | pair)
            at += 2
        else:
            at += 1
    return at


def eight_bit(run: bytes, plan: Plan, family: str | None, seen: Seen) -> list[int]:
    """A run without escapes, in the declared encoding or one that is chosen where 8-bit text begins."""
    if b"\x0e" in run and family not in ("utf8",):  # shift out: kana of seven bits, until shift in
        out: list[int] = []
        for k, part in enumerate(re.split(rb"([\x0e\x0f])", run)):
            if part == b"\x0e":
                shifted = True
            elif part == b"\x0f" or k == 0:
                shifted = False
                if k == 0:
                    out += eight_bit(part, plan, family, seen)
            elif shifted:
                out += [c if c <= 0x20 else KANA | c for c in part if c <= 0x5F]
            else:
                out += eight_bit(part, plan, family, seen)
        return out
    if plan.numchar:
        parts = re.split(rb"(&#(?:[0-9]{0,8}|[xX][0-9A-Fa-f]{1,7});)", run)
        if len(parts) > 1:
            out = []
            for k, part in enumerate(parts):
                if k % 2:
                    digits = part[2:-1]
                    u = int(digits[1:], 16) if digits[:1] in b"xX" and digits else int(digits or b"0")
                    out.append(u if u < 0x80 else UNICODE | u)
                else:
                    out += eight_bit(part, plan, family, seen)
            return out
    if plan.latin:
        return [c if c < 0x80 else LATIN | c & 0x7F for c in run]
    if run.isascii():
        return list(run)
    if family == "jis" or seen.name == "ISO-2022-JP" and family is None:
        return [x for c in re.findall(rb"[\x00-\x7f]+|[\xa1-\xdf]+|[\x80-\xff]+", run) for x in (list(c) if c[0] < 0x80 else [KANA | b & 0x7F for b in c] if 0xA1 <= c[0] <= 0xDF else euc(c, plan))]
    if family:
        return EIGHT_BIT[family](run, plan)
    out, at = [], 0
    while at < len(run):
        begin = re.compile(rb"[\x80-\xff]").search(run, at)
        if not begin:
            return out + list(run[at:])
        out += list(run[at : begin.start()])
        at = begin.start()
        kind = detect.choose(run, at)
        end = detect.WHOLE[kind].match(run, at).end()
        if end < len(run):  # where the choice fails the text is looked at anew, past the bytes that failed
            end = min(len(run), end + 2)
        part = run[at:end]
        seen.saw(detect.NAMES[kind])
        seen.kinds.add(kind)
        seen.marks |= detect.marks(kind, part)
        out += EIGHT_BIT[kind](part, plan)
        at = end
    return out


def unicode_of(code: int, plan: Plan) -> str:
    """The Unicode text of a character, empty if it has none."""
    if code < 0x80:
        return chr(code)
    if code >= UNICODE:
        return chr(code & 0xFFFFFF)
    if code >= LATIN:
        return chr(code & 0x7F | 0x80)
    if code >= KANA:
        c = code & 0x7F
        if plan.ucs_map == "mac" and c in (0x20, 0x7D):
            return "\xa0" if c == 0x20 else "\xa9"
        return chr(0xFF40 + c) if 0x21 <= c <= 0x5F else ""
    if code >= G3:
        if plan.ucs_map == "ascii" and code == G3 | 0x2243:
            return "\xa6"
        return chr(u) if (u := g3_to_unicode("x0213" if plan.x0213 else "ibm").get(code)) else ""
    if plan.x0213 and code in combined():
        return combined()[code]
    u = jis_to_unicode("x0213" if plan.x0213 else plan.ucs_map if plan.ucs_map != "cp932" else "ms").get(code)
    return chr(u) if u else ""
