"""Characters to bytes, with fallbacks for what the target can't say, and MIME."""

from __future__ import annotations

import base64
import re

from ..plans.plan import Plan
from .decode import text_codes, unicode_of, vendor
from .tables import G3, KANA, LATIN, UNICODE, jis_to_ibm, nec_to_ibm, to_sjis

USER = range(0xE000, 0xE758)


def instead(u: int, plan: Plan) -> list[int]:
    """What the fallback writes for a scalar, as characters."""
    match plan.fallback:
        case "html":
            text = f"&#{u};"
        case "xml":
            text = f"&#x{u:X};"
        case "perl":
            text = f"\\x{{{u:X}}}"
        case "java":
            units = [u] if u < 0x10000 else [(u >> 10) + 0xD7C0, (u & 0x3FF) + 0xDC00]
            text = "".join(f"\\u{x:04X}" for x in units)
        case "subchar":
            return [plan.substitute] if plan.substitute < 0x10000 else []
        case _:
            return []
    return list(text.encode())


def known(codes: list[int], plan: Plan) -> list[int]:
    """Scalars looked up once more in the output's tables, and fallbacks put in."""

    def found(c: int) -> list[int]:
        u = c & 0xFFFFFF
        again = text_codes(chr(u), plan) if u < 0x110000 else []
        if again and again[0] < UNICODE:
            return again
        return [c] if u in USER and _user(u, plan) else instead(u, plan)

    wanted = {c: found(c) for c in set(codes) if c >= UNICODE}
    return [x for c in codes for x in (wanted[c] if c >= UNICODE else (c,))] if wanted else codes


def _user(u: int, plan: Plan) -> bytes:
    """A character of the private area in the target's own user area, if it has one."""
    k = u - 0xE000
    family = plan.target.family
    if family == "jis" and plan.ucs_map != "ascii":
        return bytes((0x7F + k // 94, 0x21 + k % 94))
    if family == "euc" and plan.x0212:
        row = k // 94
        return bytes((0xF5 + row, 0xA1 + k % 94)) if row < 10 else bytes((0x8F, 0xF5 + row - 10, 0xA1 + k % 94))
    if family == "sjis" and not plan.x0213:
        trail = k % 188
        return bytes(((0xF0 if plan.invert else 0xEB) + k // 188, 0x40 + trail + (trail > 0x3E)))
    return b""


def jis(codes: list[int], plan: Plan) -> bytes:
    out, mode = bytearray(), b"("
    kanji = b"$(Q" if plan.x0213 else b"$" + plan.kanji_in
    plane2 = b"$(P" if plan.x0213 else b"$(D"

    def switch(to: bytes, escape: bytes) -> None:
        nonlocal mode
        if mode != to:
            out.extend(b"\x1b" + escape)
            mode = to

    for c in codes:
        if c < 0x80:
            if mode != b"(" and mode != b".":
                out += b"\x1b(" + plan.ascii_in
                mode = b"("
            out.append(c)
        elif c >= UNICODE:
            switch(b"$", kanji)
            out += _user(c & 0xFFFFFF, plan)
        elif c >= LATIN:
            if mode != b"(" and mode != b".":
                out += b"\x1b(" + plan.ascii_in
            mode = b"."
            out.append(c & 0x7F | 0x80)
        elif c >= KANA:
            switch(b"I", b"(I")
            out.append(c & 0x7F)
        elif c >= G3:
            switch(b"D", plane2)
            out += bytes((c >> 8 & 0x7F, c & 0x7F))
        elif 0x20 <= c >> 8 <= (0x92 if plan.ucs_map != "ascii" else 0x7E) and 0x20 <= c & 0xFF <= 0x7E:
            switch(b"$", kanji)
            out += bytes((c >> 8, c & 0xFF))
    if mode not in (b"(", b"."):
        out += b"\x1b(" + plan.ascii_in
    return bytes(out)


def each(codes: list[int], bytes_of, plan: Plan) -> bytes:
    """The bytes of characters, each distinct one looked up once."""
    made = {c: bytes_of(c, plan) for c in set(codes)}
    return b"".join(map(made.__getitem__, codes))


def euc(codes: list[int], plan: Plan) -> bytes:
    return each(codes, euc_bytes, plan)


def euc_bytes(c: int, plan: Plan) -> bytes:
    if c < 0x80:
        return bytes((c,))
    if c >= UNICODE:
        return _user(c & 0xFFFFFF, plan)
    if c >= LATIN:
        return bytes((c & 0x7F | 0x80,))
    if c >= KANA:
        return bytes((0x8E, c & 0x7F | 0x80))
    if c >= G3 and not plan.invert and not plan.x0213:
        c = vendor(c, plan)
    if c >= G3:
        return bytes((0x8F, c >> 8 & 0x7F | 0x80, c & 0x7F | 0x80)) if plan.x0212 else b""
    return bytes((c >> 8 | 0x80, c & 0xFF | 0x80)) if 0x21 <= c >> 8 <= 0x7E and 0x21 <= c & 0xFF <= 0x7E else b""


def sjis(codes: list[int], plan: Plan) -> bytes:
    return each(codes, sjis_bytes, plan)


def sjis_bytes(c: int, plan: Plan) -> bytes:
    if c < 0x80:
        return bytes((c,))
    if c >= UNICODE:
        return _user(c & 0xFFFFFF, plan)
    if c >= KANA:
        return bytes((c & 0x7F | 0x80,))
    if c >= G3:
        if not plan.x0213:
            return jis_to_ibm()[c].to_bytes(2, "big") if c in jis_to_ibm() else b""
        raw = bytes((0x8F, c >> 8 & 0x7F | 0x80, c & 0x7F | 0x80)).decode("euc_jis_2004", "ignore").encode("shift_jis_2004", "ignore")
        return raw if len(raw) == 2 else b""
    if not (0x21 <= c >> 8 <= 0x7E and 0x21 <= c & 0xFF <= 0x7E):
        return b""
    lead, trail = to_sjis(c)
    if plan.invert and lead in (0xED, 0xEE) and not plan.x0213:
        lead, trail = divmod(nec_to_ibm().get(lead << 8 | trail, lead << 8 | trail), 256)
    return bytes((lead, plan.escape, trail)) if trail in plan.escapes else bytes((lead, trail))


def to_text(codes: list[int], plan: Plan) -> str:
    made = {c: unicode_of(c, plan) for c in set(codes)}
    return "".join(map(made.__getitem__, codes))


def encode(codes: list[int], plan: Plan) -> bytes:
    """The bytes of a document; the plan is settled."""
    family = plan.target.family
    little = plan.out_little
    if family in ("utf8", "utf16", "utf32"):
        codec, mark = {"utf8": ("utf-8", b"\xef\xbb\xbf"), "utf16": ("utf-16-le" if little else "utf-16-be", b"\xff\xfe" if little else b"\xfe\xff"), "utf32": ("utf-32-le" if little else "utf-32-be", b"\xff\xfe\0\0" if little else b"\0\0\xfe\xff")}[family]
        raw = to_text(codes, plan).encode(codec, "ignore")
        if plan.mime_out:
            raw = mime(raw, plan)
        return mark + raw if plan.bom else raw
    raw = {"jis": jis, "sjis": sjis}.get(family, euc)(known(codes, plan), plan)
    return mime(raw, plan) if plan.mime_out else raw


CHARSETS = {"jis": b"ISO-2022-JP", "euc": b"EUC-JP", "sjis": b"Shift_JIS", "utf8": b"UTF-8"}


def mime(raw: bytes, plan: Plan) -> bytes:
    """Whole-output base64 or quoted-printable, or encoded words of header lines (folded before 76 columns)."""
    newline = plan.eol or b"\n"
    if plan.mime_out == "B":
        lines = [base64.b64encode(raw[k : k + 54]) for k in range(0, len(raw), 54)]
        return newline.join(lines) + (newline if lines and len(raw) % 54 == 0 else b"")  # a full line ends, a padded one doesn't
    if plan.mime_out == "Q":
        out, used = bytearray(), 0
        for c in raw:
            if used > 71:
                if c not in b"\r\n":
                    out += b"=" + newline
                used = 0
            if c in b"\r\n":
                out.append(c)
                used = 0
            elif chr(c).isalnum() and c < 0x80:
                out.append(c)
                used += 1
            else:
                out += b"=%02X" % c
                used += 3
        return bytes(out)
    if plan.target.family not in CHARSETS:
        return raw
    return b"".join(_header(line, CHARSETS[plan.target.family], plan.target.family, newline) for line in raw.splitlines(keepends=True))


def _pieces(word: bytes, family: str) -> list[bytes]:
    """A word cut so that each piece stands alone in its encoding and its base64 is short."""
    codec = {"jis": "iso2022_jp_2004", "euc": "euc_jis_2004", "sjis": "cp932", "utf8": "utf-8"}[family]
    text = word.decode(codec, "replace")
    out, now = [], ""
    for ch in text:
        if len((now + ch).encode(codec, "replace")) > 30 and now:
            out.append(now.encode(codec, "replace"))
            now = ""
        now += ch
    return [*out, now.encode(codec, "replace")] if now else out


def _header(line: bytes, charset: bytes, family: str, newline: bytes) -> bytes:
    special = rb"[^ \t\r\n]*(?:\x1b\$[^\r\n]*?\x1b\([BJ]|[\x80-\xff])[^ \t\r\n]*(?:[ \t]+[^ \t\r\n]*(?:\x1b\$[^\r\n]*?\x1b\([BJ]|[\x80-\xff])[^ \t\r\n]*)*"
    out, used, at = bytearray(), 0, 0
    for m in re.finditer(special, line):
        used = _plain(out, used, line[at : m.start()], newline)
        for k, piece in enumerate(_pieces(m[0], family)):
            word = b"=?" + charset + b"?B?" + base64.b64encode(piece) + b"?="
            if k or (used and used + len(word) > 76):
                while out.endswith((b" ", b"\t")):
                    del out[-1]
                out += newline + b" "
                used = 1
            out += word
            used += len(word)
        at = m.end()
    _plain(out, used, line[at:], newline)
    return bytes(out)


def _plain(out: bytearray, used: int, text: bytes, newline: bytes) -> int:
    """Adds ASCII words, each with the blanks before it, on new lines where they don't fit; the column reached."""
    for word in re.findall(rb"[ \t]*[^ \t\r\n]+|[ \t]+|[\r\n]+", text):
        if used > 1 and used + len(word) > 76 and word.strip():
            out += newline + (b"" if word[:1] in b" \t" else b" ")
            used = 0
        out += word
        used += len(word)
    return used
