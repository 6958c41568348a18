"""Code tables, built once in a worker from Python's codecs and a few fixed values.

A character is an int: below 0x80 ASCII; row and cell in two bytes for a plane-1 character; G3 plus those for plane 2
(or JIS X 0212); KANA or LATIN plus seven bits; UNICODE plus a scalar that has no code in the tables.
"""

from __future__ import annotations

from .once import once

G3, KANA, LATIN, UNICODE = 0x8F0000, 0xA00000, 0xB00000, 0x1000000
GETA = 0x222E
CELLS = range(0x21, 0x7F)

#: Where the Microsoft mapping differs from the standard one, and the Macintosh one from both.
STANDARD = {0x2141: 0x301C, 0x2142: 0x2016, 0x215D: 0x2212, 0x2171: 0xA2, 0x2172: 0xA3, 0x224C: 0xAC, 0x2140: 0xFF3C, 0x2131: 0x203E, 0x216F: 0xA5, 0x213D: 0x2014}
MICROSOFT = {0x2141: 0xFF5E, 0x2142: 0x2225, 0x215D: 0xFF0D, 0x2171: 0xFFE0, 0x2172: 0xFFE1, 0x224C: 0xFFE2, 0x2140: 0xFF3C, 0x2131: 0xFFE3, 0x216F: 0xFFE5, 0x213D: 0x2015}
MACINTOSH = {0x2140: 0xFF3C, 0x2141: 0x301C, 0x2142: 0x2016, 0x213D: 0x2014, 0x215D: 0x2212, 0x2171: 0xA2, 0x2172: 0xA3, 0x224C: 0xAC}


def to_sjis(code: int) -> tuple[int, int]:
    """Lead and trail byte of a plane-1 code, by the code's rows taken in pairs."""
    row, cell = divmod(code, 256)
    pair, odd = divmod(row - 0x21, 2)
    lead = pair + (0x81 if pair < 31 else 0xC1)
    return lead, (cell + 0x7E if odd else cell + 0x1F + (cell >= 0x60))


def from_sjis(lead: int, trail: int) -> int:
    """The plane-1 code of a lead and a trail byte; rows beyond 0x7E are possible."""
    pair = lead - (0x81 if lead < 0xA0 else 0xC1)
    if trail >= 0x9F:
        return (pair * 2 + 0x22) * 256 + trail - 0x7E
    return (pair * 2 + 0x21) * 256 + trail - 0x1F - (trail > 0x7F)


def _one(raw: bytes, codec: str) -> int:
    try:
        text = raw.decode(codec)
    except UnicodeDecodeError:
        return 0
    return ord(text) if len(text) == 1 else 0


@once
def ibm_codes() -> dict[int, int]:
    """Unicode of each IBM extension of Shift_JIS, 0xFA40 to 0xFC4B."""
    out = {}
    for lead in (0xFA, 0xFB, 0xFC):
        for trail in range(0x40, 0xFD):
            if trail != 0x7F and (u := _one(bytes((lead, trail)), "cp932")):
                out[lead << 8 | trail] = u
    return out


@once
def ibm_to_nec() -> dict[int, int]:
    """The other Shift_JIS code, outside the IBM rows, of an IBM extension."""
    other = {}
    for lead in (*range(0x81, 0xA0), *range(0xE0, 0xEF)):
        for trail in range(0x40, 0xFD):
            if trail != 0x7F and (u := _one(bytes((lead, trail)), "cp932")):
                other.setdefault(u, lead << 8 | trail)
    return {c: other[u] for c, u in ibm_codes().items() if u in other}


@once
def nec_to_ibm() -> dict[int, int]:
    """What the NEC-selected codes (leads 0xED and 0xEE) are written as."""
    out, ibm = {}, {u: c for c, u in ibm_codes().items()}
    for lead in (0xED, 0xEE):
        for trail in range(0x40, 0xFD):
            if trail != 0x7F and (u := _one(bytes((lead, trail)), "cp932")):
                out[lead << 8 | trail] = 0x81CA if u == 0xFFE2 else ibm.get(u, lead << 8 | trail)
    return out


@once
def ibm_to_jis() -> dict[int, int]:
    """The plane-2 code, or plane-1 code, of an IBM extension.

    Fixed values: small Roman numerals from row 0x73, cell 0x73; three signs; the kanji that JIS X 0212 lacks follow in order.
    """
    x0212 = {u: c for c, u in g3_to_unicode("plain").items() if (c >> 8 & 0x7F) < 0x73}
    plane1 = {u: c for c, u in jis_to_unicode("cp932").items() if c >> 8 < 0x79}
    out, following = {}, 0x7421
    for code, u in ibm_codes().items():
        if 0x2170 <= u <= 0x2179:
            out[code] = G3 | 0x7373 + u - 0x2170
        elif u == 0xFFE4:
            out[code] = G3 | 0x2243
        elif u in (0xFF07, 0xFF02):
            out[code] = G3 | (0x7329 if u == 0xFF07 else 0x732A)
        elif u in plane1:
            out[code] = plane1[u]
        elif u in x0212:
            out[code] = x0212[u]
        else:
            out[code] = G3 | following
            following += 1
    return out


@once
def jis_to_ibm() -> dict[int, int]:
    return {j: s for s, j in reversed(ibm_to_jis().items()) if j >= G3}


@once
def jis_to_unicode(which: str) -> dict[int, int]:
    """Plane 1, by mapping: ascii, ms and cp932, mac, x0213."""
    out: dict[int, int] = {}
    for row in range(0x21, 0x7F):
        for cell in CELLS:
            code = row << 8 | cell
            if which == "x0213":
                text = b"".join(((row | 0x80).to_bytes(), (cell | 0x80).to_bytes())).decode("euc_jis_2004", "ignore")
                u = ord(text) if len(text) == 1 else 0
            else:
                u = _one(bytes((row | 0x80, cell | 0x80)), "euc_jp") if row < 0x75 and which != "cp932" and which != "ms" else 0
                if not u and row <= 0x7C:
                    u = _one(bytes(to_sjis(code)), "cp932")
            if u:
                out[code] = u
    for code, u in {"ascii": STANDARD, "mac": MACINTOSH, "x0213": {}}.get(which, MICROSOFT).items():
        out[code] = u
    return out


@once
def g3_to_unicode(which: str) -> dict[int, int]:
    """Plane 2: x0213, or plain for JIS X 0212 (with the IBM extensions under "ibm")."""
    out: dict[int, int] = {}
    for row in range(0x21, 0x7F):
        for cell in CELLS:
            raw = bytes((0x8F, row | 0x80, cell | 0x80))
            text = raw.decode("euc_jis_2004" if which == "x0213" else "euc_jp", "ignore")
            if len(text) == 1:
                out[G3 | row << 8 | cell] = ord(text)
    if which == "ibm":
        for sjis, code in ibm_to_jis().items():
            if code >= G3:
                out[code] = ibm_codes()[sjis]
    return out


@once
def combined() -> dict[int, str]:
    """Plane-1 codes of JIS X 0213 that are a letter and a combining mark."""
    out = {}
    for row in range(0x21, 0x7F):
        for cell in CELLS:
            text = bytes((row | 0x80, cell | 0x80)).decode("euc_jis_2004", "ignore")
            if len(text) == 2:
                out[row << 8 | cell] = text
    return out


#: Characters that map to a code whose own Unicode is another.
BEST_FIT = {
    "ascii": MICROSOFT,
    "ms": STANDARD,
    "cp932": STANDARD,
    "mac": MICROSOFT,
    "x0213": MICROSOFT,
}


@once
def unicode_to_jis(which: str, best_fit: bool, extensions: bool) -> dict[int, int]:
    """Codes by Unicode scalar, beyond ASCII."""
    out: dict[int, int] = {}
    plane1 = jis_to_unicode(which)
    if best_fit:
        for code, u in BEST_FIT[which].items():
            if u >= 0x80:
                out[u] = code
    g3 = g3_to_unicode("x0213" if which == "x0213" else "ibm")
    for code, u in g3.items():
        out[u] = code
    for code in sorted(plane1, key=lambda c: (0x79 <= c >> 8 <= 0x7C, c == 0x2D00), reverse=True):
        if 0x79 <= code >> 8 <= 0x7C and which != "x0213":
            out.setdefault(plane1[code], code)
        else:
            out[plane1[code]] = code
    if which != "x0213":  # the row of NEC's specials gives way to the standard rows
        for code, u in plane1.items():
            if code >> 8 < 0x2D or 0x30 <= code >> 8 < 0x79:
                out[u] = code
    for k in range(0x21, 0x60):
        out[0xFF40 + k] = KANA | k
    if best_fit and which in ("ms", "cp932"):
        out.update({0xA5: 0x5C, 0x203E: 0x7E})
    if not extensions:
        out = {u: c for u, c in out.items() if c >> 8 != 0x2D and not (c >= G3 and (c >> 8 & 0x7F) >= 0x73)}
    return {u: c for u, c in out.items() if u >= 0x80}
