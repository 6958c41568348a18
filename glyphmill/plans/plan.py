"""Option strings become an immutable plan, on the driver, once for a query."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, replace

from .encodings import Encoding, find


@dataclass(frozen=True)
class Plan:
    source: Encoding | None = None
    target: Encoding | None = None
    in_little: bool = False
    out_little: bool = False
    bom: bool = False
    latin: bool = False
    keep_kana: bool | None = None  # None: not said; half-width kana become full-width then
    width: int = 0  # bits by the digits of -Z
    kana: int = 0  # 1: to hiragana, 2: to katakana
    rot: bool = False
    fold: int = 0
    margin: int = 10
    fold_keeps_lines: bool = False
    mime: str = "strict"  # or loose, off; B, Q: all of the input
    unbuffered: bool = False
    mime_out: str = ""  # header; B, Q: all of the output
    eol: bytes = b""
    broken: int = 0
    strict_jis: bool = False
    ucs_map: str = "ascii"  # or ms, cp932, mac
    cp932_extensions: bool = True
    best_fit: bool = True
    invert: bool = True  # NEC-selected codes of Shift_JIS are written as IBM ones
    force_invert: bool = False
    ibm_to_g3: bool = True
    x0212: bool = False
    x0213: bool = False
    cap: bool = False
    url: bool = False
    numchar: bool = False
    nfc: bool = False
    fallback: str = ""
    substitute: int = 0x3F
    escapes: frozenset = frozenset()  # trail bytes of Shift_JIS that get a byte before them
    escape: int = 0
    kanji_in: bytes = b"B"
    ascii_in: bytes = b"B"
    no_output: bool = False
    guess: int = 0  # tell the encoding (1) and the line ends (2) in place of an output
    debug: bool = False  # name the encodings on standard error; the output stays

    def settled(self) -> Plan:
        """The plan with all that its encodings imply, the input's first."""
        p = self
        if p.target is None:
            p = replace(p, target=find("UTF-8"))
        for implied in ((p.source.reads if p.source else {}), p.target.writes):
            implied = dict(implied)
            if "keep_kana" in implied and p.keep_kana is not None:
                del implied["keep_kana"]
            if "invert" in implied and p.force_invert:
                del implied["invert"]
            p = replace(p, **implied)
        return replace(p, keep_kana=bool(p.keep_kana))


LONG = {
    "base64": "-jMB", "euc": "-e", "euc-input": "-E", "fj": "-jm", "jis": "-j", "jis-input": "-J", "mac": "-sLm", "mime": "-jM", "mime-input": "-m",
    "msdos": "-sLw", "sjis": "-s", "sjis-input": "-S", "unix": "-eLu", "windows": "-sLw", "hiragana": "-h1", "katakana": "-h2", "katakana-hiragana": "-h3",
    "utf8": "-w", "utf16": "-w16", "utf8-input": "-W", "utf16-input": "-W16",
}

SETTINGS = {
    "cp932": {"ucs_map": "cp932", "invert": True, "force_invert": True, "ibm_to_g3": True},
    "no-cp932": {"ucs_map": "ascii", "invert": False, "force_invert": False, "ibm_to_g3": False},
    "cp932inv": {"invert": True, "force_invert": True},
    "x0212": {"x0212": True},
    "ms-ucs-map": {"ucs_map": "ms"},
    "no-cp932ext": {"cp932_extensions": False},
    "no-best-fit-chars": {"best_fit": False},
    "utf8mac-input": {"nfc": True},
    "cap-input": {"cap": True},
    "url-input": {"url": True},
    "numchar-input": {"numchar": True},
    "no-output": {"no_output": True},
    "debug": {"debug": True},
    "fb-skip": {"fallback": ""},
    "fb-html": {"fallback": "html"},
    "fb-xml": {"fallback": "xml"},
    "fb-perl": {"fallback": "perl"},
    "fb-java": {"fallback": "java"},
    "fb-subchar": {"fallback": "subchar"},
}

EOL = {"u": b"\n", "m": b"\r", "w": b"\r\n", "0": b"", "": b""}
UTF = r"(?:(8)(0)?|(16|32)([BL])?(0)?)?"


def _utf_out(p: Plan, m: re.Match) -> Plan:
    eight, plain8, bits, order, plain = m.groups()
    if not bits:
        return replace(p, target=find("UTF-8-BOM" if eight and not plain8 else "UTF-8"), bom=bool(eight and not plain8))
    name = f"UTF-{bits}{'LE' if order == 'L' else 'BE'}{'' if plain else '-BOM'}"
    return replace(p, target=find(name), out_little=order == "L", bom=not plain)


def _utf_in(p: Plan, m: re.Match) -> Plan:
    _, _, bits, order, _ = m.groups()
    return replace(p, source=find(f"UTF-{bits}{'LE' if order == 'L' else 'BE'}" if bits else "UTF-8"), in_little=order == "L")


def _width(p: Plan, m: re.Match) -> Plan:
    bits = p.width | 1
    for d in m[1]:
        bits |= 1 << int(d)
    return replace(p, width=bits)


def _fold(p: Plan, m: re.Match) -> Plan:
    width = int(m[2] or 0)
    return replace(p, fold=width if 0 < width < 4096 else 60, margin=int(m[3]) if m[3] else 10, fold_keeps_lines=p.fold_keeps_lines or m[1] == "F")


def _to(**changes):
    return lambda p, m: replace(p, **changes)


#: Short options: what is read at a letter, and what it changes.
SHORT = [
    (r"b", _to(unbuffered=False)),
    (r"u", _to(unbuffered=True)),
    (r"t[12]?", _to()),
    (r"[jn]", lambda p, m: replace(p, target=find("ISO-2022-JP"))),
    (r"e", lambda p, m: replace(p, target=find("eucJP-plain"))),
    (r"s", lambda p, m: replace(p, target=find("Shift_JIS"))),
    (r"l", lambda p, m: replace(p, source=find("ISO-8859-1"), latin=True)),
    (r"i([@B])?", lambda p, m: replace(p, kanji_in=(m[1] or "B").encode())),
    (r"o([JBH])?", lambda p, m: replace(p, ascii_in=(m[1] or "B").encode())),
    (r"h(\d?)", lambda p, m: replace(p, kana=p.kana | int(m[1] or 1))),
    (r"r", _to(rot=True)),
    (r"w" + UTF, _utf_out),
    (r"W" + UTF, _utf_in),
    (r"J", lambda p, m: replace(p, source=find("ISO-2022-JP"))),
    (r"E", lambda p, m: replace(p, source=find("EUC-JP"))),
    (r"S", lambda p, m: replace(p, source=find("Shift_JIS"))),
    (r"Z([0-4]*)", _width),
    (r"x", _to(keep_kana=True)),
    (r"X", _to(keep_kana=False)),
    (r"([fF])(\d*)(?:-(\d+))?", _fold),
    (r"m([BQNS0])?", lambda p, m: replace(p, mime={"N": "loose", "0": "off", "B": "B", "Q": "Q"}.get(m[1] or "", "strict"))),
    (r"M([BQ])?", lambda p, m: replace(p, mime_out=m[1] or "header")),
    (r"B(\d?)", lambda p, m: replace(p, broken=p.broken | (1 << int(m[1]) if m[1] else 1))),
    (r"c", _to(eol=b"\r\n")),
    (r"d", _to(eol=b"\n")),
    (r"I", _to(strict_jis=True)),
    (r"L([umw0])?", lambda p, m: replace(p, eol=EOL[m[1] or ""])),
]
SHORT = [(re.compile(pattern), change) for pattern, change in SHORT]


def _long(p: Plan, word: str) -> Plan:
    name, _, value = word.partition("=")
    if name in ("ic", "oc"):
        if (found := find(value)) is not None:
            p = replace(p, **{"source" if name == "ic" else "target": found})
        return p
    if word in LONG:
        return _short(p, LONG[word][1:])
    if name == "fb-subchar" and value:
        try:
            code = int(value, 16 if value[:2].lower() == "0x" else 8 if value[0] == "0" and len(value) > 1 else 10)
        except ValueError:
            return p
        return replace(p, fallback="subchar", substitute=code)
    if name == "guess" and "=" in word:
        return replace(p, guess=1 if value[:1] in ("0", "1") else 2, no_output=True)
    if name == "prefix" and value:
        return replace(p, escape=ord(value[0]) & 0xFF, escapes=frozenset(value[1:].encode("latin-1", "ignore")))
    return replace(p, **SETTINGS.get(word, {}))


def _short(p: Plan, letters: str) -> Plan:
    at = 0
    while at < len(letters):
        for pattern, change in SHORT:
            if m := pattern.match(letters, at):
                p, at = change(p, m), m.end()
                break
        else:
            break  # an unknown letter: the rest of the string is dropped
    return p


def option_strings(options: str | Iterable[str]) -> list[str]:
    """Options as a list: one string, or a list or tuple of strings."""
    if isinstance(options, str):
        return [options]
    if not isinstance(options, list | tuple):
        raise TypeError("options must be a string, or a list or tuple of strings")
    if not all(isinstance(o, str) for o in options):
        raise TypeError("each option must be a string")
    return list(options)


def compile_plan(options: str | Iterable[str], base: Plan | None = None) -> Plan:
    """The plan that option strings describe. Groups in a string are divided by spaces; -- ends all options."""
    p = base or Plan()
    for text in option_strings(options):
        for word in text.split():
            if word == "--":
                return p
            if word.startswith("--"):
                p = _long(p, word[2:])
            elif word.startswith("-"):
                p = _short(p, word[1:])
    return p
