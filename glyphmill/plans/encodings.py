"""The encodings: their names, families, and what choosing one implies.

Fixed values: names, aliases and implied settings that results depend on.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Encoding:
    name: str
    family: str
    aliases: tuple[str, ...] = ()
    reads: dict = field(default_factory=dict)  # settings implied when it's the input
    writes: dict = field(default_factory=dict)  # and when it's the output


CP932 = {"keep_kana": True, "ibm_to_g3": True, "ucs_map": "cp932"}

ENCODINGS = [
    Encoding("US-ASCII", "ascii", ("ASCII", "646", "ROMAN8")),
    Encoding("ISO-8859-1", "ascii", (), {"latin": True}),
    Encoding("ISO-2022-JP", "jis", (), {}, {"invert": False}),
    Encoding("CP50220", "jis", ("ISO2022JP-CP932",), {"ibm_to_g3": True, "ucs_map": "cp932"}, {"invert": False, "ucs_map": "cp932"}),
    Encoding("CP50221", "jis", ("CSISO2022JP",), CP932, {"keep_kana": True, "invert": False, "ucs_map": "cp932"}),
    Encoding("CP50222", "jis", (), CP932),
    Encoding("ISO-2022-JP-1", "jis", (), {"x0212": True}, {"x0212": True, "invert": False}),
    Encoding("ISO-2022-JP-3", "jis", (), {"x0212": True, "x0213": True}, {"x0212": True, "x0213": True, "invert": False}),
    Encoding("ISO-2022-JP-2004", "jis", (), {"x0212": True, "x0213": True}, {"x0212": True, "x0213": True, "invert": False}),
    Encoding("Shift_JIS", "sjis", ("SJIS", "MS_KANJI", "PCK")),
    Encoding("Windows-31J", "sjis", ("CSWINDOWS31J", "CP932", "MS932"), CP932, {"keep_kana": True, "ucs_map": "cp932"}),
    Encoding("CP10001", "sjis", (), {"ibm_to_g3": True, "ucs_map": "mac"}, {"ucs_map": "mac"}),
    Encoding("EUC-JP", "euc", ("EUCJP",), {}, {"x0212": True, "invert": False, "ucs_map": "ascii"}),
    Encoding("eucJP-plain", "euc", (), {}, {"x0212": False, "invert": False, "ucs_map": "ascii"}),
    Encoding("CP51932", "euc", (), CP932, {"keep_kana": True, "invert": False, "ucs_map": "cp932"}),
    Encoding("eucJP-MS", "euc", ("EUC-JP-MS", "EUCJPMS"), {"keep_kana": True, "ibm_to_g3": False, "ucs_map": "ms"}, {"keep_kana": True, "x0212": True, "ucs_map": "ms"}),
    Encoding("eucJP-ASCII", "euc", ("EUC-JP-ASCII",), {"keep_kana": True, "ibm_to_g3": False, "ucs_map": "ascii"}, {"keep_kana": True, "x0212": True, "ucs_map": "ascii"}),
    Encoding("Shift_JISX0213", "sjis", (), {"x0213": True, "ibm_to_g3": False, "invert": False}, {"x0213": True, "invert": False}),
    Encoding("Shift_JIS-2004", "sjis", (), {"x0213": True, "ibm_to_g3": False, "invert": False}, {"x0213": True, "invert": False}),
    Encoding("EUC-JISX0213", "euc", (), {"x0213": True, "ibm_to_g3": False}, {"x0212": True, "x0213": True, "invert": False}),
    Encoding("EUC-JIS-2004", "euc", (), {"x0213": True, "ibm_to_g3": False}, {"x0212": True, "x0213": True, "invert": False}),
    Encoding("UTF-8", "utf8"),
    Encoding("UTF-8N", "utf8"),
    Encoding("UTF-8-BOM", "utf8", (), {}, {"bom": True}),
    Encoding("UTF8-MAC", "utf8", ("UTF-8-MAC",), {"nfc": True}),
    Encoding("UTF-16", "utf16", (), {"in_little": False}, {"bom": True, "out_little": False}),
    Encoding("UTF-16BE", "utf16", (), {"in_little": False}),
    Encoding("UTF-16BE-BOM", "utf16", (), {"in_little": False}, {"bom": True, "out_little": False}),
    Encoding("UTF-16LE", "utf16", (), {"in_little": True}, {"bom": False, "out_little": True}),
    Encoding("UTF-16LE-BOM", "utf16", (), {"in_little": True}, {"bom": True, "out_little": True}),
    Encoding("UTF-32", "utf32", (), {"in_little": False}, {"bom": True, "out_little": False}),
    Encoding("UTF-32BE", "utf32", (), {"in_little": False}),
    Encoding("UTF-32BE-BOM", "utf32", (), {"in_little": False}, {"bom": True, "out_little": False}),
    Encoding("UTF-32LE", "utf32", (), {"in_little": True}, {"bom": False, "out_little": True}),
    Encoding("UTF-32LE-BOM", "utf32", (), {"in_little": True}, {"bom": True, "out_little": True}),
    Encoding("BINARY", "ascii"),
]

BY_NAME = {n.upper(): e for e in ENCODINGS for n in (e.name, *e.aliases)}

#: Names for Transcoder(encoding=...), without - and _, and the options that write and read them.
SHORT_NAMES = {
    "iso2022jp": ("-j", "-J"),
    "eucjp": ("-e", "-E"),
    "shiftjis": ("-s", "-S"),
    "sjis": ("-s", "-S"),
    "cp932": ("-s", "-S"),
    "windows31j": ("-s", "-S"),
    "utf8": ("-w", "-W"),
    "utf16": ("-w16", "-W16"),
    "utf16be": ("-w16B0", "-W16B"),
    "utf16le": ("-w16L0", "-W16L"),
    "utf32": ("-w32", "-W32"),
    "utf32be": ("-w32B0", "-W32B"),
    "utf32le": ("-w32L0", "-W32L"),
}


def find(name: str) -> Encoding | None:
    """An encoding by name or alias, whatever the case, with or without a leading X-."""
    return BY_NAME.get(name.removeprefix("X-").upper())
