"""What happens to characters between decoding and encoding: width, folding, kana, strictness, rotation, line ends."""

from __future__ import annotations

from ..plans.plan import Plan
from .once import once
from .tables import GETA, KANA, LATIN, UNICODE, from_sjis

VOICED, HALF_VOICED = KANA | 0x5E, KANA | 0x5F
#: Half-width kana in the order of their codes from 0x21, and what they are in full width.
FULL = "。「」、・ヲァィゥェォャュョッーアイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワン゛゜"
WITH_VOICE = dict(zip("ウカキクケコサシスセソタチツテトハヒフヘホ", "ヴガギグゲゴザジズゼゾダヂヅデドバビブベボ", strict=True))
WITH_HALF_VOICE = dict(zip("ハヒフヘホ", "パピプペポ", strict=True))
#: Plane-1 signs that -Z makes ASCII.
SIGNS = dict(zip("，．：；？！´｀＾＿／｜（）［］｛｝＋－＝＜＞＼＄％＃＆＊＠", ",.:;?!'`^_/|()[]{}+-=<>\\$%#&*@", strict=True))
ENTITIES = {ord(k): [ord(c) for c in v] for k, v in {"<": "&lt;", ">": "&gt;", "&": "&amp;", '"': "&quot;"}.items()}


def code_of(char: str) -> int:
    """The plane-1 code of a character."""
    raw = char.encode("euc_jp")
    return (raw[0] & 0x7F) << 8 | raw[1] & 0x7F


@once
def kana_tables() -> tuple[dict, dict, dict, dict]:
    """Half to full, half with a mark to full (twice), and full to half."""
    full = {KANA | 0x21 + k: code_of(c) for k, c in enumerate(FULL)}
    half = {c: KANA | 0x21 + k for k, c in enumerate(FULL)}
    voiced = {half[a]: code_of(b) for a, b in WITH_VOICE.items()}
    half_voiced = {half[a]: code_of(b) for a, b in WITH_HALF_VOICE.items()}
    back = {v: [k] for k, v in full.items()}
    back |= {code_of(b): [half[a], VOICED] for a, b in WITH_VOICE.items()} | {code_of(b): [half[a], HALF_VOICED] for a, b in WITH_HALF_VOICE.items()}
    back |= {0x2577 + k: [half[c], HALF_VOICED] for k, c in enumerate("カキクケコセツト")}  # plane 1 of JIS X 0213
    return full, voiced, half_voiced, back


@once
def signs() -> dict[int, int]:
    raw = {c: c.encode("cp932") for c in SIGNS}
    return {from_sjis(*raw[c]): ord(a) for c, a in SIGNS.items()}


def full_width_kana(codes: list[int]) -> list[int]:
    """Half-width kana to full width; one before a sound mark joins it."""
    if not any(KANA <= c < LATIN for c in codes):
        return codes
    full, voiced, half_voiced, _ = kana_tables()
    out, held = [], None
    for c in codes:
        if held is not None:
            joined = voiced.get(held) if c == VOICED else half_voiced.get(held) if c == HALF_VOICED else None
            out.append(joined or full[held])
            held = None
            if joined:
                continue
        if c in voiced or c in half_voiced:
            held = c
        else:
            out.append(full.get(c, c))
    if held is not None:
        out.append(full[held])
    return out


def width(codes: list[int], bits: int) -> list[int]:
    """-Z: full-width letters and signs to ASCII, the wide blank to one or two, entities, kana to half width."""
    _, _, _, half = kana_tables()
    ascii_signs = signs()
    out: list[int] = []
    for c in codes:
        if bits & 1 and c >> 8 == 0x23:
            c &= 0xFF
        elif c == 0x2121 and bits & 6:
            out += [0x20] * (1 if bits & 2 else 2)
            continue
        elif bits & 1 and c in ascii_signs:
            c = ascii_signs[c]
        if bits & 8 and c in ENTITIES:
            out += ENTITIES[c]
        elif bits & 16 and c in half:
            out += half[c]
        elif bits & 16 and c in (UNICODE | 0x3099, UNICODE | 0x309A):
            out.append(VOICED + c - (UNICODE | 0x3099))
        else:
            out.append(c)
    return out


def kana(codes: list[int], bits: int, to_unicode: bool) -> list[int]:
    """Katakana to hiragana (1), the other way (2), or both at once."""
    out = []
    for c in codes:
        row, cell = c >> 8, c & 0xFF
        if bits & 1 and row == 0x25 and (cell < 0x74 or cell == 0x74 and to_unicode):
            c = 0x2400 | cell if cell < 0x74 else UNICODE | 0x3094
        elif bits & 1 and c in (0x2133, 0x2134):
            c += 2
        elif bits & 2 and c == UNICODE | 0x3094:
            c = 0x2574
        elif bits & 2 and row == 0x24 and cell < 0x74:
            c = 0x2500 | cell
        elif bits & 2 and c in (0x2135, 0x2136):
            c -= 2
        out.append(c)
    return out


#: Plane-1 codes that ISO-2022-JP proper doesn't have.
UNDEFINED = [
    (0x222F, 0x2239), (0x2242, 0x2249), (0x2251, 0x225B), (0x226B, 0x2271), (0x227A, 0x227D), (0x2321, 0x232F), (0x233A, 0x2340), (0x235B, 0x2360), (0x237B, 0x237E),
    (0x2474, 0x247E), (0x2577, 0x257E), (0x2639, 0x2640), (0x2659, 0x267E), (0x2742, 0x2750), (0x2772, 0x277E), (0x2841, 0x287E), (0x4F54, 0x4F7E), (0x7425, 0x747E),
]


def strict(codes: list[int], keep_kana: bool) -> list[int]:
    """-I: what ISO-2022-JP can't say becomes a geta mark."""

    def bad(c: int) -> bool:
        if 0x7F <= c <= 0xFF or LATIN <= c < UNICODE or c >= UNICODE:
            return True
        if KANA <= c < LATIN:
            return keep_kana
        row = c >> 8 & 0x7F
        return c >= 0x2121 and (0x29 <= row <= 0x2F or 0x75 <= row <= 0x7E or any(a <= c <= b for a, b in UNDEFINED))

    return [GETA if bad(c) else c for c in codes]


def rotate(codes: list[int]) -> list[int]:
    """rot13 of letters, rot47 of both bytes of wide characters."""

    def letter(c: int) -> int:
        base = 0x41 if 0x41 <= c <= 0x5A else 0x61 if 0x61 <= c <= 0x7A else 0
        return (c - base + 13) % 26 + base if base else c

    def half(c: int) -> int:
        return (c - 0x21 + 47) % 94 + 0x21 if 0x21 <= c <= 0x7E else c

    out = []
    for c in codes:
        if c < 0x80:
            c = letter(c)
        elif KANA <= c < UNICODE:
            c = c & ~0x7F | letter(c & 0x7F)
        elif c < UNICODE:
            c = c & ~0x7F7F | half(c >> 8 & 0x7F) << 8 | half(c & 0x7F)
        out.append(c)
    return out


def line_ends(codes: list[int], eol: bytes) -> list[int]:
    out, after_cr = [], False
    for c in codes:
        if c == 10 and after_cr:
            after_cr = False
            continue
        after_cr = c == 13
        out += eol if c in (10, 13) else [c]
    return out


def eol_name(codes: list[int]) -> str | None:
    """LF, CR, CRLF, MIXED, or none."""
    kinds, after_cr = set(), False
    for c in codes:
        if after_cr:
            kinds.add("CRLF" if c == 10 else "CR")
        elif c == 10:
            kinds.add("LF")
        after_cr = c == 13
    if after_cr:
        kinds.add("CR")
    return None if not kinds else kinds.pop() if len(kinds) == 1 else "MIXED"


#: Signs that don't begin a line.
STAY_KANA = {0x5E, 0x5F, 0x24, 0x23, 0x21, 0x30}
STAY_ASCII = {ord(c) for c in ")]}.,!?/:;"}
STAY_WIDE = {0x2100 | ord(c) for c in "\"#WK$%'()*+,"}


def fold(codes: list[int], plan: Plan) -> list[int]:
    """-f and -F: lines of a given width, which hang over by a margin rather than begin with a closing sign."""
    limit, margin, keeps = plan.fold, plan.margin, plan.fold_keeps_lines
    newline = list(plan.eol or b"\n")
    out: list[int] = []
    used, last = 0, 0  # columns of the line, and the last character's low byte (with 0x80 if it is Japanese)

    def size(c: int) -> int:
        return 1 if c < 0x80 or c >= KANA else 2

    for c in codes:
        wide_blank = c == 0x2121
        if c == 13 and not keeps or c == 10 and last == 13 and keeps:
            if c == 10:
                last = 10
            continue
        if c == 8:
            used = max(0, used - 1)
            out.append(c)
        elif keeps and c in (10, 13):
            last, used = c, 0
            out += newline
        elif c == 10:
            if last == 10:
                if used:
                    out += newline
                out.append(10) if not used else out.extend(newline)
                used = 0
            elif last & 0x80:
                last = 10
            elif last != 32:
                last, used = 10, used + 1
                if used <= limit:
                    out.append(32)
                else:
                    used = 0
                    out += newline
        elif c == 12:
            last, used = 10, 0
            out += [*newline, c]
        elif c in (32, 9) or wide_blank:
            if last == 32:
                continue
            last, used = 32, used + 1
            if used <= limit:
                out.append(32)
            else:
                used = 0
                out += newline
        else:
            before = last
            last = c & 0x7F | (0x80 if c >= 0x80 and c < UNICODE else 0)
            used += size(c)
            breaks = False
            if used > limit:
                if used > limit + margin:
                    breaks = True
                elif KANA <= c < LATIN:
                    breaks = c & 0x7F not in STAY_KANA
                elif c < 0x80:
                    word = before < 0x80 and chr(before).isalnum()
                    breaks = c not in STAY_ASCII and not word
                else:
                    breaks = c not in STAY_WIDE
            if breaks:
                used = size(c)
                out += newline
            out.append(c)
    if used:
        out += newline
    return out


def transform(codes: list[int], plan: Plan) -> list[int]:
    """All that the plan asks for, in order."""
    if not plan.keep_kana:
        codes = full_width_kana(codes)
    if plan.width:
        codes = width(codes, plan.width)
    if plan.fold:
        codes = fold(codes, plan)
    if plan.kana:
        codes = kana(codes, plan.kana, plan.target.family in ("utf8", "utf16", "utf32"))
    if plan.strict_jis:
        codes = strict(codes, plan.keep_kana)
    if plan.rot:
        codes = rotate(codes)
    if plan.eol:
        codes = line_ends(codes, plan.eol)
    return codes
