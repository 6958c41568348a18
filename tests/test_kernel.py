"""Conversion and detection of single documents, against known bytes."""

import json
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from glyphmill.functions.kernel import convert, guess
from glyphmill.plans.encodings import ENCODINGS, find
from glyphmill.plans.plan import Plan, compile_plan

CASES = json.loads((Path(__file__).parent / "data" / "convert_cases.json").read_text())
#: Header folding may cut encoded words elsewhere; this one is compared decoded.
TOLERATED = {("-jM",)}


#: Damaged base64 and damaged EUC, where recovery differs: options and the first bytes of the source.
DIFFERENT = {("-jmN", "3d3f49534f2d323032322d4a503f423f47795241"), ("-jmNu", "3d3f49534f2d323032322d4a503f423f47795241"), ("-jmB", "67736d542f494c6e67726d43784a4b346771754333498b"), ("-e", "a4caa4aca4a4a4caa4aca4a4a4caa4aca1c1a4a4a4aea4e7a4a6a4aca4a2a4eaa4dea4b7a4c6a1a200")}


def run(options, data):
    return convert(data, compile_plan(options).settled())


def damaged(case):
    return any(case["options"] == [o] and case["source"].startswith(x) for o, x in DIFFERENT)


MARKED = [pytest.param(c, id=" ".join(c["options"]), marks=[pytest.mark.xfail(strict=True, reason="recovery from damaged input differs")] if damaged(c) else []) for c in CASES]


@pytest.mark.parametrize("case", MARKED)
def test_known_conversions(case):
    got = run(case["options"], bytes.fromhex(case["source"]))
    if tuple(case["options"]) in TOLERATED:
        def plain(b):
            return "".join(run(["-w", "-x"], b).decode().split())

        assert plain(got) in [plain(bytes.fromhex(e)) for e in case["expected"]]
    else:
        assert got.hex() in case["expected"]


TEXT = "あいうえお漢字カタカナ"


@pytest.mark.parametrize(("codec", "name"), [("iso2022_jp", "ISO-2022-JP"), ("shift_jis", "Shift_JIS"), ("euc_jp", "EUC-JP"), ("utf-8", "UTF-8"), ("utf-16", "UTF-16")])
def test_guess_encoding(codec, name):
    assert guess(TEXT.encode(codec), Plan().settled())[0] == name


@pytest.mark.parametrize(("text", "eol"), [("a\nb\n", "LF"), ("a\rb\r", "CR"), ("a\r\nb\r\n", "CRLF"), ("a\nb\r\n", "MIXED"), ("ab", None), ("", None)])
def test_guess_line_ends(text, eol):
    assert guess(text.encode(), Plan().settled()) == ("ASCII", eol)


@pytest.mark.parametrize(("data", "name"), [(b"\x87\x40\x87\x41", "CP932"), (b"\x8f\xb0\xa1\xb0\xfd", "EUCJP-MS"), (b"", "ASCII")])
def test_guess_refined(data, name):
    assert guess(data, Plan().settled())[0] == name


@pytest.mark.parametrize("out", ["-j", "-e", "-s", "-w", "-w8", "-w16", "-w16L", "-w32", "-w32L0", "--oc=EUC-JIS-2004", "--oc=Shift_JIS-2004", "--oc=ISO-2022-JP-3", "--oc=CP932", "--oc=CP51932", "--oc=CP50221"])
def test_round_trips(out):
    source = {"-j": "-J", "-e": "-E", "-s": "-S", "-w": "-W", "-w8": "-W", "-w16": "-W16", "-w16L": "-W16L", "-w32": "-W32", "-w32L0": "-W32L"}.get(out, out.replace("--oc", "--ic"))
    made = run(["-W", "-m0", "-x", out], TEXT.encode())
    assert run(["-w", "-m0", "-x", source], made).decode() == TEXT


@pytest.mark.parametrize(("options", "text", "result"), [
    ("-h1", "カタカナヴ", "かたかなゔ"), ("-h2", "ひらがな", "ヒラガナ"), ("-h3", "かカ", "カか"), ("-Z", "Ａｂ１！", "Ab1!"), ("-Z1", "あ　い", "あ い"), ("-Z2", "あ　い", "あ  い"),
    ("-Z3", "<a&b>", "&lt;a&amp;b&gt;"), ("-Z4", "ガパア", "ｶﾞﾊﾟｱ"), ("-X", "ｶﾞﾊﾟｱ", "ガパア"), ("-r", "Hello", "Uryyb"), ("-Lw", "a\nb\rc\r\n", "a\r\nb\r\nc\r\n"), ("--numchar-input", "&#12354;&#x3044;", "あい"),
    ("--url-input", "%E3%81%82+", "あ+"), ("--cap-input", ":E3:81:82", "あ"), ("--utf8mac-input", "が", "が"), ("-I", "①あ", "〓あ"),
])
def test_transforms(options, text, result):
    keep = ["-X"] if "-X" in options else ["-x"]
    assert run(["-W", "-w", "-m0", *keep, options], text.encode()).decode() == result


@pytest.mark.parametrize(("fallback", "shown"), [("html", b"&#128512;"), ("xml", b"&#x1F600;"), ("perl", b"\\x{1F600}"), ("java", b"\\uD83D\\uDE00"), ("skip", b""), ("subchar", b"?")])
def test_fallbacks(fallback, shown):
    assert run(["-W", "-s", "-m0", "-x", f"--fb-{fallback}"], "😀".encode()) == shown


def test_fold():
    out = run(["-W", "-w", "-m0", "-x", "-f10-2"], ("あ" * 12).encode()).decode()
    assert [len(x) for x in out.split()] == [5, 5, 2]


def test_plan_parsing():
    p = compile_plan(["-jZ0Lu", "-f30-5 -h2"])
    assert (p.target.name, p.width, p.eol, p.fold, p.margin, p.kana) == ("ISO-2022-JP", 1, b"\n", 30, 5, 2)
    assert compile_plan("-w -- -s").target.name == "UTF-8"
    assert compile_plan("-sQw").target.name == "Shift_JIS"  # what follows an unknown letter is dropped
    assert compile_plan("no dash").target is None
    with pytest.raises(TypeError):
        compile_plan(None)
    with pytest.raises(TypeError):
        compile_plan(["-w", 1])


def test_guess_and_debug_options():
    assert (compile_plan("--guess=1").guess, compile_plan("--guess=0").guess, compile_plan("--guess=2").guess, compile_plan("--guess=").guess) == (1, 1, 2, 2)
    assert run(["-w", "--guess=1"], b"abc") == b"" and run(["-w", "--debug"], b"abc") == b"abc"
    assert compile_plan("--guess=1 -w").target.name == "UTF-8"


@pytest.mark.parametrize(("args", "expected"), [
    (["-w", "--", "-x"], (["-w"], ["-x"], 0, False)), (["-g", "a"], ([], ["a"], 1, False)), (["-g0"], ([], [], 1, False)), (["-g2", "-"], ([], ["-"], 2, False)), (["--guess", "a", "b"], ([], ["a", "b"], 2, False)),
    (["--guess=1"], ([], [], 1, False)), (["--guess=3", "--ic=CP932"], (["--ic=CP932"], [], 2, False)), (["-v"], ([], [], 0, True)), (["--help", "x"], ([], [], 0, True)),
])
def test_arguments(args, expected):
    from glyphmill.__main__ import arguments

    assert arguments(args) == expected


def test_command_line(capsysbinary, monkeypatch):
    import io
    import sys

    from glyphmill.__main__ import main

    def said(args, data):
        monkeypatch.setattr(sys, "stdin", io.TextIOWrapper(io.BytesIO(data)))
        assert main(args) == 0
        return capsysbinary.readouterr().out

    assert said(["-w"], "あ".encode("shift_jis") * 3) == "あああ".encode()
    assert said([], b"\x82\xa0") == b"\x82\xa0"
    assert said(["--guess=1"], b"a\r\n") == b"ASCII\n" and said(["--guess"], b"a\r\n") == b"ASCII (CRLF)\n" and said(["-g2"], b"a") == b"ASCII\n"
    assert said(["--version"], b"") == b""


def test_encodings():
    assert len(ENCODINGS) == 36
    assert find("x-sjis") is None and find("X-sjis").name == "Shift_JIS" and find("cp932").name == "Windows-31J"


@settings(max_examples=600, deadline=None)
@given(st.binary(max_size=80), st.sampled_from(["-w", "-s", "-e", "-j", "-w16", "-jM", "-eMQ", "-wMB", "-sf10", "-jI", "-jB", "-wZ4h3r", "-jmN", "-w --ic=EUC-JIS-2004", "-s --numchar-input"]))
def test_any_bytes_convert(data, options):
    assert isinstance(run(options, data), bytes)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="あいう漢字ABC \n", max_size=40))
def test_detected_round_trip(text):
    for codec in ("euc_jp", "shift_jis", "utf-8"):
        data = ("これは日本語の文章です。" + text).encode(codec)
        assert run(["-w", "-m0", "-x"], data).decode() == "これは日本語の文章です。" + text
