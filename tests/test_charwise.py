"""The character-by-character path says what the whole-document path says, wherever it says anything."""

import random

import pytest

from glyphmill.functions import charwise, kernel
from glyphmill.plans.plan import compile_plan

OUT = ["-w", "-w8", "-w16", "-w16L0", "-w32", "-s", "-e", "-j", "--oc=EUC-JIS-2004", "--oc=CP932", "--oc=eucJP-ms", "--oc=Shift_JIS-2004", "--oc=ISO-2022-JP-3", "--oc=CP51932", "--oc=ISO-2022-JP-1"]
MORE = ["", "-x", "-X -m0", "-Z", "-Z1", "-Z2", "-Z3", "-Z4 -x", "-h1", "-h2", "-h3", "-r", "-I", "-Lu", "-Lw", "-Lm -x", "--fb-html", "--fb-java -x", "--fb-subchar", "--cp932", "--no-cp932", "--ms-ucs-map", "--no-best-fit-chars", "--no-cp932ext", "--x0212", "--prefix=\\@", "--numchar-input", "-Lw -Z4 -h1 --fb-xml -x"]
SIGNS = "abc XYZ09 &<>\"'\r\n\r\n\t~\\=?#;あいうアイウガパヴｱｲｶﾞﾊﾟﾞﾟ漢字愉龍！？　Ａｚ５・ー―—〜～‖∥−－¢£¬￢éüß¥€①Ⅷ㈱ⅰ纊丂鄧か゚セ゚è̀𠮟𠀋😀"


def documents(rng, n):
    for _ in range(n):
        text = "".join(rng.choice(SIGNS if rng.random() < 0.8 else SIGNS[:20]) for _ in range(rng.randint(0, 60)))
        yield text


@pytest.mark.parametrize("more", MORE)
def test_paths_agree(more):
    rng = random.Random(more)
    used = 0
    for out in OUT:
        for text in documents(rng, 12):
            inputs = [("-W", text.encode("utf-8", "ignore")), ("", text.encode("utf-8", "ignore")), ("-W16L", text.encode("utf-16-le", "ignore")), ("-W32", text.encode("utf-32", "ignore")), ("-W", b"\xef\xbb\xbf" + text.encode())]
            for source, codec in (("-S", "cp932"), ("-E", "euc_jp"), ("--ic=EUC-JIS-2004", "euc_jis_2004"), ("--ic=Shift_JIS-2004", "shift_jis_2004"), ("", "cp932"), ("", "euc_jp")):
                inputs.append((source, text.encode(codec, "ignore")))
            inputs += [("-S", bytes(rng.randrange(256) for _ in range(20))), ("-E", bytes(rng.randrange(256) for _ in range(20))), ("", bytes(rng.randrange(256) for _ in range(8)))]
            for source, data in inputs:
                plan = compile_plan([source, out, more]).settled()
                tables = charwise.converter(plan)
                fast = tables.convert(data) if tables else None
                assert fast is None or fast == kernel.convert_whole(data, plan), (source, out, more, data)
                used += fast is not None
    assert used > 500


def test_guesses_agree():
    rng = random.Random(1)
    used = 0
    for text in documents(rng, 300):
        for source in ("", "-W"):
            for codec in ("utf-8", "cp932", "euc_jp", "euc_jis_2004", "shift_jis_2004", "iso2022_jp", "ascii", "utf-16"):
                data, plan = text.encode(codec, "ignore"), compile_plan([source, "-m0"]).settled()
                fast = charwise.guess(data, plan)
                assert fast is None or fast == kernel.guess_whole(data, plan), (source, codec, data)
                used += fast is not None
    assert used > 1000


def test_one_table_for_each_plan():
    plan = compile_plan(["-W", "-s", "-x"]).settled()
    assert charwise.converter(plan) is charwise.converter(compile_plan(["-W", "-s", "-x"]).settled())
    assert charwise.converter(compile_plan(["-f60"]).settled()) is None
