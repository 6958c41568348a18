"""Known conversions, as (options, source in hex, result in hex), by what they show.

Fixed values: the code points and escapes are those of the character sets' standards and of the encodings' vendors.
"""

from __future__ import annotations

#: あ, in the encodings that the rows below ask for.
A8, ASJ, AEUC, AJIS = "E38182", "82A0", "A4A2", "1B242424221B2842"

KNOWN: dict[str, list[tuple[str, str, str]]] = {
    "broken_jis": [  # lost escapes, any final byte, a newline that ends the mode
        ("-B -w", "244224222842", A8),
        ("-B1 -w", "1B245824221B285841", A8 + "41"),
        ("-B2 -w", "1B244224220A41", A8 + "0A41"),
        ("-J -w", "1B244224221B284241", A8 + "41"),
    ],
    "mime_words": [  # strict, of any charset, without a check of the end, off, and joined across blanks
        ("-w", "3D3F49534F2D323032322D4A503F423F477952434A4349624B45493D3F3D", A8),
        ("-w", "3D3F49534F2D383835392D313F513F6361663D45393F3D", "636166C3A9"),
        ("-W -w", "3D3F5554462D383F513F3D45333D38313D38323F3D", A8),
        ("-W -w", "3D3F5554462D383F423F343447433F3D203D3F5554462D383F423F343447433F3D", A8 + A8),
        ("-m0 -w", "3D3F5554462D383F513F413F3D", "3D3F5554462D383F513F413F3D"),
        ("-b -w", "3D3F49534F2D323032322D4A503F423F2121213F3D", "3D3F49534F2D323032322D4A503F423F2121213F3D"),
        ("-mN -W -w", "3D3F582D4F544845523F513F4142433F3D", "414243"),
        ("-u -w", "3D3F49534F2D323032322D4A503F423F477952434A4349624B45493D", A8),
    ],
    "mime_whole_input": [
        ("-mB -W -w", "34344743", A8),
        ("-mB -w", "507A345F", "3F3E3F"),
        ("-mQ -W -w", "3D45333D38313D383241", A8 + "41"),
        ("-mQ -w", "613D0A62", "6162"),
    ],
    "quoted_printable_output": [
        ("-W -wMQ", A8, "3D45333D38313D3832"),
        ("-W -wMQ", "612062", "613D323062"),
        ("-W -sMQ", A8 + "41", "3D38323D413041"),
        ("-W -wMQ -m0", "613D62", "613D334462"),
    ],
    "base64_output": [("-W -wMB", A8, "34344743"), ("-W -jMB", A8, "477952434A4349624B45493D"), ("--base64", "41", "51513D3D")],
    "latin_1": [("-l -w", "636166E9", "636166C3A9"), ("-l -w16L0", "E9", "E900"), ("-w", "1B2E411B4E69", "C3A9")],
    "escape_letters": [
        ("-W -j -i@ -oJ", A8 + "41", "1B244024221B284A41"),
        ("-W -j -oH", A8, "1B244224221B2848"),
        ("-W -j", A8, "1B244224221B2842"),
        ("-n -W", A8, "1B244224221B2842"),
    ],
    "iso_2022_jp_input": [  # every escape, shifts, and kana of eight bits
        ("-w", "1B244024221B284A", A8),
        ("-w", "1B24284024221B2842", A8),
        ("-w", "1B24284224221B284841", A8 + "41"),
        ("-w", "1B24284430211B2842", "E4B882"),
        ("--ic=ISO-2022-JP-2004 -w", "1B24285124771B2842", "E3818BE3829A"),
        ("--ic=ISO-2022-JP-2004 -w", "1B24285021211B2842", "F0A08289"),
        ("-x -w", "1B2849311B2842", "EFBDB1"),
        ("-X -w", "1B2849311B2842", "E382A2"),
        ("-J -x -w", "0E310F41", "EFBDB141"),
        ("-x -w", "1B244224221B2842B1", A8 + "EFBDB1"),
        ("--ic=CP50220 -w", "1B24427F211B2842", "EE8080"),
        ("-w", "411B265842", "4142"),
    ],
    "carrier_pictures": [("-S -w", "1B2447210F", "EE8081"), ("-S -w", "1B244521220F41", "EE8481EE848241")],
    "byte_order_marks": [
        ("-w", "FEFF3042", A8), ("-w", "FFFE4230", A8), ("-w", "0000FEFF00003042", A8), ("-w", "FFFE000042300000", A8),
        ("-w", "0000FFFE00004230", A8), ("-w", "FEFF000030420000", A8), ("-w", "EFBBBF" + A8, A8), ("-W -w8", A8, "EFBBBF" + A8),
    ],
    "scalars": [  # surrogates, pairs, and the last code point, which goes
        ("-W16 -w", "D8000041", "41"),
        ("-W16 -w", "D842DFB7", "F0A0AEB7"),
        ("-W16L -w", "42D8B7DF", "F0A0AEB7"),
        ("-W -w", "F48FBFBF41", "41"),
        ("-W -w16", "F0A0AEB7", "FEFFD842DFB7"),
        ("-W -w32L0", "F0A0AEB7", "B70B0200"),
        ("-W -w", "C0804180", "41"),
    ],
    "x0213": [
        ("-W --oc=EUC-JIS-2004", "E3818BE3829A", "A4F7"), ("--ic=EUC-JIS-2004 -w", "A4F7", "E3818BE3829A"),
        ("-W --oc=Shift_JIS-2004", "E3818BE3829A", "82F5"), ("--ic=Shift_JIS-2004 -w", "82F5", "E3818BE3829A"),
        ("-W --oc=ISO-2022-JP-2004", "E3818BE3829A", "1B24285124771B2842"), ("-W --oc=EUC-JIS-2004", "F0A08289", "8FA1A1"),
        ("-W --oc=EUC-JIS-2004", "C3A9", "A9DF"), ("--ic=EUC-JIS-2004 --oc=Shift_JIS-2004", "A9DF", "857E"),
    ],
    "x0212": [("-W --oc=eucJP-MS --x0212", "E4B882", "8FB0A1"), ("-E -e", "8FB0A141", "41"), ("-E --oc=EUC-JP", "8FB0A1", "8FB0A1"), ("-E -w", "8FB0A1", "E4B882"), ("-E --oc=ISO-2022-JP-1", "8FB0A1", "1B24284430211B2842"), ("-E -j --x0212", "8FB0A1", "1B24284430211B2842")],
    "mappings": [  # which Unicode a wave dash is, vendor rows, and what is only nearly the same
        ("-S -w", "8160", "E3809C"), ("-S -w --ms-ucs-map", "8160", "EFBD9E"), ("-S -w --cp932", "8160", "EFBD9E"),
        ("-W -s", "EFBD9E", "8160"), ("-W -s --no-best-fit-chars", "EFBD9E", ""),
        ("-W -s", "E291A0", "8740"), ("-W -s --no-cp932ext", "E291A0", ""),
        ("-S -s", "ED40", "FA5C"), ("-S -s --no-cp932", "ED40", "ED40"), ("-S -w", "FA5C", "E7BA8A"), ("-S -w", "ED40", "E7BA8A"),
    ],
    "user_areas": [("-W --oc=CP932", "EE8080", "F040"), ("-W --oc=eucJP-ms", "EE8080", "F5A1"), ("-W --oc=CP50221", "EE8080", "1B24427F211B2842"), ("--ic=CP932 -w", "F040", "EE8080"), ("--ic=CP932 -w", "F9FC", "EE9D97")],
    "prefix": [("-W -s --prefix=@\\", "E8A1A8", "95405C"), ("-W -s", "E8A1A8", "955C"), ("-W -s --prefix=@\\", A8, ASJ)],
    "strict_jis": [("-W -w -I -x", "E291A0", "E38093"), ("-W -w -I -x", A8, A8), ("-S -w -I -x", "B1", "E38093")],
    "rotation": [("-W -w -r", "48656C6C6F", "5572797962"), ("-W -e -r", A8, "D3D1"), ("-E -e -r", "D3D1", AEUC)],
    "folding": [
        ("-W -w -m0 -x -f10-2", A8 * 12, A8 * 5 + "0A" + A8 * 5 + "0A" + A8 * 2 + "0A"),
        ("-W -w -m0 -x -f10-2 -Lw", A8 * 6, A8 * 5 + "0D0A" + A8 + "0D0A"),
        ("-W -w -m0 -x -F60", A8 + "0A" + A8 + "0A", A8 + "0A" + A8 + "0A"),
    ],
    "short_options": [  # those that only choose, and those that end the options
        ("-t2 -W -w", "41", "41"), ("-w -W -- -s", A8, A8), ("-W -wZ0", "EFBCA1", "41"), ("-c", "410A", "410D0A"), ("-d", "410D0A", "410A"), ("-Lm", "410A", "410D"), ("-W -w80", A8, A8),
    ],
    "long_options": [
        ("--euc --utf8-input", A8, AEUC), ("--euc-input --utf8", AEUC, A8), ("--sjis --utf8-input", A8, ASJ), ("--sjis-input --utf8", ASJ, A8), ("--jis --utf8-input", A8, "1B244224221B2842"),
        ("--jis-input --utf8", "1B244224221B2842", A8), ("--utf16 --utf8-input", A8, "FEFF3042"), ("--utf16-input --utf8", "3042", A8), ("--fj --utf8-input", A8, "1B244224221B2842"),
        ("--mac --utf8-input", A8 + "0A", ASJ + "0D"), ("--msdos --utf8-input", A8 + "0A", ASJ + "0D0A"), ("--windows --utf8-input", A8 + "0A", ASJ + "0D0A"), ("--unix --utf8-input", A8 + "0D0A", AEUC + "0A"),
        ("--mime --utf8-input", "41", "41"), ("--mime-input -w", "3D3F5554462D383F513F413F3D", "41"), ("--hiragana -W -w", "E382A2", A8), ("--katakana -W -w", A8, "E382A2"), ("--katakana-hiragana -W -w", A8 + "E382A2", "E382A2" + A8),
        ("--fb-subchar=0x40 -W -s", "E9BE9F", "40"), ("--fb-subchar=065 -W -s", "E9BE9F", "35"), ("--no-output", "41", ""), ("--cp932inv -S -s", "ED40", "FA5C"), ("--fb-skip -W -s", "E9BE9F41", "41"),
    ],
}

#: (source in hex, encoding, line ends): what a document seems to be.
GUESSED: list[tuple[str, str, str | None]] = [
    ("", "ASCII", None), ("410A", "ASCII", "LF"), ("410D0A42", "ASCII", "CRLF"), ("410D", "ASCII", "CR"), ("410D420A", "ASCII", "MIXED"),
    ("1B244224221B2842", "ISO-2022-JP", None), ("1B244224221B28420A", "ISO-2022-JP", "LF"),
    ("82A082A282A4", "Shift_JIS", None), ("8740", "CP932", None), ("A4A2A4A4", "EUC-JP", None), ("8FB0A1B0FD", "EUCJP-MS", None), ("ADA1B0FD", "CP51932", None),
    ("E38182E38184", "UTF-8", None), ("FEFF3042", "UTF-16", None), ("0000FEFF00003042", "UTF-32", None), ("82A082A282A41B244224221B2842", "BINARY", None),
]
