"""The engine's registered queries and, where DuckDB can say the same, their SQL.

All run over whole tables. The tables hold no Japanese, so queries of Japanese operators derive it from the
documents, or use rows written out here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import columns as C
from .functions import native as N
from .known import GUESSED, KNOWN
from .operators.transcoder import Transcoder, register_codecs

ASCII = "".join(chr(c) for c in range(0x30, 0x7B) if chr(c).isalnum())
WIDE = "".join(chr(ord(c) + 0xFEE0) for c in ASCII)
LETTERS = "abcdefghijklmnopqrstuvwxyz"
KATA, HIRA, HALF = "アイウエオカキクケコサシスセソタチツテトナニヌネノ", "あいうえおかきくけこさしすせそたちつてとなにぬねの", "ｱｲｳｴｵｶｷｸｹｺｻｼｽｾｿﾀﾁﾂﾃﾄﾅﾆﾇﾈﾉ"
KEYS = LETTERS[: len(KATA)]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def on_documents(name: str, make: Callable[[Column], Column], sql: str | None = None, hexed: bool = False) -> None:
    """Registers a query of one expression over all documents."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = make(F.col("text"))
        return documents(spark, sf_dir).select("doc_id", (F.hex(out) if hexed else out).alias("result"))

    QUERIES[name] = run
    if sql:
        ORACLE_SQL[name] = f"SELECT doc_id, {sql} AS result FROM documents"


def on_rows(name: str, rows: list[tuple[str, str]], make: Callable[[Column], Column], columns: tuple[str, str] = ("source", "result")) -> None:
    """Registers a query over rows of (source in hex, result), the results being known."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        data = spark.createDataFrame([(s,) for s, _ in rows], f"{columns[0]} string")
        return data.select(columns[0], make(F.unhex(columns[0])).alias(columns[1]))

    QUERIES[name] = run
    values = ", ".join(f"('{s}', '{r}')" for s, r in rows)
    ORACLE_SQL[name] = f"SELECT * FROM (VALUES {values}) AS t({columns[0]}, {columns[1]})"


KEEP = ("-W", "-w", "-m0", "-x")
for _name, _flag, _to in (("crlf", "-Lw", r"\r\n"), ("cr", "-Lm", r"\r"), ("lf", "-Lu", r"\n")):
    on_documents(f"convert_eol_{_name}", lambda t, f=_flag: C.transcode(t, *KEEP, f), rf"hex(encode(regexp_replace(text, E'\r\n|\r|\n', E'{_to}', 'g')))", hexed=True)

_ENDS = "CASE doc_id % 4 WHEN 0 THEN {n} WHEN 1 THEN {r} WHEN 2 THEN {rn} ELSE {rn} || {n} END"


def eol_guess(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = F.expr("CASE doc_id % 4 WHEN 0 THEN '\\n' WHEN 1 THEN '\\r' WHEN 2 THEN '\\r\\n' ELSE '\\r\\n\\n' END")
    docs = documents(spark, sf_dir).withColumn("text", F.replace("text", F.lit("\n"), ends))
    return docs.select("doc_id", C.eol_kind("text").alias("native"), C.guess_detail("text", "-W")["eol"].alias("kernel"))


QUERIES["eol_guess"] = eol_guess
ORACLE_SQL["eol_guess"] = (
    "SELECT doc_id, CASE WHEN text LIKE '%' || chr(10) || '%' THEN CASE doc_id % 4 WHEN 0 THEN 'LF' WHEN 1 THEN 'CR' WHEN 2 THEN 'CRLF' ELSE 'MIXED' END END AS native, native AS kernel FROM documents"
)


def wide(t: Column) -> Column:
    return F.translate(t, ASCII, WIDE)


def in_kana(t: Column, signs: str) -> Column:
    return F.translate(F.lower(t), KEYS, signs)


_kana_sql = f"translate(lower(text), '{KEYS}', '{{}}')"
on_documents("fullwidth_to_ascii", lambda t: C.transcode(wide(t), *KEEP, "-Z").cast("string"), "text")
on_documents("fullwidth_to_ascii_native", lambda t: N.narrow(wide(t)), "text")
for _k in (1, 2):
    on_documents(f"ideographic_space_{_k}", lambda t, k=_k: C.transcode(F.replace(t, F.lit(" "), F.lit("　")), *KEEP, f"-Z{k}").cast("string"), f"replace(text, ' ', '{' ' * _k}')")
    on_documents(f"ideographic_space_{_k}_native", lambda t, k=_k: N.wide_blank(F.replace(t, F.lit(" "), F.lit("　")), k), f"replace(text, ' ', '{' ' * _k}')")
_entities = "replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"
on_documents("html_escape", lambda t: C.transcode(t, *KEEP, "-Z3").cast("string"), _entities)
on_documents("html_escape_native", N.html_escape, _entities)
on_documents("half_to_full_kana", lambda t: C.transcode(in_kana(t, HALF), "-W", "-w", "-m0").cast("string"), _kana_sql.format(KATA))
on_documents("half_to_full_kana_native", lambda t: N.full_kana(in_kana(t, HALF)), _kana_sql.format(KATA))
on_documents("full_to_half_kana", lambda t: C.transcode(in_kana(t, KATA), *KEEP, "-Z4").cast("string"), _kana_sql.format(HALF))
on_documents("full_to_half_kana_native", lambda t: N.half_kana(in_kana(t, KATA)), _kana_sql.format(HALF))
on_documents("hiragana", lambda t: C.transcode(in_kana(t, KATA), *KEEP, "-h1").cast("string"), _kana_sql.format(HIRA))
on_documents("hiragana_native", lambda t: N.hiragana(in_kana(t, KATA)), _kana_sql.format(HIRA))
on_documents("katakana", lambda t: C.transcode(in_kana(t, HIRA), *KEEP, "-h2").cast("string"), _kana_sql.format(KATA))
on_documents("katakana_native", lambda t: N.katakana(in_kana(t, HIRA)), _kana_sql.format(KATA))
on_documents("swap_kana", lambda t: C.transcode(in_kana(t, HIRA), *KEEP, "-h3").cast("string"), _kana_sql.format(KATA))
on_documents("swap_kana_native", lambda t: N.swap_kana(in_kana(t, HIRA)), _kana_sql.format(KATA))
on_documents("rot13_native", N.rot13, f"translate(text, '{LETTERS}{LETTERS.upper()}', '{LETTERS[13:]}{LETTERS[:13]}{LETTERS[13:].upper()}{LETTERS[:13].upper()}')")
on_documents("rot_twice", lambda t: C.transcode(C.transcode(in_kana(t, HIRA), *KEEP, "-r"), *KEEP, "-r").cast("string"), _kana_sql.format(HIRA))

_each = "array_to_string(list_transform(string_split(text, ''), lambda x: {}), '')"
on_documents("utf8_bom", lambda t: C.transcode(t, "-W", "-w8", "-m0", "-x"), "'EFBBBF' || hex(encode(text))", hexed=True)
on_documents("utf16be_bom", lambda t: C.transcode(t, "-W", "-w16", "-m0", "-x"), "'FEFF' || " + _each.format("printf('%04X', unicode(x))"), hexed=True)
on_documents("utf16le", lambda t: C.transcode(t, "-W", "-w16L0", "-m0", "-x"), _each.format("printf('%02X%02X', unicode(x) % 256, unicode(x) // 256)"), hexed=True)
on_documents("utf32be_bom", lambda t: C.transcode(t, "-W", "-w32", "-m0", "-x"), "'0000FEFF' || " + _each.format("printf('%08X', unicode(x))"), hexed=True)
on_documents("utf32le", lambda t: C.transcode(t, "-W", "-w32L0", "-m0", "-x"), _each.format("printf('%02X%02X0000', unicode(x) % 256, unicode(x) // 256)"), hexed=True)
on_documents("utf16_input", lambda t: C.transcode(F.encode(t, "UTF-16LE"), "-W16L", "-w", "-m0", "-x").cast("string"), "text")
on_documents("utf32_input", lambda t: C.transcode(F.encode(t, "UTF-32"), "-W32", "-w", "-m0", "-x").cast("string"), "text")
on_documents("bom_kind", lambda t: C.bom_kind(F.concat(F.unhex(F.lit("EFBBBF")), t.cast("binary"))), "'UTF-8'")
on_documents("url_input", lambda t: C.transcode(F.regexp_replace(F.hex(F.encode(t, "UTF-8")), "(..)", "%$1"), "--url-input", *KEEP).cast("string"), "text")
on_documents("cap_input", lambda t: C.transcode(F.regexp_replace(F.hex(F.encode(t, "UTF-8")), "(..)", ":$1"), "--cap-input", *KEEP).cast("string"), "text")
on_documents("numchar_input", lambda t: C.transcode(F.concat(F.lit("&#12354;"), F.lit("&#x3044;"), t), "--numchar-input", *KEEP).cast("string"), "'あい' || text")
on_documents("nfc_input", lambda t: C.transcode(F.replace(in_kana(t, HIRA), F.lit("か"), F.lit("が")), "--utf8mac-input", *KEEP).cast("string"), f"replace({_kana_sql.format(HIRA)}, 'か', 'が')")

def in_words(t: Column, size: int = 30) -> Column:
    """The whole text as encoded words of ``size`` characters each, with blanks between them."""
    pieces = F.regexp_extract_all(t, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.array_join(F.transform(pieces, lambda x: F.concat(F.lit("=?UTF-8?B?"), F.regexp_replace(F.base64(F.encode(x, "UTF-8")), "[\r\n]", ""), F.lit("?="))), " ")


on_documents("mime_decode_b", lambda t: C.transcode(in_words(in_kana(t, HIRA)), "-W", "-w", "-x").cast("string"), _kana_sql.format(HIRA))
on_documents("base64_fixed", lambda t: C.transcode(t, "-W", "-wMB", "-m0", "-x").cast("string"), r"regexp_replace(base64(encode(text)), '([A-Za-z0-9+/]{72})', '\1' || chr(10), 'g')")
for _name, _out, _in in (("sjis", "-s", "-S"), ("euc", "-e", "-E"), ("jis", "-j", "-J"), ("euc_jis_2004", "--oc=EUC-JIS-2004", "--ic=EUC-JIS-2004"), ("utf16", "-w16", "-W16")):
    on_documents(f"round_trip_{_name}", lambda t, o=_out, i=_in: C.transcode(C.transcode(F.translate(in_kana(t, HIRA), "éèêàâîïôöùûüçäßñóíáúœëüÿæ¡¿ºª«»·", ""), "-W", o, "-m0", "-x"), i, "-w", "-m0", "-x").cast("string"), f"translate({_kana_sql.format(HIRA)}, 'éèêàâîïôöùûüçäßñóíáúœëüÿæ¡¿ºª«»·', '')")
    on_documents(f"guess_{_name}", lambda t, o=_out: C.guess_encoding(C.transcode(in_kana(t, HIRA), "-W", o, "-m0", "-x")))
on_documents("fold_60", lambda t: C.fold_text(t, 60, 10))
on_documents("mime_encode", lambda t: C.mime_encode(in_kana(t, HIRA), "-j").cast("string"))
on_documents("mime_round_trip", lambda t: C.transcode(C.mime_encode(F.regexp_replace(in_kana(t, HIRA), "[^あ-の]", ""), "-j"), "-J", "-w", "-x").cast("string"), f"regexp_replace({_kana_sql.format(HIRA)}, '[^あ-の]', '', 'g')")
# what Shift_JIS can't say becomes numbered characters, and these are read again
on_documents("round_trip_fallback", lambda t: C.transcode(C.transcode(in_kana(t, HIRA), "-W", "-s", "-m0", "-x", "--fb-html"), "-S", "-w", "-m0", "-x", "--numchar-input").cast("string"), _kana_sql.format(HIRA))
on_documents("quoted_printable_round_trip", lambda t: C.transcode(C.transcode(t, "-W", "-wMQ", "-m0", "-x"), "-mQ", "-W", "-w", "-x").cast("string"), "text")
on_documents("base64_round_trip", lambda t: C.transcode(C.transcode(t, "-W", "-wMB", "-m0", "-x"), "-mB", "-W", "-w", "-x").cast("string"), "text")
on_documents("fold_keeps_lines", lambda t: F.regexp_replace(C.fold_text(F.regexp_replace(t, "[^a-z\n]", ""), 60, 0, True).cast("string"), "\n", ""), "regexp_replace(text, '[^a-z]', '', 'g')")

AI = "E38182E38184"  # two hiragana, in UTF-8
on_rows("output_sjis", [(AI, "82A082A2"), ("EFBDB1", "B1"), ("E68489", "96F9")], lambda c: F.hex(C.transcode(c, "-W", "-s", "-x", "-m0")))
on_rows("output_euc", [(AI, "A4A2A4A4"), ("EFBDB1", "8EB1"), ("E68489", "CCFB")], lambda c: F.hex(C.transcode(c, "-W", "-e", "-x", "-m0")))
on_rows("output_jis", [(AI, "1B2442242224241B2842"), ("EFBDB1", "1B2849311B2842"), ("41", "41")], lambda c: F.hex(C.transcode(c, "-W", "-j", "-x", "-m0")))
on_rows("guess_rows", [("1B2442242224241B2842", "ISO-2022-JP"), ("82A082A282A482A68140", "Shift_JIS"), ("A4A2A4A4A4A6A4A8A1A1", "EUC-JP"), ("E38182E38184E38186E38188", "UTF-8"), ("616263", "ASCII"), ("FEFF3042", "UTF-16")], C.guess_encoding)
for _name, _shown in (("html", "&#40863;"), ("xml", "&#x9F9F;"), ("perl", "\\x{9F9F}"), ("java", "\\u9F9F"), ("skip", ""), ("subchar", "?")):
    on_rows(f"fallback_{_name}", [("E9BE9F41", f"{_shown}A"), (AI, "あい")], lambda c, n=_name: F.decode(C.transcode(C.transcode(c, "-W", "-s", "-x", "-m0", f"--fb-{n}"), "-S", "-w", "-x", "-m0"), "UTF-8"))


def eol_counts_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's composition: detection feeding a filter and a grouping."""
    return documents(spark, sf_dir).groupBy(C.eol_kind("text").alias("eol")).agg(F.count("*").alias("docs"))


QUERIES["eol_counts_by_kind"] = eol_counts_by_kind
ORACLE_SQL["eol_counts_by_kind"] = "SELECT CASE WHEN text LIKE '%' || chr(10) || '%' THEN 'LF' END AS eol, count(*) AS docs FROM documents GROUP BY 1"


def known_conversions(name: str) -> Query:
    """Each row by its own options; result in hex."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        data = spark.createDataFrame([(o, s) for o, s, _ in KNOWN[name]], "options string, source string")
        result = F.lit(None).cast("string")
        for options in sorted({o for o, _, _ in KNOWN[name]}):
            result = F.when(F.col("options") == options, F.hex(C.transcode(F.unhex("source"), options))).otherwise(result)
        return data.select("options", "source", result.alias("result"))

    return run


for _name, _rows in KNOWN.items():
    QUERIES[f"known_{_name}"] = known_conversions(_name)
    ORACLE_SQL[f"known_{_name}"] = "SELECT * FROM (VALUES " + ", ".join(f"('{o}', '{s}', '{r}')" for o, s, r in _rows) + ") AS t(options, source, result)"


def known_guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = spark.createDataFrame([(s,) for s, _, _ in GUESSED], "source string")
    guess = C.guess_detail(F.unhex("source"))
    return data.select("source", guess["encoding"].alias("encoding"), guess["eol"].alias("eol"), Transcoder().guess(F.unhex("source")).alias("by_transcoder"))


QUERIES["known_guesses"] = known_guesses
ORACLE_SQL["known_guesses"] = "SELECT source, encoding, eol, encoding AS by_transcoder FROM (VALUES " + ", ".join(f"('{s}', '{e}', {f"'{line}'" if line else 'NULL'})" for s, e, line in GUESSED) + ") AS t(source, encoding, eol)"


def guess_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of kana and ASCII letters, written in turn in five encodings, and what they seem to be."""
    out = {0: "-s", 1: "-e", 2: "-j", 3: "-w", 4: "-w16"}
    text = F.concat(F.lit("これはかなのぶんしょうです"), F.regexp_replace(in_kana(F.col("text"), HIRA), "[^あ-の\n]", ""))
    written = F.lit(None).cast("binary")
    for k, flag in out.items():
        mine = F.col("doc_id") % 5 == k  # a condition doesn't keep rows from a Python function, nulls do
        written = F.when(mine, C.transcode(F.when(mine, text), "-W", flag, "-m0", "-x")).otherwise(written)
    guess = C.guess_detail(written)
    return documents(spark, sf_dir).select("doc_id", guess["encoding"].alias("encoding"), guess["eol"].alias("eol"))


QUERIES["guess_documents"] = guess_documents
ORACLE_SQL["guess_documents"] = (
    "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'Shift_JIS' WHEN 1 THEN 'EUC-JP' WHEN 2 THEN 'ISO-2022-JP' WHEN 3 THEN 'UTF-8' ELSE 'UTF-16' END AS encoding, "
    "CASE WHEN text LIKE '%' || chr(10) || '%' THEN 'LF' END AS eol FROM documents"
)


def transcoder_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text through a codec and back, with what each direction consumed; and through the SQL functions of a registered one."""
    t, sql = Transcoder("-m0", "-x", encoding="EUC-JP"), register_codecs(spark)["sjis"]
    text = F.regexp_replace(in_kana(F.col("text"), HIRA), "[^あ-の\na-zA-Z]", "")
    docs = documents(spark, sf_dir).select("doc_id", text.alias("t")).select("doc_id", "t", t.encode("t").alias("e"))
    back = docs.select("doc_id", "t", "e", t.decode("e.value").alias("d"))
    return back.select("doc_id", F.col("e.consumed").alias("characters"), F.col("d.consumed").alias("bytes"), F.col("d.value").alias("result"), F.expr(f"{sql.decode}({sql.encode}(t))").alias("by_sql"))


QUERIES["transcoder_codec"] = transcoder_codec
_plain = f"regexp_replace({_kana_sql.format(HIRA)}, '[^あ-の\na-zA-Z]', '', 'g')"
ORACLE_SQL["transcoder_codec"] = f"SELECT doc_id, length(t)::INT AS characters, (length(t) + length(regexp_replace(t, '[^あ-の]', '', 'g')))::INT AS bytes, t AS result, t AS by_sql FROM (SELECT doc_id, {_plain} AS t FROM documents)"
