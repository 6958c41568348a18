"""A conversion with fixed options: convert, encode, decode, guess, and registration as SQL functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import as_binary, convert_with, guess_with, transcode
from ..functions.kernel import convert as convert_bytes
from ..plans.encodings import SHORT_NAMES
from ..plans.plan import compile_plan, option_strings


@dataclass(frozen=True)
class CodecFunctions:
    """Names of a codec's registered SQL functions."""

    name: str
    encode: str
    decode: str


class Transcoder:
    """Options, and perhaps an encoding's name, compiled once.

    ``encoding`` fixes what ``encode`` writes and ``decode`` reads. It must be a str (TypeError) that is known
    (ValueError); options must be strings (TypeError).
    """

    def __init__(self, *options: str | list[str] | tuple[str, ...], encoding: str | None = None):
        self.options: tuple[str, ...] = tuple(x for o in options for x in option_strings(o))
        if encoding is not None and not isinstance(encoding, str):
            raise TypeError("encoding must be a str or None")
        self._flags = SHORT_NAMES.get(encoding.lower().replace("-", "").replace("_", "")) if encoding is not None else None
        if encoding is not None and self._flags is None:
            raise ValueError(f"unknown encoding: {encoding}")
        self.encoding = encoding

    def _need(self) -> tuple[str, str]:
        if self._flags is None:
            raise TypeError("this needs an encoding")
        return self._flags

    def convert(self, col: Column | str) -> Column:
        return transcode(col, *self.options)

    def encode(self, col: Column | str) -> Column:
        """struct<value binary, consumed int>: text as bytes, and its characters."""
        flag, _ = self._need()
        col = F.col(col) if isinstance(col, str) else col
        return F.struct(transcode(col, *self.options, "-W", flag).alias("value"), F.char_length(col).alias("consumed"))

    def decode(self, col: Column | str) -> Column:
        """struct<value string, consumed int>: bytes as text, and how many they were."""
        _, flag = self._need()
        data = as_binary(col)
        return F.struct(F.decode(convert_with(data, compile_plan([*self.options, flag, "-w"])), "UTF-8").alias("value"), F.octet_length(data).alias("consumed"))

    def guess_detail(self, col: Column | str) -> Column:
        return guess_with(as_binary(col), compile_plan(list(self.options)))

    def guess(self, col: Column | str) -> Column:
        return self.guess_detail(col)["encoding"]

    def register(self, spark: SparkSession, name: str) -> CodecFunctions:
        """Registers ``name_encode`` (string to binary) and ``name_decode`` (binary to string) as SQL functions."""
        out_flag, in_flag = self._need()
        writes = compile_plan([*self.options, "-W", out_flag]).settled()
        reads = compile_plan([*self.options, in_flag, "-w"]).settled()

        @F.pandas_udf("binary")
        def encode(s):
            return s.map(lambda t: None if t is None else convert_bytes(t.encode(), writes))

        @F.pandas_udf("string")
        def decode(s):
            return s.map(lambda b: None if b is None else convert_bytes(bytes(b), reads).decode("utf-8", "replace"))

        spark.udf.register(f"{name}_encode", encode)
        spark.udf.register(f"{name}_decode", decode)
        return CodecFunctions(name, f"{name}_encode", f"{name}_decode")


#: Codecs that are registered together, with MIME and kana conversion off.
CODECS = {"iso2022_jp": "iso-2022-jp", "euc_jp": "euc-jp", "shift_jis": "shift_jis"}
#: Other names under which a codec can be asked for.
ALIASES = {
    "iso2022_jp": ("iso2022jp", "iso_2022_jp", "iso-2022-jp", "iso2022-jp", "iso2022_jp_1", "iso2022_jp_ext"),
    "euc_jp": ("eucjp", "euc-jp", "ujis", "u_jis", "u-jis", "euc_jp_ms"),
    "shift_jis": ("shiftjis", "shift-jis", "sjis", "s_jis", "s-jis"),
}


def register_codecs(spark: SparkSession) -> dict[str, CodecFunctions]:
    """The registered codecs by name and alias."""
    made = {name: Transcoder("-m0", "-x", encoding=encoding).register(spark, name) for name, encoding in CODECS.items()}
    return {alias: made[name] for name in made for alias in (name, *ALIASES[name])}
