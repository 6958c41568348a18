"""Column functions: conversion, detection and normalisation of documents' encodings.

Binary columns hold encoded text; a string column stands for its UTF-8 bytes. Null in, null out. Options are compiled
once, on the driver; the active session's Arrow batches are lowered (see ``batches``), and stay so. Where a plan needs no tables (see ``native``) the rows that a guard proves safe stay in the
JVM; all others go, whole documents in Arrow batches, to the kernel.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..plans.plan import Plan, compile_plan
from . import kernel, native
from .batches import small_batches

Options = str | Iterable[str]


def as_binary(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return col.cast("binary")


def convert_with(col: Column, plan: Plan) -> Column:
    """Conversion under a plan, by the kernel."""
    settled = plan.settled()
    small_batches(SparkSession.getActiveSession())

    @F.pandas_udf("binary")  # not of an iterator: each such function has a worker process of its own
    def convert(s: pd.Series) -> pd.Series:
        of = kernel.converter(settled)
        return pd.Series([None if b is None else of(bytes(b)) for b in s], dtype=object)

    return convert(col)


def transcode(col: Column | str, *options: str) -> Column:
    """The bytes of a document converted as the options say (default: detect, to UTF-8)."""
    plan = compile_plan(list(options))
    data = as_binary(col)
    if plan.no_output:
        return F.when(data.isNotNull(), F.lit(b""))
    whole = convert_with(data, plan)
    if (lowered := native.lower(data, plan)) is None:
        return whole
    guard, expression = lowered
    return F.when(guard, expression).otherwise(whole)


def guess_with(col: Column, plan: Plan) -> Column:
    settled = plan.settled()
    small_batches(SparkSession.getActiveSession())

    @F.pandas_udf("encoding string, eol string")
    def guess(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(None, None) if b is None else kernel.guess(bytes(b), settled) for b in s], columns=["encoding", "eol"])

    return F.when(col.isNotNull(), guess(col))


def guess_detail(col: Column | str, *options: str) -> Column:
    """struct<encoding, eol>: what the document's encoding and its line ends seem to be."""
    return guess_with(as_binary(col), compile_plan(list(options)))


def guess_encoding(col: Column | str, *options: str) -> Column:
    return guess_detail(col, *options)["encoding"]


def eol_kind(col: Column | str) -> Column:
    """LF, CR, CRLF or MIXED, null if there are no line ends; of ASCII-compatible text."""
    text = F.decode(as_binary(col), "ISO-8859-1")
    pairs = F.regexp_count(text, F.lit("\r\n"))
    lf, cr = F.regexp_count(text, F.lit("\n")) - pairs, F.regexp_count(text, F.lit("\r")) - pairs
    kinds = (pairs > 0).cast("int") + (lf > 0).cast("int") + (cr > 0).cast("int")
    return F.when(kinds > 1, "MIXED").when(pairs > 0, "CRLF").when(lf > 0, "LF").when(cr > 0, "CR")


def bom_kind(col: Column | str) -> Column:
    """The encoding that a byte order mark tells, or null."""
    data = as_binary(col)
    four, three, two = (F.hex(F.substring(data, 1, k)) for k in (4, 3, 2))
    return (
        F.when(four == "0000FEFF", "UTF-32BE").when(four == "FFFE0000", "UTF-32LE").when(four == "0000FFFE", "UTF-32-2143").when(four == "FEFF0000", "UTF-32-3412")
        .when(three == "EFBBBF", "UTF-8").when(two == "FEFF", "UTF-16BE").when(two == "FFFE", "UTF-16LE")
    )


def encode_text(col: Column | str, *options: str) -> Column:
    """Text to bytes; the options name the output."""
    return transcode(col, "-W", "-m0", "-x", *options)


def decode_text(col: Column | str, *options: str, errors: str = "strict") -> Column:
    """Bytes to text; the options name the input.

    ``errors`` names how the last step, from UTF-8, treats what isn't valid: strict, ignore or replace (ValueError for
    others). The kernel drops what isn't a character before that, so its UTF-8 is valid and all of them give the same.
    """
    if errors not in ("strict", "ignore", "replace"):
        raise ValueError(f"unknown error handling: {errors}")
    return F.decode(transcode(col, "-m0", "-x", *options, "-w"), "UTF-8")


def convert_eol(col: Column | str, eol: str) -> Column:
    """Line ends of UTF-8 text to one form: LF, CR or CRLF."""
    return transcode(col, "-W", "-w", "-m0", "-x", {"LF": "-Lu", "CR": "-Lm", "CRLF": "-Lw"}[eol])


def fold_text(col: Column | str, width: int = 60, margin: int = 10, keep_lines: bool = False) -> Column:
    return transcode(col, "-W", "-w", "-m0", "-x", f"-{'F' if keep_lines else 'f'}{width}-{margin}")


def mime_encode(col: Column | str, *options: str) -> Column:
    return transcode(col, "-W", "-x", "-m0", "-M", *(options or ("-w",)))


def mime_decode(col: Column | str, *options: str) -> Column:
    return transcode(col, "-x", *(options or ("-w",)))
