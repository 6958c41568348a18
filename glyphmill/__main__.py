"""Command line: python -m glyphmill [options] files; --guess names their encodings. Without files, or for -, standard input."""

from __future__ import annotations

import sys


def arguments(args: list[str]) -> tuple[list[str], list[str], int, bool]:
    """Options, files, what is to be guessed (1: the encoding, 2: the line ends too), and whether only the version is asked for.

    ``-g``, ``-g0`` and ``-g1`` ask for the encoding, ``-g2`` to ``-g9`` and ``--guess`` for both, ``--guess=`` for the encoding if it says 0 or 1.
    """
    ends = args.index("--") if "--" in args else len(args)
    options, files, level = [], [], 0
    for a in args[:ends]:
        if not a.startswith("-") or a == "-":
            files.append(a)
        elif a in ("--help", "--version") or a[:2] in ("-v", "-V"):
            return [], [], 0, True
        elif a == "--guess":
            level = 2
        elif a.startswith("--guess="):
            level = 1 if a[8:] in ("0", "1") else 2
        elif a.startswith("-g"):
            level = 2 if a[2:3] in tuple("23456789") else 1
        else:
            options.append(a)
    return options, files + args[ends + 1 :], level, False


def told(encoding: str, eol: str | None, level: int, name: str = "") -> str:
    return f"{f'{name}: ' if name else ''}{encoding}{f' ({eol})' if eol and level > 1 else ''}"


def main(args: list[str]) -> int:
    from . import __version__
    from .functions.kernel import convert
    from .functions.kernel import guess as guess_bytes
    from .plans.plan import compile_plan

    options, files, level, version = arguments(args)
    if version:
        print(f"glyphmill {__version__}: [options] [--guess] file ...", file=sys.stderr)
        return 0
    plan = compile_plan(options).settled()
    if files in ([], ["-"]):
        data = sys.stdin.buffer.read()
        if level:
            print(told(*guess_bytes(data, compile_plan([]).settled()), level))
            return 0
        if plan.debug:
            print(guess_bytes(data, plan)[0], file=sys.stderr)
        sys.stdout.buffer.write(convert(data, plan) if options else data)
        return 0

    from pyspark.sql import SparkSession

    from .sources.files import convert_files, guess_files

    spark = SparkSession.builder.getOrCreate()
    if level:
        for r in guess_files(spark, files).orderBy("arg", "path").toLocalIterator():
            print(told(r.encoding, r.eol, level, r.path if len(files) > 1 else ""))
        return 0
    for r in convert_files(spark, files, *options).orderBy("arg", "path").toLocalIterator():
        sys.stdout.buffer.write(bytes(r.content))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
