"""One document, whole: bytes to bytes under a settled plan, and what its encoding seems to be.

Valid plain text goes character by character through tables (see ``charwise``); ``convert_whole`` and ``guess_whole`` take
every document, as a list of characters.
"""

from __future__ import annotations

from ..plans.plan import Plan
from . import charwise, detect
from .decode import decode
from .encode import encode
from .transform import eol_name, transform


def converter(plan: Plan):
    """The conversion of documents under a plan."""
    tables = charwise.converter(plan)

    def convert(data: bytes) -> bytes:
        out = tables.convert(data) if tables else None
        return convert_whole(data, plan) if out is None else out

    return convert


def convert(data: bytes, plan: Plan) -> bytes:
    return converter(plan)(data)


def convert_whole(data: bytes, plan: Plan) -> bytes:
    codes, _ = decode(data, plan)
    if plan.no_output:
        return b""
    return encode(transform(codes, plan), plan)


def guess(data: bytes, plan: Plan) -> tuple[str, str | None]:
    """The encoding's name, and that of the line ends (none if there are none)."""
    return charwise.guess(data, plan) or guess_whole(data, plan)


def guess_whole(data: bytes, plan: Plan) -> tuple[str, str | None]:
    codes, seen = decode(data, plan)
    return detect.refined(seen.name, seen.marks), eol_name(codes)
