"""Python regular expressions and strptime formats in the dialect Spark reads."""

from __future__ import annotations

import re
import warnings

# Strptime directives and the Spark datetime pattern with the same meaning.
_DATE_LETTERS = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%I": "hh",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
    "%p": "a",
    "%b": "MMM",
    "%B": "MMMM",
    "%j": "DDD",
    "%z": "[XXX][XX]",
    "%Z": "z",
    "%%": "%",
}


def spark_datetime_format(fmt: str) -> str:
    """Translate a strptime format; a format without ``%`` is taken as a Spark pattern."""
    if "%" not in fmt:
        return fmt
    out = []
    for piece in re.findall(r"%.|[A-Za-z]+|[^%A-Za-z]+|%$", fmt):
        if piece.startswith("%"):
            if piece not in _DATE_LETTERS:
                raise ValueError(f"Unsupported date directive: {piece}")
            out.append(_DATE_LETTERS[piece])
        elif piece.isalpha():
            out.append(f"'{piece}'")
        else:
            out.append(piece.replace("'", "''"))
    return "".join(out)


# One lexical unit of a Python pattern: an escape, a special group opening, the short
# quantifier {,n}, or any single character.
_UNIT = re.compile(
    r"(?P<escape>\\(?:u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|x[0-9a-fA-F]{2}|N\{[^}]*\}|.))"
    r"|(?P<named>\(\?P<(?P<group>\w+)>)"
    r"|(?P<backref>\(\?P=(?P<ref>\w+)\))"
    r"|(?P<refused>\(\?[(#])"
    r"|(?P<upto>\{,(?=\d+\}))"
    r"|(?P<char>.)",
    re.S,
)
_LEADING_FLAGS = re.compile(r"\A\(\?([aiLmsux]+)\)")
_UNICODE_CLASSES = re.compile(r"\\[dDwWsSbB]")


def spark_regex(pattern: str, flags: int = 0) -> str:
    """A Java pattern for ``rlike`` that accepts exactly what ``re.match`` accepts.

    Raises ``ValueError`` for a pattern Python rejects or Java cannot express.
    """
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore", FutureWarning)  # sets are escaped below
            compiled = re.compile(pattern, flags)
    except re.error as e:
        raise ValueError(f"Invalid regex pattern: {e}") from e
    body = _LEADING_FLAGS.sub("", pattern)
    group_name = {n: re.sub(r"[^A-Za-z0-9]", "", f"g{i}{n}") for n, i in compiled.groupindex.items()}

    out: list[str] = []
    in_class, class_start = False, False
    for unit in _UNIT.finditer(body):
        text = unit.group()
        if unit["escape"]:
            out.append(_escape(text))
            class_start = False
        elif in_class:
            if text == "]" and not class_start:
                in_class = False
                out.append(text)
            elif text == "^" and class_start and out[-1] == "[":
                out.append(text)
                continue  # a "]" may still be the first member
            else:
                out.append("".join("\\" + ch if ch in "[]&#" else ch for ch in text))
            class_start = False
        elif unit["named"]:
            out.append(f"(?<{group_name[unit['group']]}>")
        elif unit["backref"]:
            out.append(f"\\k<{group_name[unit['ref']]}>")
        elif unit["refused"]:
            raise ValueError(f"Unsupported regex construct {text!r} in pattern {pattern!r}")
        elif unit["upto"]:
            out.append("{0,")
        else:
            in_class = class_start = text == "["
            out.append(text)

    java_flags = "d"
    for bit, letter in ((re.M, "m"), (re.S, "s"), (re.X, "x")):
        if compiled.flags & bit:
            java_flags += letter
    ascii_only = bool(compiled.flags & re.A)
    if compiled.flags & re.I:
        java_flags += "i" if ascii_only else "iu"
    if not ascii_only and _UNICODE_CLASSES.search(body):
        java_flags += "U"
    if compiled.flags & re.X:
        out.append("\n")  # ends a comment that would hide the closing bracket
    return f"(?{java_flags})\\A(?:{''.join(out)})"


def _escape(text: str) -> str:
    kind = text[1]
    if kind == "Z":
        return r"\z"
    if kind == "v":
        return r"\x0B"
    if kind == "U":
        return r"\x{" + text[2:] + "}"
    if kind == "N" or kind == "0":
        raise ValueError(f"Unsupported regex escape {text!r}")
    return text
