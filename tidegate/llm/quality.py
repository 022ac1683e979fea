"""Line-first quality rules.

Each line with a word is judged by itself or, for menus, with its neighbours.  These lines fail
and are removed (a word is a run of anything but ASCII white space, a line is parted by ``\\n``):

* *symbols*: four words or more, and one of ``#*$%&<>`` for each word or more;
* *shouting*: four words or more, and ``!!`` for every second word or more;
* *bars*: four words or more, and ``|`` for every fifth word or more;
* *separators*: four words or more, at least two and at least every fifth of them one of
  ``SEPARATORS`` alone (a closing guillemet counts only beyond the opening ones);
* *punctuation share*: half of the bytes in words, or more, are ASCII punctuation;
* *word list*: forty words or more and no punctuation whatever;
* *line end*: four words or more, cut off by an ellipsis;
* *menu*: five lines or more in a row (lines without words between them do not count), each of at most
  three words and without punctuation at its end;
* *boilerplate*: a known phrase.

So headings, lists of longer items and verse stay; verse of five lines of at most three words
without a mark at any end is taken for a menu.  A document is rejected when the removed lines hold more
than ``max_lost`` percent of its words, or when it fails a rule on the whole text (too few words, too
much repetition).

Null texts count as having no words; they fail.  Repeated rows are judged one by one.  A column
that bears the name of an output column is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import SPACES, text_or_empty

SYMBOLS = "#*$%&|<>"
#: Lines that are boilerplate, whatever else they say.
BOILERPLATE = (
    r"(?ai)(all rights reserved|licensed under|released under the|terms of (use|service)|privacy policy|cookie policy"
    r"|accept (all )?cookies|subscribe to our|sign up for our|click here to|javascript (is|must be) (disabled|enabled))"
)
#: Every boilerplate phrase holds one of these in lower case; texts without them need no search.
BOILERPLATE_WORDS = ("rights", "licensed", "released", "terms", "privacy", "cookie", "subscribe", "sign up", "click", "javascript")
#: Words that part the items of a navigation line, and the marks that end a line.
SEPARATORS = ("·", "•", "/", ">", "::", "→", "»", "›")
OPENING = {"»": "«", "›": "‹"}
END_MARKS = ".!?:;,…。！？；：，、؟۔।"
CLOSERS = "\"')]}»”’"
ASCII_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: A line with at least so many words can be a navigation, symbol, shouted or cut-off line.
LEAST_LINE_WORDS = 4
LEAST_LIST_WORDS = 40
MOST_ITEM_WORDS = 3
LEAST_ITEMS = 5
MIN_WORDS = 50
MAX_REPEATED = 50
MAX_LOST = 50

RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lost_words long, "
    "n_removed_lines long, base_failed boolean, kept boolean, clean_text string"
)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_boilerplate = re.compile(BOILERPLATE).search
_mark = re.compile(f"[{re.escape(END_MARKS)}]").search
_space = "".join(SPACES)
_separators = frozenset(s.encode() for s in SEPARATORS)


def n_separators(words: list[bytes]) -> int:
    """Words that are separators; closing ones without an opening one."""
    if _separators.isdisjoint(words):
        return 0
    n = 0
    for mark in SEPARATORS:
        n += max(0, words.count(mark.encode()) - (words.count(OPENING[mark].encode()) if mark in OPENING else 0))
    return n


def line_end(line: str) -> str:
    """The line without white space and closing quotes and brackets at its end."""
    return line.rstrip(_space).rstrip(CLOSERS)


def line_fails(line: str, boilerplate: bool = True) -> bool:
    """All rules but the menu's."""
    code = line.encode()
    words = code.split()
    n = len(words)
    letters = sum(map(len, words))
    marks = len(code) - len(code.translate(None, ASCII_MARKS))
    if 2 * marks >= letters:
        return True
    if n >= LEAST_LINE_WORDS:
        if marks:
            bars = line.count("|")
            if 5 * bars >= n or sum(map(line.count, "#*$%&<>")) >= n or 2 * line.count("!!") >= n:
                return True
        separators = n_separators(words)
        if separators > 1 and 5 * separators >= n:
            return True
        if n >= LEAST_LIST_WORDS and not marks and not _mark(line):
            return True
        if line_end(line).endswith(("...", "…")):
            return True
    return boilerplate and _boilerplate(line) is not None


def is_item(line: str, words: int) -> bool:
    """Whether the line may be one of a menu: few words and no mark at its end."""
    return words <= MOST_ITEM_WORDS and (line_end(line) or " ")[-1] not in END_MARKS


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    if len(words) < 4:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = (h[:-2] * _MIX[0] + h[1:-1]) * _MIX[1] + h[2:]
    ordered = np.sort(mixed)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0  # equal windows have equal hashes
    at = np.flatnonzero(np.isin(mixed, twice)).tolist()
    counts = Counter((words[k], words[k + 1], words[k + 2]) for k in at)
    n, end = 0, 0
    for k in at:
        if counts[words[k], words[k + 1], words[k + 2]] > 1:
            n += k + 3 - max(k, end)
            end = k + 3
    return n


def judge(text: str, min_words: int, max_repeated: int, max_lost: int) -> tuple:
    words = text.encode().split()
    n, duplicates = len(words), 0
    seen: set[str] = set()
    low = text.lower()
    boilerplate = any(word in low for word in BOILERPLATE_WORDS)
    lines = text.split("\n")
    sizes = [len(line.encode().split()) for line in lines]
    failed_lines: set[int] = set()
    items: list[int] = []
    for k, (line, size) in enumerate(zip(lines, sizes)):
        if not size:
            continue
        if line in seen:
            duplicates += 1
        seen.add(line)
        if line_fails(line, boilerplate):
            failed_lines.add(k)
        if is_item(line, size):
            items.append(k)
            continue
        if len(items) >= LEAST_ITEMS:
            failed_lines.update(items)
        items = []
    if len(items) >= LEAST_ITEMS:
        failed_lines.update(items)
    lost = sum(sizes[k] for k in failed_lines)
    repeated = repeated_words(words)
    failed = n < min_words or 100 * repeated > max_repeated * n
    return (
        n,
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        duplicates,
        repeated,
        lost,
        len(failed_lines),
        failed,
        not failed and 100 * lost <= max_lost * n,
        "\n".join([line for k, line in enumerate(lines) if k not in failed_lines]) if failed_lines else text,
    )


def quality(
    df: DataFrame, text: str = "text", min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED, max_lost: int = MAX_LOST
) -> DataFrame:
    """All columns of ``df`` and those of ``RESULT``: counts, verdicts and the text without its failed lines.

    ``base_failed``: under ``min_words`` words, or over ``max_repeated`` percent of them in three-word
    windows found twice.  ``kept``: not so, and at most ``max_lost`` percent of the words are in removed
    lines.  One pass, no shuffle.
    """
    names = [part.split()[0] for part in RESULT.split(", ")]

    @F.pandas_udf(RESULT)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([judge(t, min_words, max_repeated, max_lost) for t in texts], columns=names)

    rest = [c for c in df.columns if c.lower() not in names]
    whole = F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row")
    return df.select(whole, judged(text_or_empty(text)).alias("found")).select(*[F.col(f"row.`{c}`") for c in rest], "found.*")
