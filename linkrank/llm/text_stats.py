"""Counts over whole texts, as the quality operators use them."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from linkrank.llm.common import free_name, pieces

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
ENDS = ".!?"
WINDOW = 8

COUNTS = (
    "n_words",  # runs of non-blanks
    "word_chars",  # code points in them
    "n_symbols",  # characters of SYMBOLS
    "n_dup_lines",  # lines with a word that equal an earlier line
    "n_repeat_words",  # words in windows of WINDOW words that occur twice or more
    "n_lines",  # lines with a word
    "n_letters",
    "n_upper",  # letters in upper case
    "n_digits",
    "n_alpha_words",  # words with a letter
    "n_stutters",  # words equal to the one before
    "n_distinct",  # distinct words
    "n_ends",  # characters of ENDS
    "n_shouts",  # exclamation marks
    "n_other",  # characters that are no letter, digit or blank
)


@lru_cache(maxsize=1)
def character_kinds() -> np.ndarray:
    """Per code point: 1 a letter, 2 one in upper case, 3 a digit 0-9, 0 anything else."""
    kinds = np.zeros(0x110000, "u1")
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            kinds[code] = 2 if char.isupper() else 1
    kinds[ord("0") : ord("9") + 1] = 3
    return kinds


def repeated_window_words(codes: np.ndarray, window: int = WINDOW) -> int:
    """How many words stand in a window whose words occur as a window twice or more.

    Windows of 2, 4 and 8 words are numbered from the numbers of their halves, so equal numbers
    are equal windows, without a hash that could collide. ``window`` is a power of two.
    """
    n = len(codes)
    if n <= window:
        return 0
    step, ranks = 1, codes
    while step < window:
        keys = ranks[:-step] * (ranks.max() + 1) + ranks[step:]
        ranks = np.unique(keys, return_inverse=True)[1]
        step *= 2
        if ranks.max() + 1 == len(ranks):
            return 0
    repeated = np.bincount(ranks)[ranks] > 1
    edge = np.zeros(n + 1, "i8")
    edge[: len(ranks)] += repeated
    edge[window:] -= repeated[: n + 1 - window]
    return int(np.count_nonzero(np.cumsum(edge)[:n]))


def text_counts(text: str | None) -> tuple[int, ...]:
    """The COUNTS of one text; a null text has none of anything."""
    text = text or ""
    words = WORD.findall(text)
    known: dict[str, int] = {}
    codes = np.fromiter((known.setdefault(word, len(known)) for word in words), "i8", len(words))
    seen: set[str] = set()
    lines = dup_lines = 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            dup_lines += line in seen
            seen.add(line)
    kinds = np.bincount(character_kinds()[np.frombuffer(text.encode("utf-32-le"), "<u4")], minlength=4)
    letters, upper, digits = int(kinds[1] + kinds[2]), int(kinds[2]), int(kinds[3])
    chars = sum(map(len, words))
    alphabetic = np.fromiter((any(map(str.isalpha, word)) for word in known), "?", len(known))
    return (
        len(words),
        chars,
        sum(map(text.count, SYMBOLS)),
        dup_lines,
        repeated_window_words(codes),
        lines,
        letters,
        upper,
        digits,
        int(alphabetic[codes].sum()),
        int(np.count_nonzero(codes[1:] == codes[:-1])),
        len(known),
        sum(map(text.count, ENDS)),
        text.count("!"),
        max(0, chars - letters - digits),
    )


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the COUNTS of its text instead of the text."""

    def columns(counts: np.ndarray) -> list[pa.Array]:
        return [pa.array(column) for column in counts.T]

    return derived(docs, text, {name: "long" for name in COUNTS}, columns)


def derived(
    docs: DataFrame,
    text: str,
    new: dict[str, str | DataType],
    columns: Callable[[np.ndarray], list[pa.Array]],
    keep_text: bool = False,
) -> DataFrame:
    """``docs`` with ``new`` columns made from the counts of its text, a row of COUNTS per text.

    Columns of ``docs`` with these names give way to the new ones.
    """
    kept = [c for c in docs.columns if c not in new and (keep_text or c != text)]
    content = text if keep_text else free_name(kept, "text")
    source = docs.select(*kept) if keep_text else docs.select(*kept, F.col(text).alias(content))
    schema = docs.select(*kept).schema
    for name, kind in new.items():
        schema = schema.add(name, kind)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                rows = [text_counts(x) for x in part.column(content).to_pylist()]
                arrays = [part.column(name) for name in kept]
                arrays += columns(np.array(rows, "i8").reshape(-1, len(COUNTS)))
                yield pa.RecordBatch.from_arrays(arrays, [*kept, *new])

    return source.mapInArrow(count, schema)
