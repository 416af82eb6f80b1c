"""License scans with a positional index of rare words, in DataFrame functions only.

Every template is indexed under the words of its first key phrase that are rarest in the corpus. A
file is looked up by those words alone: the rarest one proposes where the template would begin, the
postings of the others must agree on that place, and the key phrase is verified word by word. The
other key phrases must stand around that place as they are; the rest of a template may be edited.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import ascii_lower, free_name
from linkrank.llm.license_notices import NOTICES

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
INDEX_WORDS = 3  # rare words of a key phrase that must agree
COVERAGE = 0.5  # share of a passage's different words that must stand around its place
NOTICE_COVERAGE = 0.75  # the same of a whole notice
SLACK = 4  # words may be moved by a part of this many of a template's, and two more


@dataclass(frozen=True)
class Template:
    """A license passage or notice; ``key`` and the phrases of ``more`` must be there word for word."""

    label: str
    text: str
    key: str
    more: tuple[str, ...] = ()
    coverage: float = COVERAGE

    @property
    def words(self) -> list[str]:
        return [word for word in re.split(SEPARATORS, self.text.lower()) if word]

    @property
    def different(self) -> list[str]:
        return sorted(set(self.words))

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_start(self) -> int:
        words, key = self.words, self.key_words
        return next(k for k in range(len(words)) if words[k : k + len(key)] == key)

    @property
    def slack(self) -> int:
        """Words by which edits may have moved others."""
        return len(self.words) // SLACK + 2 if self.words != self.key_words else 0


# Phrases whose every place counts, and their labels.
BASE = (
    Template("cc-by", "cc by", "cc by"),
    Template("gpl", "general public license", "general public license"),
    Template("reserved", "all rights reserved", "all rights reserved"),
)

# Passages of common licenses with their mandatory phrases.
MORE = (
    Template("agpl", "gnu affero general public license", "affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0",
             "apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without"
             " modification are permitted", "redistribution and use in source and binary forms"),
    Template("cc", "licensed under a creative commons attribution", "creative commons"),
    Template("cc-by-nc", "cc by nc", "cc by nc"),
    Template("cc-by-sa", "cc by sa", "cc by sa"),
    Template("cc0", "dedicated to the public domain under cc0", "under cc0"),
    Template("isc", "permission to use copy modify and or distribute this software for any"
             " purpose with or without fee is hereby granted",
             "permission to use copy modify and or distribute"),
    Template("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of"
             " this software", "permission is hereby granted free of charge"),
    Template("mit", "released under the mit license", "mit license"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0",
             "mozilla public license"),
    Template("no-warranty", "provided as is without warranty of any kind",
             "without warranty of any kind"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software"),
)
WHOLE = tuple(
    Template(label, text, key, tuple(more), NOTICE_COVERAGE) for label, (key, *more), text in NOTICES
)
TEMPLATES = (*BASE, *MORE, *WHOLE)


def words_of(text: Column) -> Column:
    """The words of a text; null is empty."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.filter(parts, lambda word: word != "")


def inverse_frequencies(words: DataFrame, column: str, templates=TEMPLATES) -> dict[str, float]:
    """IDF of the key phrases' words over all rows, from one aggregate of as many rows as words."""
    vocabulary = sorted({word for one in templates for word in one.key_words})
    literal = F.array(*(F.lit(word) for word in vocabulary))
    present = F.array_append(F.array_intersect(column, literal), F.lit(""))  # "" counts the rows
    counts = words.select(F.explode(present).alias("word")).groupBy("word").count()
    found = {row[0]: row[1] for row in counts.collect()}
    n = found.get("", 0)
    return {word: math.log((1 + n) / (1 + found.get(word, 0))) for word in vocabulary}


def _index(templates, idf: dict[str, float]) -> list[list[tuple[str, int]]]:
    """Per template, its rarest key words with their places in it, the rarest first."""
    index = []
    for one in templates:
        start, places = one.key_start, {}
        for k, word in enumerate(one.key_words):
            places.setdefault(word, start + k)
        rare = sorted(places.items(), key=lambda x: (-idf[x[0]], x[1]))
        index.append(rare[:INDEX_WORDS])
    return index


NO_WORDS = "CAST(array() AS array<string>)"


def _quoted(words: list[str]) -> str:
    return "array(" + ", ".join(f"'{word}'" for word in words) + ")"


def matches(words: str, templates, idf: dict[str, float]) -> Column:
    """All places of all templates: an array of ``template, start, coverage``."""
    rows, postings = [], {}
    for t, (one, rare) in enumerate(zip(templates, _index(templates, idf), strict=True)):
        places = ", ".join(f"named_struct('word', '{w}', 'at', {k})" for w, k in rare)
        more = _quoted([f" {phrase} " for phrase in one.more]) if one.more else NO_WORDS
        rows.append(
            f"named_struct('key', {_quoted(one.key_words)}, 'key_start', {one.key_start},"
            f" 'rare', array({places}), 'more', {more}, 'different', {_quoted(one.different)},"
            f" 'before', {one.slack}, 'after', {len(one.words) + one.slack},"
            f" 'least', {one.coverage}D)"
        )
        postings.setdefault(rare[0][0], []).append(f"named_struct('t', {t}, 'at', {rare[0][1]})")
    table = f"array({', '.join(rows)})"
    looked_up = ", ".join(f"'{word}'" for word in sorted(postings))
    lists = ", ".join(f"'{word}', array({', '.join(found)})" for word, found in postings.items())
    hits = f"filter(sequence(0, size({words}) - 1), i -> get({words}, i) IN ({looked_up}))"
    proposed = (
        f"flatten(transform({hits}, i -> transform(map({lists})[get({words}, i)],"
        " p -> named_struct('t', p.t, 'start', i - p.at))))"
    )
    # the part of the template before the key phrase may be cut off by the text's beginning
    with_rows = (
        f"transform({proposed}, c -> named_struct('t', c.t, 'start', c.start,"
        f" 'row', get({table}, c.t)))"
    )
    agreed = (
        f"filter({with_rows}, c -> c.start + c.row.key_start >= 0"
        f" AND forall(c.row.rare, r -> get({words}, c.start + r.at) <=> r.word)"
        f" AND slice({words}, c.start + c.row.key_start + 1, size(c.row.key)) = c.row.key)"
    )
    first = "greatest(c.start - c.row.before, 0)"
    around = (
        f"transform({agreed}, c -> named_struct('t', c.t, 'start', c.start, 'row', c.row, 'part',"
        f" slice({words}, {first} + 1, greatest(c.start + c.row.after - {first}, 0))))"
    )
    complete = (
        f"filter({around}, c -> size(c.row.more) = 0 OR forall(c.row.more,"
        " phrase -> contains(concat(' ', array_join(c.part, ' '), ' '), phrase)))"
    )
    covered = (
        f"transform({complete}, c -> named_struct('template', c.t, 'start', c.start, 'coverage',"
        " CAST(size(array_intersect(c.row.different, c.part)) AS DOUBLE) / size(c.row.different),"
        " 'least', c.row.least))"
    )
    found = (
        f"transform(filter({covered}, m -> m.coverage >= m.least), m ->"
        " named_struct('template', m.template, 'start', m.start, 'coverage', m.coverage))"
    )
    nothing = "CAST(array() AS array<struct<template:int,start:int,coverage:double>>)"
    return F.expr(f"CASE WHEN size({words}) = 0 THEN {nothing} ELSE {found} END")


def license_scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """The other columns of ``docs`` with ``n_words`` and ``licenses``.

    ``licenses`` is an array of ``label, base, start, n_words, coverage``, one for every place of a
    template in the text, words counted from 0; ``base`` marks the fixed phrases and ``coverage`` is
    the share of the template's different words around that place. A notice is found whole: words
    outside its key phrases may be replaced, left out or added. Null and empty
    texts have no words and no licenses, repeated rows get equal results. The corpus is read
    twice: once for the words' frequencies and once for the look-up; nothing is shuffled but counts.
    """
    kept = [name for name in docs.columns if name not in (text, "n_words", "licenses")]
    words = free_name(kept, "license_words")
    found = free_name(kept, "license_places")
    split = docs.select(*kept, words_of(F.col(text)).alias(words))
    idf = inverse_frequencies(split, words)
    placed = split.select(
        *kept,
        F.size(words).cast("long").alias("n_words"),
        matches(words, TEMPLATES, idf).alias(found),
    )
    labels = F.array(*(F.lit(one.label) for one in TEMPLATES))
    sizes = F.array(*(F.lit(len(one.words)) for one in TEMPLATES))
    return placed.select(
        *kept,
        "n_words",
        F.transform(
            found,
            lambda m: F.struct(
                F.get(labels, m["template"]).alias("label"),
                (m["template"] < len(BASE)).alias("base"),
                m["start"].alias("start"),
                F.get(sizes, m["template"]).alias("n_words"),
                m["coverage"].alias("coverage"),
            ),
        ).alias("licenses"),
    )
