"""Whole notices planted with edits: what must be found is found, and nothing else is."""

import random

import pytest

from linkrank.llm import licenses
from linkrank.llm.licenses import WHOLE

FILLER = "river stone morning quiet window paper garden travel seven bread letter cloud music".split()
SIZES = {one.label: len(one.words) for one in WHOLE}


def protected(template):
    """Places of a notice that stand in one of its mandatory phrases."""
    words, kept = template.words, set()
    for phrase in (template.key, *template.more):
        key = phrase.split()
        starts = [k for k in range(len(words)) if words[k : k + len(key)] == key]
        assert starts, phrase
        kept.update(k + i for k in starts for i in range(len(key)))
    return kept


def edited(template, rng, share):
    """The notice with a share of its free words replaced, left out or followed by another one."""
    kept, out = protected(template), []
    for k, word in enumerate(template.words):
        # a phrase must not be broken up by a word added inside it
        change = rng.choice("rda") if k not in kept and rng.random() < share else ""
        if change == "r":
            out.append(rng.choice(FILLER))
        elif change != "d":
            out.append(word.upper() if rng.random() < 0.2 else word)
        if change == "a" and not (k in kept and k + 1 in kept):
            out.append(rng.choice(FILLER))
    return out


def wrapped(words, rng):
    """Among other words, with comment signs and line breaks between words."""
    before = [rng.choice(FILLER) for _ in range(rng.randrange(40))]
    after = [rng.choice(FILLER) for _ in range(rng.randrange(40))]
    return "".join(w + rng.choice([" ", " ", " ", ", ", "\n * ", "\n# "]) for w in before + words + after)


def found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {
        row.doc_id: {
            m.label for m in row.licenses
            if m.n_words == SIZES.get(m.label) and m.coverage >= licenses.NOTICE_COVERAGE
        }
        for row in licenses.license_scan(docs).collect()
    }


def test_index_is_small():
    assert sum(len(one.text) for one in WHOLE) < 64_000  # it is a literal of the plan
    assert all(set(one.key_words) <= set(one.words) for one in licenses.TEMPLATES)


def test_planted_notices(spark):
    rng = random.Random(5)
    rows, expected = [], {}
    for share in (0.0, 0.05, 0.1):
        for one in WHOLE:
            for _ in range(4):
                expected[len(rows)] = one.label
                rows.append((len(rows), wrapped(edited(one, rng, share), rng)))
    labels = found(spark, rows)
    right = sum(expected[k] in labels[k] for k in expected)
    reported = sum(len(labels[k]) for k in expected)
    assert right / len(expected) >= 0.97
    assert right / reported >= 0.97


def test_a_mandatory_phrase_that_is_changed_is_no_notice(spark):
    rng = random.Random(6)
    rows, expected = [], {}
    for one in WHOLE:
        for phrase in (one.key, *one.more):
            words, key = list(one.words), phrase.split()
            for k in range(len(words)):
                if words[k : k + len(key)] == key:
                    words[k + len(key) // 2] = "changed"
            expected[len(rows)] = one.label
            rows.append((len(rows), wrapped(words, rng)))
    labels = found(spark, rows)
    assert not [k for k, label in expected.items() if label in labels[k]]


def test_phrases_alone_are_no_notice(spark):
    rng = random.Random(7)
    rows = [(k, wrapped(" ".join((one.key, *one.more)).split(), rng)) for k, one in enumerate(WHOLE)
            if len(one.words) > 60]
    assert not any(found(spark, rows).values())


@pytest.mark.parametrize("cut", [1, 3])
def test_notices_at_the_ends_of_a_text(spark, cut):
    rows = []
    for one in WHOLE:
        kept = protected(one)
        first, last = min(cut, min(kept)), min(cut, len(one.words) - 1 - max(kept))
        rows.append((len(rows), " ".join(one.words[first : len(one.words) - last])))
    labels = found(spark, rows)
    assert [one.label for k, one in enumerate(WHOLE) if one.label not in labels[k]] == []


def test_many_notices_in_one_long_text(spark):
    rng = random.Random(8)
    text = " ".join(" ".join(WHOLE[k % len(WHOLE)].words) + " " + wrapped([], rng) for k in range(800))
    row = licenses.license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    notices = [m for m in row.licenses if m.n_words == SIZES.get(m.label)]
    assert {m.label for m in notices} >= set(SIZES) and len(notices) >= 800
