"""Runs reported as random: planted keys against names and paths with digits, encoded prose, sequences, repeats."""

import base64
import random
import string
from collections import Counter

import pytest

from linkrank.llm import secrets

WORDS = ("get user account name list parse value table index load window frame order line customer"
         " document page text count reader writer stream config server client request response").split()
LETTERS = string.ascii_letters + string.digits


def key(rng, kind):
    n = rng.choice([32, 40, 48, 64])
    if kind == "base64":
        return "".join(rng.choice(LETTERS + "+/") for _ in range(n))
    return "".join(rng.choice(LETTERS) for _ in range(n))


def impostor(rng, kind):
    """A run that has digits and letters, as keys do, and is none."""
    words = rng.choices(WORDS, k=rng.randrange(4, 9))
    if kind == "identifier":
        return "".join(w.title() for w in words) + str(rng.randrange(10, 5000))
    if kind == "snake":
        return "_".join(words).upper() + f"_v{rng.randrange(10)}_{rng.choice(WORDS)}"
    if kind == "path":
        return f"/{words[0].title()}/{rng.randrange(2000, 2030)}/{rng.randrange(10, 13)}/" + "/".join(words[1:])
    if kind == "encoded":
        return base64.b64encode(" ".join(words).encode()).decode().rstrip("=")
    if kind == "repeat":
        return ("".join(rng.choice(LETTERS) for _ in range(3)) + "a7Q") * 7
    return LETTERS[rng.randrange(25) :]  # an alphabet in order


KEYS = ("base64", "letters")
IMPOSTORS = ("identifier", "snake", "path", "encoded", "repeat", "alphabet")


@pytest.fixture(scope="module")
def outcome(spark):
    """Per kind, how many were planted and how many of them were reported."""
    rng = random.Random(11)
    rows, planted = [], []
    for k in range(2_000):
        real = k % 4 == 0
        kind = rng.choice(KEYS if real else IMPOSTORS)
        run = key(rng, kind) if real else impostor(rng, kind)
        if len(run) < 20:
            continue
        before = " ".join(rng.choices(WORDS, k=rng.randrange(12)))
        planted.append((len(rows), kind, len(before) + 1, len(before) + 1 + len(run)))
        rows.append((len(rows), f"{before} {run} " + " ".join(rng.choices(WORDS, k=6))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {
        (r.doc_id, s.start, s.end)
        for r in secrets.secret_spans(docs).collect() for s in r.secrets if s.kind == 3
    }
    return (
        Counter(kind for _, kind, _, _ in planted),
        Counter(kind for i, kind, a, b in planted if any(f[0] == i and f[1] < b and a < f[2] for f in found)),
    )


def test_planted_keys_are_found(outcome):
    planted, found = outcome
    recall = sum(found[kind] for kind in KEYS) / sum(planted[kind] for kind in KEYS)
    assert recall >= 0.9


def test_most_of_what_is_reported_is_a_key(outcome):
    planted, found = outcome
    precision = sum(found[kind] for kind in KEYS) / sum(found.values())
    assert precision >= 0.65
    assert found["repeat"] + found["alphabet"] <= 0.05 * (planted["repeat"] + planted["alphabet"])
