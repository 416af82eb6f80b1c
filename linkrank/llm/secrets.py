"""Secret scans in DataFrame functions only: known shapes, and runs that pass for random.

Runs of encoded characters are tested for randomness: uniform use of the alphabet (chi-squared),
number of runs above and below its middle, and serial correlation. A Benjamini-Hochberg procedure per class
of lengths over all runs of the corpus decides which are not random; what stays is
reported. Short runs have little evidence against them, so their class has a stricter level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import free_name, running
from linkrank.plans import Scratch

# The known shapes, in the order in which they are listed.
ASSIGN = (
    r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # as whole runs of these characters, of which 24 or more are reported
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "random")

RUN = r"[A-Za-z0-9+/_-]{20,}"
BINS = 8  # parts of the alphabet whose use is compared
LEVEL = 2.0  # the level of a class is this by its shortest length, LEVEL_MOST at most
LEVEL_MOST = 0.1
GRID = 2_000  # steps of the p-values
MASK = "[SECRET]"
SPANS = "array<struct<start:int,kind:int,end:int>>"

UPPER, LOWER, DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"


def _spans(text: str, pattern: str, kind: int, group: int = 0) -> Column:
    """``start, kind, end, value`` of all matches, leftmost and without overlap, in code points.

    The text splits into what is between the matches; lengths of these parts and of the matches
    add up to the places.
    """
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    found = f"regexp_extract_all({text}, '{quoted}', 0)"
    values = "f" if not group else f"regexp_extract_all({text}, '{quoted}', {group})"
    # a match ends after all parts and matches up to it
    sizes = "transform(f, (m, k) -> char_length(get(parts, k)) + char_length(m))"
    spans = f"""get(transform(array({found}), f -> get(transform(array({values}), w ->
        get(transform(array(split({text}, '{quoted}', -1)), parts ->
        get(transform(array({running(sizes, "int")}), ends -> transform(f, (m, k) -> named_struct(
            'start', get(ends, k) - char_length(m), 'kind', {kind}, 'end', get(ends, k),
            'value', get(w, k)))), 0)), 0)), 0)), 0)"""
    nothing = "CAST(array() AS array<struct<start:int,kind:int,end:int,value:string>>)"
    return F.expr(f"CASE WHEN {text} RLIKE '{quoted}' THEN {spans} ELSE {nothing} END")


def _normal_tail(z: str) -> str:
    """P(Z > z) for z >= 0 (polynomial of Zelen and Severo), else 1 - P(Z > -z)."""
    t = f"(1 / (1 + 0.2316419D * abs({z})))"
    poly = (
        f"({t} * (0.319381530D + {t} * (-0.356563782D + {t} * (1.781477937D"
        f" + {t} * (-1.821255978D + {t} * 1.330274429D)))))"
    )
    tail = f"(exp(-({z}) * ({z}) / 2) * 0.3989422804014327D * {poly})"
    return f"IF({z} >= 0, {tail}, 1 - {tail})"


def _battery(runs: str) -> Column:
    """Adds ``n`` and ``p`` to runs whose encoding can be told; the others are words."""
    classes = (
        "named_struct('start', r.start, 'end', r.end, 'kind', r.kind, 'value', r.value,"
        " 'alphabet', CASE"
        " WHEN NOT (r.value RLIKE '[0-9]' AND r.value RLIKE '[A-Za-z]') THEN ''"
        f" WHEN r.value RLIKE '^([0-9a-f]+|[0-9A-F]+)$' THEN '{DIGIT}abcdef'"
        f" WHEN r.value RLIKE '^[A-Z2-7]+$' THEN '{UPPER}234567'"
        f" WHEN r.value RLIKE '^[A-Z0-9]+$' THEN '{DIGIT}{UPPER}'"
        f" WHEN r.value RLIKE '^[a-z0-9]+$' THEN '{DIGIT}{LOWER}'"
        " WHEN NOT (r.value RLIKE '[a-z]' AND r.value RLIKE '[A-Z]') THEN ''"
        f" WHEN r.value RLIKE '^[A-Za-z0-9]+$' THEN '{UPPER}{LOWER}{DIGIT}'"
        f" WHEN r.value RLIKE '[_-]' THEN '{UPPER}{LOWER}{DIGIT}-_'"
        f" ELSE '{UPPER}{LOWER}{DIGIT}+/' END)"
    )
    # hexadecimal digits count in either case; '+/' and '-_' may be mixed: unknown characters are 0
    coded = (
        "named_struct('start', r.start, 'end', r.end, 'kind', r.kind, 'a', char_length(r.alphabet),"
        " 'x', transform(regexp_extract_all(IF(char_length(r.alphabet) = 16, lower(r.value), r.value),"
        " '.', 0), c -> greatest(0, locate(c, r.alphabet) - 1)))"
    )
    counted = (
        "named_struct('start', r.start, 'end', r.end, 'kind', r.kind, 'n', size(r.x),"
        f" 'square', aggregate(transform(sequence(0, {BINS - 1}), b -> size(filter(r.x, v ->"
        f" v * {BINS} DIV r.a = b))), 0.0D, (s, c) -> s + 1.0D * c * c),"
        " 'above', size(filter(r.x, v -> 2 * v >= r.a)),"
        " 'runs', 1 + size(filter(sequence(1, size(r.x) - 1), i ->"
        " (2 * get(r.x, i) >= r.a) <> (2 * get(r.x, i - 1) >= r.a))),"
        " 'mean', aggregate(r.x, 0.0D, (s, v) -> s + v) / size(r.x), 'x', r.x)"
    )
    moments = (
        "named_struct('start', r.start, 'end', r.end, 'kind', r.kind, 'n', r.n, 'square', r.square,"
        " 'above', r.above, 'runs', r.runs,"
        " 'var', aggregate(r.x, 0.0D, (s, v) -> s + (v - r.mean) * (v - r.mean)),"
        " 'cov', aggregate(sequence(1, r.n - 1), 0.0D, (s, i) -> s +"
        " (get(r.x, i) - r.mean) * (get(r.x, i - 1) - r.mean)))"
    )
    df = BINS - 1
    wilson = (
        f"(power(({BINS}.0D * r.square / r.n - r.n) / {df}, 1.0D / 3) - (1 - 2.0D / (9 * {df})))"
        f" / sqrt(2.0D / (9 * {df}))"
    )
    product = "(2.0D * r.above * (r.n - r.above))"
    runs_z = (
        f"abs(r.runs - ({product} / r.n + 1)) / sqrt(greatest(1e-9D, {product} * ({product} - r.n)"
        " / (1.0D * r.n * r.n * (r.n - 1))))"
    )
    serial_z = "abs(r.cov / greatest(1e-9D, r.var) + 1.0D / r.n) * sqrt(1.0D * r.n)"
    z = (
        "named_struct('start', r.start, 'end', r.end, 'kind', r.kind, 'n', r.n,"
        f" 'uniform', {wilson}, 'runs', {runs_z}, 'serial', {serial_z})"
    )
    chances = (
        "named_struct('start', r.start, 'end', r.end, 'kind', r.kind, 'n', r.n, 'p',"
        f" least(1.0D, 3 * least({_normal_tail('r.uniform')}, 2 * {_normal_tail('r.runs')},"
        f" 2 * {_normal_tail('r.serial')})))"
    )
    chain = f"filter(transform({runs}, r -> {classes}), r -> r.alphabet <> '')"
    for step in (coded, counted, moments, z, chances):
        chain = f"transform({chain}, r -> {step})"
    return F.expr(chain)


def scanned(docs: DataFrame, text: str = "text", keep_text: bool = False) -> DataFrame:
    """Adds the spans of known shapes, ``known``, and the tested runs, ``tested``, to every row."""
    kept = [c for c in docs.columns if c not in ("known", "tested") and (keep_text or c != text)]
    body, runs = free_name(kept, "secret_text"), free_name(kept, "secret_runs")
    base = free_name(kept, "secret_base")
    rows = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias(body))
    shapes = (
        F.filter(
            _spans(body, ASSIGN, 0, group=2), lambda s: F.char_length(s["value"]) >= ASSIGN_LEAST
        ),
        F.filter(_spans(body, ACCESS, 1), lambda s: F.char_length(s["value"]) >= ACCESS_LEAST),
        _spans(body, HEX, 2),
    )
    rows = rows.select(
        *kept, F.concat(*shapes).alias(base), _spans(body, RUN, 3).alias(runs)
    )
    return rows.select(
        *kept,
        F.transform(base, lambda s: F.struct(s["start"], s["kind"], s["end"])).alias("known"),
        _battery(f"`{runs}`").alias("tested"),
    )


def _length_class(n: Column) -> Column:
    """Lengths from one power of the root of 2 to the next."""
    return F.floor(2 * F.log2(n)).cast("int")


def _step(p: Column) -> Column:
    return F.ceil(p * GRID).cast("int")


def levels(rows: DataFrame) -> dict[int, int]:
    """Per length class, the largest step of the p-values at which randomness is rejected.

    Benjamini-Hochberg on p-values rounded up to a grid, so the corpus shrinks to a count per class and
    step before it is ordered: some hundred thousand rows at most, whatever its size.
    """
    runs = rows.select(F.explode("tested").alias("r")).select(
        _length_class(F.col("r.n")).alias("class"), _step(F.col("r.p")).alias("step")
    )
    counts: dict[int, dict[int, int]] = {}
    for kind, step, n in runs.groupBy("class", "step").count().collect():
        counts.setdefault(kind, {})[step] = n
    found = {}
    for kind, steps in counts.items():
        level = min(LEVEL_MOST, LEVEL / 2 ** (kind / 2))
        total, sofar, found[kind] = sum(steps.values()), 0, -1
        for step in sorted(steps):
            sofar += steps[step]
            if step / GRID <= level * sofar / total:
                found[kind] = step
    return found


def with_secrets(rows: DataFrame, rejected: dict[int, int]) -> DataFrame:
    """``secrets``, an array of ``start, kind, end`` by start and kind, instead of what was scanned.

    Random runs are reported unless a known shape covers them.
    """
    limits = F.create_map(*(F.lit(x) for item in rejected.items() for x in item))
    random = F.filter("tested", lambda r: F.lit(False))
    if rejected:
        random = F.filter("tested", lambda r: _step(r["p"]) > limits[_length_class(r["n"])])
    new = F.transform(random, lambda r: F.struct(r["start"], r["kind"], r["end"]))
    kept = [name for name in rows.columns if name not in ("known", "tested", "secrets")]
    both, spans = free_name(kept, "secret_all"), free_name(kept, "secrets")
    # known shapes come before runs that start with them; what starts no later and ends no earlier covers a run
    reach = running(
        f"transform(`{both}`, s -> IF(s.kind < {len(KINDS) - 1}, s.end, 0))", "int", "greatest({a}, {v})"
    )
    uncovered = (
        f"get(transform(array({reach}), ends -> filter(`{both}`, (s, k) ->"
        f" s.kind < {len(KINDS) - 1} OR get(ends, k) < s.end)), 0)"
    )
    sorted_rows = rows.select(*kept, F.array_sort(F.concat("known", new)).alias(both))
    return sorted_rows.select(
        *kept, F.expr(f"IF(exists(`{both}`, s -> s.kind = {len(KINDS) - 1}), {uncovered}, `{both}`)").alias(spans)
    )


def secret_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """The other columns of ``docs`` with ``secrets``; every text is scanned once.

    Null and empty texts have none. Repeated rows get equal results, an empty table has no rows. Texts of
    any length and number of matches take time in proportion. Columns ``known``, ``tested`` and ``secrets`` of
    ``docs`` are replaced; any other name may be in use.
    """
    rows = Scratch(docs.sparkSession).write(scanned(docs, text), "scanned")
    return with_secrets(rows, levels(rows))


def _masked(text: str, spans: str) -> str:
    """SQL for the text with MASK in place of each span, overlapping ones together.

    The text is taken apart into blocks, so that a place far into it is found without counting from its start.
    """
    block = 1024
    # [from, to) of what lies between spans, where it begins after all spans before
    reach = running(f"transform({spans}, s -> s.end)", "int", "greatest({a}, {v})")
    gaps = f"""get(transform(array({reach}), ends -> filter(concat(
        transform({spans}, (s, k) -> named_struct('a', IF(k = 0, 0, get(ends, k - 1)), 'b', s.start)),
        array(named_struct('a', get(ends, size(ends) - 1), 'b', CAST(NULL AS INT)))),
        (g, k) -> k = 0 OR g.b IS NULL OR g.b >= g.a)), 0)"""
    head = f"substr(get(blocks, g.a DIV {block}), g.a % {block} + 1"
    piece = f"""CASE WHEN g.a DIV {block} >= size(blocks) THEN ''
        WHEN g.b IS NULL THEN concat({head}), array_join(slice(blocks, g.a DIV {block} + 2, size(blocks)), ''))
        WHEN g.a DIV {block} = g.b DIV {block} THEN {head}, g.b - g.a)
        ELSE concat({head}), array_join(slice(blocks, g.a DIV {block} + 2,
            g.b DIV {block} - g.a DIV {block} - 1), ''),
            coalesce(substr(get(blocks, g.b DIV {block}), 1, g.b % {block}), '')) END"""
    return f"""get(transform(array(regexp_extract_all({text}, '(?s).{{1,{block}}}', 0)), blocks ->
        array_join(transform({gaps}, g -> {piece}), '{MASK}')), 0)"""


def redacted(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with every secret in the text replaced by MASK, overlapping ones by one.

    Rows, repeated ones too, all stay; null and empty texts are left as they are. If there is a
    column ``n_chars``, it gets the new length. The texts are scanned twice, first to set the levels for
    the whole corpus.
    """
    rejected = levels(scanned(docs.select(text), text))
    names = docs.columns
    row, body = "row", free_name(["row"], "body")
    rows = docs.select(F.struct(*names).alias(row), F.col(text).alias(body))
    found = with_secrets(scanned(rows, body, keep_text=True), rejected)
    changed_text = free_name(names, "secret_new_text")
    columns = [F.col(row)[name].alias(name) for name in names]
    new_text = F.when(F.size("secrets") > 0, F.expr(_masked(body, "secrets")))
    result = found.select(*columns, new_text.alias(changed_text))
    changed = F.col(changed_text).isNotNull()
    out = []
    for name in names:
        if name == text:
            out.append(F.when(changed, F.col(changed_text)).otherwise(F.col(name)).alias(name))
        elif name == n_chars:
            size = F.char_length(changed_text).cast(docs.schema[name].dataType)
            out.append(F.when(changed, size).otherwise(F.col(name)).alias(name))
        else:
            out.append(F.col(name))
    return result.select(*out)
