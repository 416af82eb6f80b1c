"""The queries in SQL, where SQL can express them. Words, counts and places as in the operators."""

from __future__ import annotations

from linkrank.llm.licenses import BASE, TEMPLATES
from linkrank.llm.merkle import FAN
from linkrank.llm.mixing import DIGITS, POWER, SEED
from linkrank.llm.quality_rules import LATEST, POLICIES, RULES, mask_of
from linkrank.llm.substrings import WINDOW

WARC = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages
), g AS (
    SELECT digest, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY digest
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
    CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM top AND top IS NOT NULL
        THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM p LEFT JOIN g ON p.digest = g.digest AND n >= 1000
"""


def _licenses() -> str:
    templates = ", ".join(
        f"{{'label': '{one.label}', 'base': {t < len(BASE)}, 'key': {one.key_words},"
        f" 'lead': {one.key_start}, 'more': CAST({list(one.more)} AS VARCHAR[]),"
        f" 'different': {one.different}, 'slack': {one.slack}, 'n': {len(one.words)},"
        f" 'least': {one.coverage}}}"
        for t, one in enumerate(TEMPLATES)
    )
    return f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, [x FOR x IN regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF x <> ''] AS list
    FROM documents
), words AS (
    SELECT r, unnest(list) AS word, unnest(range(len(list))) AS pos FROM d
), templates AS (
    SELECT unnest([{templates}], max_depth := 2)
), around AS (
    SELECT r, pos - t.lead AS start, t.*,
        list_slice(list, greatest(pos - t.lead - slack, 0) + 1, pos - t.lead + n + slack) AS part
    FROM words JOIN templates t ON word = key[1] JOIN d USING (r)
    WHERE list_slice(list, pos + 1, pos + len(key)) = key
), found AS (
    SELECT r, start, label, base, least,
        CAST(len(list_distinct(list_intersect(different, part))) AS DOUBLE) / len(different)
            AS coverage
    FROM around WHERE len([phrase FOR phrase IN more IF NOT contains(
        ' ' || array_to_string(part, ' ') || ' ', ' ' || phrase || ' ')]) = 0
), sums AS (
    SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
        max(start) FILTER (base) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score
    FROM found WHERE coverage >= least GROUP BY r
)
SELECT doc_id, CAST(len(list) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word,
    last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    coalesce(score, 0) AS score
FROM d LEFT JOIN sums USING (r)
"""


MIXING = f"""
WITH sizes AS (
    SELECT source, count(*) AS n, pow(count(*), {POWER}) AS weight FROM documents GROUP BY source
), rates AS (
    SELECT source, weight * (SELECT sum(n) FROM sizes) / (SELECT sum(weight) FROM sizes) / n AS rate
    FROM sizes
), terms AS (
    SELECT source, rate, unnest(range(CAST(floor(rate + 12 * sqrt(rate) + 40) AS BIGINT) + 1)) AS k
    FROM rates
), chances AS (
    SELECT source, list(chance ORDER BY k) AS chances FROM (
        SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1)))
            OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS chance
        FROM terms) GROUP BY source
), draws AS (
    SELECT d.*, CAST(('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1,
        {DIGITS})) AS BIGINT) / pow(16, {DIGITS}) AS draw FROM documents d
), times AS (
    SELECT d.*, len([c FOR c IN chances IF c <= draw]) AS times
    FROM draws d JOIN chances c ON d.source IS NOT DISTINCT FROM c.source
)
SELECT doc_id, text, lang, source, n_chars, CAST(unnest(range(times)) AS INTEGER) AS copy FROM times
"""

_BITS = " + ".join(
    f"CASE WHEN {rule} THEN {1 << place} ELSE 0 END" for place, rule in enumerate(RULES.values())
)
QUALITY_RULES = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), lists AS (
    SELECT *, [x FOR x IN regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+') IF x <> ''] AS list
    FROM d
), words AS (
    SELECT r, unnest(list) AS word, unnest(range(len(list))) AS pos FROM lists
), windows AS (
    SELECT r, pos, list(word) OVER (PARTITION BY r ORDER BY pos
        ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS words FROM words
), repeated AS (
    SELECT r, unnest(list(pos)) AS pos FROM windows WHERE len(words) = 8
    GROUP BY r, words HAVING count(*) > 1
), marked AS (
    SELECT r, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT r, pos + unnest(range(8)) AS p FROM repeated) GROUP BY r
), word_sums AS (
    SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars,
        count(*) FILTER (regexp_matches(word, '\\p{{L}}')) AS n_alpha_words,
        count(*) FILTER (word = before) AS n_stutters
    FROM (SELECT *, lag(word) OVER (PARTITION BY r ORDER BY pos) AS before FROM words) GROUP BY r
), lines AS (
    SELECT r, line, count(*) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r, line
), line_sums AS (
    SELECT r, sum(n) AS n_lines, sum(n - 1) AS n_dup_lines FROM lines GROUP BY r
), counts AS (
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(n_lines, 0) AS n_lines, coalesce(n_alpha_words, 0) AS n_alpha_words,
        coalesce(n_stutters, 0) AS n_stutters, len(regexp_extract_all(text, '\\p{{L}}')) AS n_letters,
        len(regexp_extract_all(text, '\\p{{Lu}}')) AS n_upper
    FROM d LEFT JOIN word_sums USING (r) LEFT JOIN line_sums USING (r) LEFT JOIN marked USING (r)
), bits AS (SELECT *, CAST({_BITS} AS BIGINT) AS failed FROM counts)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
    CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
    CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    failed & {mask_of(POLICIES[LATEST])} = 0 AS kept, failed
FROM bits
"""



def _crc32(text: str) -> str:
    """The CRC-32 of a text of ASCII characters, bit by bit."""
    return f"""xor(4294967295, list_reduce(
        [CAST(4294967295 AS BIGINT)] || [CAST(ascii(c) AS BIGINT) FOR c IN string_split({text}, '')],
        lambda a, b: list_reduce([xor(a, b)] || [CAST(0 AS BIGINT) FOR i IN range(8)],
            lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""


PREFIX_TRIE = f"""
WITH t AS (
    SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
        ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), f AS (
    SELECT c, c - c % 100 AS head, turns, {_crc32("CAST(c AS VARCHAR)")} % 6 AS h FROM t
), b AS (
    SELECT f.c, CASE WHEN t.c IS NULL THEN f.turns[f.h + 1:]
        ELSE list_concat(t.turns[1:f.h], f.turns[f.h + 1:]) END AS turns
    FROM f LEFT JOIN t ON t.c = f.head
), p AS (
    SELECT c, turns, unnest(range(len(turns) + 1)) AS d FROM b
), n AS MATERIALIZED (
    SELECT turns[1:d] AS path, d, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(
        string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(turns) = d), '')) AS ends_sha256
    FROM p GROUP BY ALL
), kids AS (
    SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL
), own AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children,
        CASE WHEN d > 0 THEN (n_convs - 1) * length(path[d].text) ELSE 0 END AS saved
    FROM n LEFT JOIN kids USING (path, d)
), above AS (
    SELECT path[1:a] AS path, a AS d, sum(saved) AS saved_tokens,
        count(*) FILTER (n_children = 0) AS n_leaves
    FROM (SELECT *, unnest(range(d + 1)) AS a FROM own) GROUP BY ALL
)
SELECT own.conv_id, CAST(own.d AS BIGINT) AS depth, q.conv_id AS parent_conv_id, own.n_convs,
    own.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, own.ends_sha256
FROM own JOIN above USING (path, d)
LEFT JOIN own q ON q.d = own.d - 1 AND q.path = own.path[1:own.d - 1] AND own.d > 0
"""

SUBSTRINGS = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, [x FOR x IN regexp_split_to_array(
        coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS list FROM documents
), w AS (
    SELECT r, doc_id, i, array_to_string(list[i:i + {WINDOW - 1}], ' ') AS words
    FROM (SELECT *, unnest(range(1, len(list) - {WINDOW - 2})) AS i FROM d)
), m AS (
    SELECT words, min(doc_id) AS first FROM w GROUP BY words
), gone AS (
    SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS k
    FROM w JOIN m USING (words) WHERE first < doc_id
), each AS (
    SELECT r, unnest(list) AS word, unnest(range(1, len(list) + 1)) AS k FROM d
), kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY k) AS text, count(*) AS n
    FROM each ANTI JOIN gone USING (r, k) GROUP BY r
)
SELECT doc_id, CAST(len(list) AS BIGINT) AS n_words,
    CAST(len(list) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


def _leaf(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    parts = [f"coalesce(CAST(strlen({v}) AS VARCHAR) || ':' || {v}, '-')" for v in values]
    return f"sha256({' || '.join(parts)})"


def _tree(name: str, leaves: str) -> str:
    """The nodes of the trees over ``leaves`` (``g, place, size, digest``), and their siblings."""
    run = f"PARTITION BY g, level, place // {FAN} ORDER BY place ROWS BETWEEN"
    return f"""{name}(g, level, place, size, digest) AS (
    SELECT g, 0, place, size, digest FROM {leaves}
    UNION ALL
    SELECT g, level + 1, place // {FAN}, (size + {FAN - 1}) // {FAN},
        sha256(string_agg(digest, '' ORDER BY place))
    FROM {name} WHERE size > 1 GROUP BY g, level, place // {FAN}, size
), {name}_siblings AS MATERIALIZED (
    SELECT g, level, place,
        coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
        coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
    FROM {name} WHERE size > 1
)"""


def _walk(name: str, tree: str, start: str) -> str:
    """From the nodes ``r, g, place, proof, folded`` of ``start`` up to the root of their tree."""
    return f"""{name}(r, g, level, place, proof, folded) AS (
    SELECT r, g, 0, place, proof, folded FROM {start}
    UNION ALL
    SELECT r, w.g, w.level + 1, w.place // {FAN}, proof || b || a, sha256(b || folded || a)
    FROM {name} w JOIN {tree}_siblings s ON s.g = w.g AND s.level = w.level AND s.place = w.place
), {name}_top AS (SELECT r, g, proof, folded FROM {name} QUALIFY level = max(level) OVER (PARTITION BY r))"""


_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
MANIFEST = f"""
WITH RECURSIVE d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, coalesce('1' || source, '0') AS g,
        {_leaf("text")} AS leaf, CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0
            THEN {_leaf(_LOW)} ELSE {_leaf("text")} END AS found
    FROM documents
), leaves AS MATERIALIZED (
    SELECT *, leaf AS digest, count(*) OVER (PARTITION BY g) AS size, row_number() OVER (
        PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM d
), {_tree("inner_tree", "leaves")}, sources AS MATERIALIZED (
    SELECT '' AS g, g AS source, digest, count(*) OVER () AS size,
        row_number() OVER (ORDER BY g) - 1 AS place
    FROM inner_tree WHERE size = 1
), {_tree("outer_tree", "sources")},
inner_start AS (SELECT r, g, place, '' AS proof, found AS folded FROM leaves),
{_walk("inner_walk", "inner_tree", "inner_start")},
outer_start AS (
    SELECT r, s.g, s.place, proof, folded FROM inner_walk_top w JOIN sources s ON s.source = w.g
), {_walk("outer_walk", "outer_tree", "outer_start")}
SELECT doc_id, leaf, s.digest AS subroot, root, sha256(proof) AS proof_sha256,
    folded AS folded_root, folded = root AS verified
FROM leaves JOIN sources s ON s.source = leaves.g JOIN outer_walk_top w USING (r)
CROSS JOIN (SELECT digest AS root FROM outer_tree WHERE size = 1)
"""

LLM_ORACLES = {
    "op2_warc": WARC,
    "op3_licenses": _licenses(),
    "op5_mixing": MIXING,
    "op7_quality_rules": QUALITY_RULES,
    "op11_prefix_trie": PREFIX_TRIE,
    "op12_substrings": SUBSTRINGS,
    "op13_manifest": MANIFEST,
}
