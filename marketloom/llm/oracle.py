"""SQL counterparts of the operators that SQL can express, for DuckDB."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from marketloom.llm import mixing as mix
from marketloom.llm import secrets as scan

WARC = """
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
    ),
    r AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS response_id FROM p)
    SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
           list_aggregate([
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      1 + (('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT
                           // (32768 >> 5 * (i % 4))::BIGINT % 32)::INT, 1)
               for i in range(32)], 'string_agg', '') AS payload_digest,
           CASE WHEN page_id IS NOT DISTINCT FROM response_id THEN 'response' ELSE 'revisit' END
               AS record_type,
           CASE WHEN page_id IS DISTINCT FROM response_id THEN response_id END AS refers_to
    FROM r
    """

WORD = r"[^\x20\x09-\x0D]+"


def _level(depth: int, weights: Mapping[str, int]) -> str:
    """Budgets of one level of the tree, from those of the level above."""
    name, here = mix.LEVELS[depth], ", ".join(mix.LEVELS[: depth + 1])
    above = ", ".join(mix.LEVELS[:depth])
    parent = f"PARTITION BY {above}" if above else ""
    before = f"l{depth - 1}" if depth else "root"
    join = f"JOIN {before} USING ({above})" if above else f"CROSS JOIN {before}"
    cases = " ".join(f"WHEN {name} = '{k}' THEN {v}" for k, v in weights.items())
    weight = f"CASE {cases} ELSE 1 END" if cases else "1"
    order = f"{parent} ORDER BY capacity::DOUBLE / weight::DOUBLE, {name}"
    return f"""
    n{depth} AS (
        SELECT {here}, sum(tokens * {mix.MAX_EPOCHS})::HUGEINT AS capacity,
               ({weight})::HUGEINT AS weight
        FROM leaves GROUP BY {here}
    ),
    f{depth} AS (
        SELECT n.*, budget, capacity * sum(weight) OVER (
                   {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT
               <= (budget - coalesce(sum(capacity) OVER (
                   {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT)
                  * weight AS is_full
        FROM n{depth} n {join}
    ),
    l{depth} AS (
        SELECT {here}, CASE WHEN is_full THEN capacity ELSE
               (budget - coalesce(sum(capacity) FILTER (is_full) OVER ({parent}), 0)::HUGEINT)
               * weight // sum(weight) FILTER (NOT is_full) OVER ({parent})::HUGEINT END AS budget
        FROM f{depth}
    )"""


def mixing(domains: Sequence[str], weights: Mapping, budget_percent: int) -> str:
    names = "[" + ", ".join(f"'{x}'" for x in domains) + "]"
    levels = ",".join(_level(i, weights.get(x, {})) for i, x in enumerate(mix.LEVELS))
    return f"""
    WITH d AS (
        SELECT doc_id,
               coalesce({names}[TRY_CAST(substr(source, 4) AS INT) % {len(domains)} + 1],
                        '{mix.MISSING}') AS domain,
               coalesce(lang, '{mix.MISSING}') AS lang,
               coalesce(source, '{mix.MISSING}') AS source,
               coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS n_tokens
        FROM documents
    ),
    leaves AS (
        SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens
        FROM d GROUP BY ALL HAVING sum(n_tokens) > 0
    ),
    root AS (SELECT sum(tokens)::HUGEINT * {budget_percent} // 100 AS budget FROM leaves),
    {levels},
    plan AS (
        SELECT domain, lang, source, (budget // tokens)::INT AS epochs, budget % tokens AS prefix
        FROM leaves JOIN l2 USING (domain, lang, source)
    ),
    placed AS (
        SELECT d.*, epochs, prefix, sum(n_tokens) OVER (
                   PARTITION BY domain, lang, source
                   ORDER BY md5('{mix.SEED}:' || (epochs + 1) || ':' || doc_id), doc_id, n_tokens
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tokens_so_far
        FROM d JOIN plan USING (domain, lang, source)
    )
    SELECT doc_id, domain, lang, source, n_tokens,
           (epochs + (tokens_so_far <= prefix)::INT)::INT AS copies
    FROM placed WHERE epochs + (tokens_so_far <= prefix)::INT > 0
    """


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _located(pattern: str) -> str:
    """Texts with a match: the matches, and where each starts and ends."""
    p = _quoted(pattern)
    return f"""
        SELECT doc_id, unnest(found) AS found, unnest(range(len(found))) AS i, found AS all_found,
               string_split_regex(text, {p}) AS between
        FROM (SELECT doc_id, text, regexp_extract_all(text, {p}) AS found FROM d)
        WHERE len(found) > 0"""


def _starts(pattern: str) -> str:
    return f"""
        SELECT doc_id, found, (list_sum([length(x) for x in between[: i + 1]])
               + coalesce(list_sum([length(x) for x in all_found[:i]]), 0))::BIGINT AS pos
        FROM ({_located(pattern)})"""


# The allow-list for an engine without possessive quantifiers and lookahead.
_WORD = "([A-Z]?[a-z]+|[A-Z]+|[0-9]+)"
ALLOWED = tuple(
    f"^[-_/+=]*{_WORD}([-_/+=]+{_WORD})*[-_/+=]*$" if "(?=" in x else x for x in scan.ALLOWED
)


def _entropy(kind: int, chars: scan.CharClass) -> str:
    """Windows of high entropy, joined where they overlap or touch."""
    units = "[" + ", ".join(map(str, scan.bits_of_counts())) + "]"
    allowed = " OR ".join(f"regexp_matches(found, {_quoted(x)})" for x in ALLOWED)
    w = scan.WINDOW
    return f"""
        SELECT doc_id, min(start) AS start, {kind} AS kind, max(start) + {w} AS end_
        FROM (
            SELECT *, sum(new) OVER (PARTITION BY doc_id, pos ORDER BY start) AS run
            FROM (
                SELECT *, (start > coalesce(lag(start) OVER (
                       PARTITION BY doc_id, pos ORDER BY start), -9) + {w})::INT AS new
                FROM (
                    SELECT doc_id, pos, pos + o AS start, substr(found, o + 1, {w}) AS part
                    FROM (SELECT *, unnest(range(length(found) - {w - 1})) AS o
                          FROM ({_starts(chars.pattern)}) WHERE NOT ({allowed}))
                )
                WHERE list_sum([{units}[n::BIGINT + 1] for n in map_values(
                          list_histogram(string_split(part, '')))]) <= {scan.most_units(chars.bits)}
            )
        ) GROUP BY doc_id, pos, run"""


def secrets() -> str:
    kinds = [*scan.BASE_KINDS, *(c.kind for c in scan.CLASSES)]
    names = "[" + ", ".join(map(_quoted, kinds)) + "]"
    listed = f"{names}[kind + 1] || ':' || start || ':' || end_, ',' ORDER BY start, kind"
    base = [
        f"""SELECT doc_id, pos AS start, {kind} AS kind, pos + length(found) AS end_
            FROM ({_starts(pattern)}) WHERE {long_enough}"""
        for kind, pattern, long_enough in (
            (0, scan.ASSIGN, f"length(regexp_extract(found, {_quoted(scan.ASSIGN)}, 1))"
                             f" >= {scan.ASSIGN_LEAST}"),
            (1, scan.ACCESS, f"length(found) >= {scan.ACCESS_LEAST}"),
            (2, scan.HEX, f"length(found) >= {scan.HEX_LEAST}"),
        )
    ]
    added = [_entropy(len(base) + i, c) for i, c in enumerate(scan.CLASSES)]
    every = " UNION ALL ".join([*base, *added])
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    s AS ({every}),
    l AS (
        SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign,
               count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
               string_agg({listed}) FILTER (kind < {len(base)}) AS base,
               string_agg({listed}) AS spans
        FROM s GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
           coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
           coalesce(spans, '') AS spans
    FROM d LEFT JOIN l USING (doc_id)
    """


def nearest(k: int) -> str:
    """The exact answer; the operator's recall is high enough to give it on small tables."""
    return f"""
    WITH v AS (
        SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
          AND len([x for x in embedding if x <> 0]) > 0
    ),
    s AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
        FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
    ),
    r AS (
        SELECT query_id, row_number() OVER (
                   PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
        FROM s
    )
    SELECT * FROM r WHERE rank <= {k}
    """


def lines(least_docs: int, least_chars: int) -> str:
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    key = f"translate(trim(l, {blanks}), '{upper}', '{upper.lower()}')"
    return f"""
        WITH split AS (
            SELECT row_number() OVER () AS r, doc_id,
                   string_split(coalesce(text, ''), chr(10)) AS lines
            FROM documents
        ), line AS (
            SELECT r, doc_id, unnest(lines) AS l, generate_subscripts(lines, 1) AS place FROM split
        ), keyed AS (SELECT *, {key} AS key FROM line),
        common AS (
            SELECT key FROM keyed WHERE length(key) >= {least_chars}
            GROUP BY key HAVING count(DISTINCT r) >= {least_docs}
        ), told AS (
            SELECT keyed.*, common.key IS NOT NULL AS gone FROM keyed LEFT JOIN common USING (key)
        )
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
               count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(l, chr(10) ORDER BY place) FILTER (NOT gone), ''))
                   AS kept_sha256
        FROM told GROUP BY r"""
