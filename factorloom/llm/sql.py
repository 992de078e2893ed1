"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from factorloom.llm import secrets

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _secrets() -> str:
    keys = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token")) + (
        "|" + _any_case("api") + "_?" + _any_case("key"))
    assign = (rf"""({keys})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""").replace("'", "''")
    base = [("assign", assign, 2, f"length(value) >= {secrets.ASSIGN_LENGTH}"),
            ("access", "AKIA[A-Z0-9]+", 0, "length(value) >= 18"),
            ("hex", "[0-9a-f]+", 0, "length(value) >= 16")]
    def fine(rules, value: str) -> str:
        return " OR ".join(
            f"(regexp_matches({value}, '{r.fits}')" + (
                f" AND NOT regexp_matches({value}, '{r.flaw}'))" if r.flaw else ")")
            for r in rules)

    w = secrets.WINDOW
    inside = "[^" + secrets.SEPARATORS + "]"
    more = []
    for own in secrets.CLASSES:
        symbols = "".join("\\" + c if c in "-+/=_" else c for c in own.symbols)
        more.append((own.name, f"[{symbols}]{{{w},}}", 0, f"NOT ({fine(secrets.ALLOWED_RUNS, 'value')})",
                     secrets.most_sum(own.least)))
    parts, spans = [], []
    for rank, (kind, pattern, group, holds, *most) in enumerate(base + more):
        parts.append(f"""m_{kind} AS (
    SELECT row, regexp_extract_all(text, '{pattern}', 0) AS ms,
           regexp_extract_all(text, '{pattern}', {group}) AS vs,
           string_split_regex(text, '{pattern}') AS ps
    FROM t WHERE regexp_matches(text, '{pattern}')
), s_{kind} AS (
    SELECT row, {rank} AS rank, '{kind}' AS kind, length(ms[i]) AS size, vs[i] AS value,
           CAST(list_sum(list_transform(ps[:i], lambda p: length(p)))
                + coalesce(list_sum(list_transform(ms[:i - 1], lambda p: length(p))), 0)
                AS BIGINT) AS start
    FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM m_{kind})
)""")
        if not most:
            parts.append(f"""k_{kind} AS (
    SELECT row, rank, kind, start, start + size AS stop FROM s_{kind} WHERE {holds})""")
        else:
            count = "(length(part) - length(replace(part, c, '')))"
            parts.append(f"""w_{kind} AS (
    SELECT * REPLACE (substr(value, lead + 1) AS value),
           list_transform(range(lead + 1, length(value) - {w - 2}), lambda i:
        list_sum(list_transform(list_transform([substr(value, i, {w})], lambda part:
            list_transform(list_distinct(string_split(part, '')), lambda c:
                CAST(round({count} * log2({count}) * 65536) AS BIGINT)))[1], lambda x: x))) AS sums
    FROM (SELECT *, length(regexp_extract(value, '^([A-Za-z]+[/=_-]+)*')) AS lead FROM s_{kind})
    WHERE {holds} AND length(value) - lead >= {w}
), f_{kind} AS (
    SELECT row, rank, kind, start + lead AS start, value, list_position(sums, list_min(sums)) AS place
    FROM w_{kind} WHERE list_min(sums) <= {most[0]}
), k_{kind} AS (
    SELECT row, rank, kind, start + first AS start, start + last AS stop FROM (
        SELECT *, place - 1 - length(regexp_extract(substr(value, 1, place - 1), '{inside}*$')) AS first,
               place + {w - 1} + length(regexp_extract(substr(value, place + {w}), '^{inside}*')) AS last
        FROM f_{kind})
    WHERE NOT ({fine(secrets.ALLOWED, 'substr(value, first + 1, last - first)')}))""")
        spans.append(f"SELECT * FROM k_{kind}")
    listed = ("coalesce(string_agg(kind || ':' || start || ':' || stop, ',' "
              "ORDER BY start, rank){}, '')")
    return f"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
{", ".join(parts)},
spans AS ({" UNION ALL ".join(spans)})
SELECT doc_id, count(*) FILTER (WHERE rank = 0) AS n_assign,
       count(*) FILTER (WHERE rank = 1) AS n_access, count(*) FILTER (WHERE rank = 2) AS n_hex,
       sha256({listed.format(" FILTER (WHERE rank < 3)")}) AS base_sha256,
       {listed.format("")} AS spans
FROM t LEFT JOIN spans USING (row) GROUP BY row, doc_id
"""


SECRETS = _secrets()

_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

CONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
sized AS (SELECT item_id, ws, least(13, len(ws)) AS n FROM b WHERE len(ws) > 0),
grams AS (
    SELECT DISTINCT item_id, n, array_to_string(ws[s:s + n - 1], ' ') AS gram
    FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS s FROM sized)
),
places AS (
    SELECT row, n, s, array_to_string(ws[s:s + n - 1], ' ') AS gram
    FROM (SELECT row, ws, n, unnest(range(1, len(ws) - n + 2)) AS s
          FROM d, (SELECT DISTINCT n FROM grams) WHERE len(ws) >= n)
),
found AS (SELECT row, s, n, item_id FROM places JOIN grams USING (n, gram)),
hit AS (SELECT row, count(DISTINCT w) AS n_hit
        FROM (SELECT row, unnest(range(s, s + n)) AS w FROM found) GROUP BY row),
items AS (SELECT row, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids
          FROM found WHERE item_id IS NOT NULL GROUP BY row)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (row) LEFT JOIN items USING (row)
"""

_TOKENS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SUBSTRINGS = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TOKENS} AS ws FROM documents),
places AS (
    SELECT row, doc_id, s, md5(array_to_string(ws[s:s + 49], ' ')) AS gram
    FROM (SELECT *, unnest(range(1, len(ws) - 48)) AS s FROM d WHERE len(ws) >= 50)
),
firsts AS (SELECT gram, min(doc_id) AS least FROM places GROUP BY gram HAVING count(*) > 1),
gone AS (
    SELECT DISTINCT row, unnest(range(s, s + 50)) AS w FROM places JOIN firsts USING (gram)
    WHERE least < doc_id OR doc_id IS NULL AND least IS NOT NULL
),
kept AS (
    SELECT row, list(ws[w] ORDER BY w) AS left_words
    FROM (SELECT row, ws, unnest(range(1, len(ws) + 1)) AS w FROM d) ANTI JOIN gone USING (row, w)
    GROUP BY row
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
       CAST(len(ws) - coalesce(len(left_words), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(left_words, ' '), '')) AS kept_sha256
FROM d LEFT JOIN kept USING (row)
"""

_LOWERED = (f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
            r"'[^\x20\x09-\x0D]+')")

NEAR_DUPS = f"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS row, doc_id, {_LOWERED} AS ws FROM documents
),
sets AS (
    SELECT DISTINCT row, md5(array_to_string(ws[s:s + n - 1], ' ')) AS shingle
    FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS s
          FROM (SELECT *, least(5, len(ws)) AS n FROM d WHERE len(ws) > 0))
),
sizes AS (SELECT row, count(*) AS n FROM sets GROUP BY row),
links AS (
    SELECT a, b FROM (SELECT x.row AS a, y.row AS b, count(*) AS common
                      FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.row <> y.row
                      GROUP BY x.row, y.row)
    JOIN sizes p ON p.row = a JOIN sizes q ON q.row = b
    WHERE 100 * common >= 75 * (p.n + q.n - common)
),
reach(row, other) AS (
    SELECT row, row FROM sizes
    UNION
    SELECT reach.row, links.b FROM reach JOIN links ON links.a = reach.other
),
least AS (SELECT r.row, min(d.doc_id) AS component_id
          FROM reach r JOIN d ON d.row = r.other GROUP BY r.row)
SELECT doc_id, coalesce(n, 0) AS n_shingles,
       CASE WHEN n > 0 THEN component_id ELSE doc_id END AS component_id,
       doc_id IS NOT DISTINCT FROM CASE WHEN n > 0 THEN component_id ELSE doc_id END AS kept
FROM d LEFT JOIN sizes USING (row) LEFT JOIN least USING (row)
"""

TOP_K = """
WITH v AS (
    SELECT row_number() OVER () AS row, vec_id,
           list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT))
               AS vector
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(
        embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.row AS query_row, q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(
               list_zip(q.vector, c.vector), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.row <> c.row AND len(q.vector) = len(c.vector)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (
          PARTITION BY query_row ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored)
WHERE rank <= 10
"""

CHATS = """
WITH turns AS (
    SELECT DISTINCT conv_id, turn, role, text FROM conversations
), conv AS (
    SELECT conv_id, list({'r': role, 't': text}
                         ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS xs
    FROM turns GROUP BY conv_id
), same AS (
    SELECT xs, min(conv_id) AS conv_id, count(*) AS copies FROM conv GROUP BY xs
), kept AS (
    SELECT * FROM same s
    WHERE NOT EXISTS (SELECT 1 FROM same b WHERE b.xs[1] IS NOT DISTINCT FROM s.xs[1]
                      AND len(b.xs) > len(s.xs) AND b.xs[:len(s.xs)] = s.xs)
), lines AS (
    SELECT conv_id, copies, unnest(xs) AS x, generate_subscripts(xs, 1) - 1 AS pos FROM kept
)
SELECT conv_id, CAST(pos // 1000 AS BIGINT) AS part, count(*) AS n_turns,
       any_value(copies) AS copies,
       string_agg('<|im_start|>' || replace(coalesce(x.r, ''), '<|', '< |') || chr(10)
                  || replace(coalesce(x.t, ''), '<|', '< |') || '<|im_end|>' || chr(10), ''
                  ORDER BY pos) AS rendered
FROM lines GROUP BY conv_id, pos // 1000
"""

_QUANTISED = """
    SELECT row_number() OVER () AS row, vec_id, {more}list_transform(
        embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
    FROM embeddings
    WHERE {where} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

HARD_NEGATIVES = f"""
WITH v AS MATERIALIZED ({_QUANTISED.format(scale=256, where="label IS NOT NULL AND len(embedding) > 0",
    more="CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, ")}
), scored AS MATERIALIZED (
    SELECT a.row AS anchor, a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same,
           CAST(list_sum(list_transform(
               list_zip(a.vector, c.vector), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.row <> c.row AND len(a.vector) = len(c.vector)
), positives AS (
    SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) AS slot FROM scored WHERE same)
    WHERE slot <= 5
), windows AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
           p.score AS positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor, p.slot
                              ORDER BY n.score DESC, n.vec_id NULLS LAST) AS rank
    FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
     AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
       negative_score
FROM windows WHERE rank <= 5
"""


def _clusters(rounds: int = 5, k: int = 40) -> str:
    steps = [f"""
WITH v AS MATERIALIZED ({_QUANTISED.format(scale=256, where="len(embedding) = 64", more="")}
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, vector) - 1 AS num, vector
    FROM v QUALIFY num < {k}
)"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
    SELECT v.row, v.vec_id, v.vector, num, CAST(list_sum(list_transform(
        list_zip(v.vector, c{i}.vector), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)
        AS distance
    FROM v, c{i} QUALIFY row_number() OVER (PARTITION BY v.row ORDER BY distance, num) = 1
)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
    SELECT num, coalesce(mean, vector) AS vector FROM c{i} LEFT JOIN (
        SELECT num, list(part ORDER BY i) AS mean FROM (
            SELECT num, i, CAST((sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*)
                                 AS BIGINT) AS part
            FROM (SELECT num, unnest(vector) AS x, generate_subscripts(vector, 1) AS i FROM a{i})
            GROUP BY num, i) GROUP BY num) USING (num)
)""")
    return ", ".join(steps) + f"""
SELECT vec_id, CAST(num AS INTEGER) AS cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY num) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c{rounds}.vector, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (num)
"""


CLUSTERS = _clusters()
