"""DuckDB statements that the queries which SQL can express must equal on the given tables."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"[^\x20\x09-\x0D]+"
MARKS = r"^[ \t]*(?:>[ \t]*)+"

#: Nodes and the smallest node that each reaches over ``links (a, b)``, which hold both directions.
REACH = """reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
roots AS (SELECT a, min(b) AS b FROM reach GROUP BY a)"""


def near_duplicates_sql(width: int, percent: int) -> str:
    """All pairs that share a shingle, with exact overlaps."""
    run = " || ' ' || ".join(f"w[i + {k}]" for k in range(width))
    return f"""WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS}') AS w FROM documents),
    sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - {width - 2}), lambda i: {run})) END AS s FROM words),
    elements AS (SELECT doc_id, len(s) AS n, unnest(s) AS e FROM sets),
    links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM elements x JOIN elements y ON x.e = y.e AND x.doc_id <> y.doc_id
        GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= {percent} * (x.n + y.n - count(*))),
    {REACH}
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
        doc_id <= coalesce(b, doc_id) AS kept FROM sets LEFT JOIN roots ON a = doc_id"""


def near_vectors_sql(cosine: float) -> str:
    return f"""WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
    good AS (SELECT * FROM v WHERE x IS NOT NULL AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        AND len(list_filter(x, lambda c: c <> 0)) > 0),
    links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM good p JOIN good q ON p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
        WHERE list_cosine_similarity(p.x, q.x) >= {cosine}),
    {REACH}
    SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links,
        least(vec_id, coalesce(b, vec_id)) AS component_id, vec_id <= coalesce(b, vec_id) AS kept
    FROM embeddings LEFT JOIN roots ON a = vec_id"""


def mixing_sql(weights: tuple[int, ...], share: float, most: float, seed: int) -> str:
    cycle = f"[{', '.join(map(str, weights))}]"
    return f"""WITH measured AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS BIGINT) AS size
        FROM documents),
    sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM measured GROUP BY source),
    weighed AS (SELECT *, {cycle}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1] AS weight,
        CAST(source_size AS DOUBLE) * {most} AS lim FROM sizes),
    levels AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * {share} - coalesce(sum(lim) OVER filled, 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER filled, 0)) AS own, row_number() OVER (ORDER BY lim / weight, source NULLS LAST) AS nth
        FROM weighed WINDOW filled AS (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    open AS (SELECT arg_min(own, nth) AS level FROM levels WHERE own * weight < lim),
    targets AS (SELECT source, source_size, CASE WHEN level IS NULL THEN lim ELSE least(lim, level * weight) END AS target FROM levels, open),
    rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
        CAST('0x' || substr(md5('{seed}:offset:' || coalesce(source, '')), 1, 7) AS BIGINT) AS start FROM targets),
    placed AS (SELECT m.*, r.source_size, r.target, CAST(floor(rate) AS BIGINT) AS whole, CAST(floor((rate - floor(rate)) * {1 << 28}) AS BIGINT) AS part,
        start, row_number() OVER (PARTITION BY m.source ORDER BY size DESC, md5('{seed}:' || m.doc_id), m.doc_id) - 1 AS place
        FROM measured m JOIN rates r ON m.source IS NOT DISTINCT FROM r.source)
    SELECT doc_id, size, source_size, target,
        size * (whole + ((part * (place + 1) + start) >> 28) - ((part * place + start) >> 28)) AS taken FROM placed"""


def topk_sql(every: int, k: int, scale: int) -> str:
    return f"""WITH v AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda c: floor({scale} * c)) AS x FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
    pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % {every} = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)),
    ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs)
    SELECT * FROM ranked WHERE rank <= {k}"""


def quote_threads_sql() -> str:
    normal = rf"trim(regexp_replace(translate({{}}, '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+', ' ', 'g'))"
    return rf"""WITH RECURSIVE messages AS (SELECT conv_id, turn, role, text, row_number() OVER () AS id FROM conversations),
    split AS (SELECT id, conv_id, turn, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nth FROM messages),
    lines AS (SELECT id, conv_id, turn, nth, length(regexp_replace(regexp_extract(line, '{MARKS}'), '[^>]', '', 'g')) AS level,
        regexp_replace(line, '{MARKS}', '') AS body FROM split),
    cut AS (SELECT *, CASE WHEN level = lag(level) OVER w AND trim(body) <> '' AND trim(lag(body) OVER w) <> '' THEN 0 ELSE 1 END AS new
        FROM lines WINDOW w AS (PARTITION BY id ORDER BY nth)),
    numbered AS (SELECT *, sum(new) OVER (PARTITION BY id ORDER BY nth) AS run FROM cut),
    runs AS (SELECT id, conv_id, turn, level, string_agg(body, chr(10) ORDER BY nth) AS body FROM numbered GROUP BY id, conv_id, turn, level, run),
    owned AS (SELECT *, CASE WHEN level = lag(level) OVER w AND trim(body) <> '' AND trim(lag(body) OVER w) <> '' THEN 0 ELSE 1 END AS fresh
        FROM lines WHERE level = 0 WINDOW w AS (PARTITION BY id ORDER BY nth)),
    own_numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY id ORDER BY nth) AS run FROM owned),
    own_runs AS (SELECT id, conv_id, turn, string_agg(body, chr(10) ORDER BY nth) AS body FROM own_numbered GROUP BY id, conv_id, turn, run),
    bodies AS (SELECT id, regexp_replace(regexp_replace(coalesce(string_agg(body, chr(10) ORDER BY nth), ''), '^(?:[ \t]*\n)+', ''),
        '(?:\n[ \t]*)+$', '') AS body FROM lines WHERE level = 0 GROUP BY id),
    units AS (SELECT conv_id, turn, body FROM lines WHERE level = 0 UNION ALL SELECT conv_id, turn, body FROM own_runs
        UNION ALL SELECT conv_id, turn, body FROM messages JOIN bodies USING (id)),
    held AS (SELECT conv_id, {normal.format('body')} AS key, min(turn) AS held FROM units GROUP BY 1, 2),
    quotes AS (SELECT DISTINCT conv_id, turn, level, {normal.format('body')} AS key
        FROM (SELECT conv_id, turn, level, body FROM lines UNION ALL SELECT conv_id, turn, level, body FROM runs) WHERE level > 0),
    hits AS (SELECT q.conv_id, q.turn, level, held, sum(len(string_split(key, ' '))) AS words FROM quotes q JOIN held USING (conv_id, key)
        WHERE held < q.turn AND key <> '' GROUP BY ALL),
    parents AS (SELECT conv_id, turn, arg_min(held, (level, -words, -held)) AS parent FROM hits GROUP BY ALL),
    chains(conv_id, turn, root, depth) AS (SELECT conv_id, turn, parent, 1 FROM parents
        UNION ALL SELECT c.conv_id, c.turn, p.parent, c.depth + 1 FROM chains c JOIN parents p ON p.conv_id = c.conv_id AND p.turn = c.root),
    ends AS (SELECT conv_id, turn, min(root) AS root, max(depth) AS depth FROM chains GROUP BY ALL),
    out AS (SELECT m.conv_id, m.turn, m.role, CASE WHEN m.text IS NOT NULL THEN coalesce(b.body, '') END AS body,
        (SELECT count(*) FROM runs r WHERE r.id = m.id AND r.level > 0 AND trim(r.body) <> '') AS n_quotes,
        (SELECT max(level) FROM lines l WHERE l.id = m.id) AS quote_depth, coalesce(parent, -1) AS parent_turn,
        coalesce(e.root, m.turn) AS thread_turn, CAST(coalesce(e.depth, 0) AS BIGINT) AS depth
        FROM messages m LEFT JOIN bodies b USING (id) LEFT JOIN parents p ON p.conv_id = m.conv_id AND p.turn = m.turn
        LEFT JOIN ends e ON e.conv_id = m.conv_id AND e.turn = m.turn)
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY thread_turn, turn, role) - 1 AS place FROM out"""


def vector_codes_sql(parts: int, entries: int, rounds: int, scale: int) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS (SELECT id, p, min(list_sum(list_transform(list_zip(s, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * {entries} + e) AS best
        FROM parts JOIN book{r} USING (p) GROUP BY id, p)""")
        if r < rounds:
            steps.append(f"""mean{r} AS (SELECT p, e, list(m ORDER BY i) AS c FROM (SELECT p, best % {entries} AS e, i, CAST(floor(CAST(sum(s[i]) AS DOUBLE) / count(*)) AS BIGINT) AS m
        FROM near{r} JOIN parts USING (id, p), unnest(range(1, len(s) + 1)) AS u(i) GROUP BY ALL) GROUP BY p, e),
    book{r + 1} AS (SELECT p, e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN mean{r} m USING (p, e))""")
    chain = ",\n    ".join(steps)
    return f"""WITH v AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS id, vec_id, label,
        list_transform(CAST(embedding AS DOUBLE[]), lambda c: CAST(floor({scale} * c) AS BIGINT)) AS x
        FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
    parts AS (SELECT id, p, x[p * (len(x) // {parts}) + 1 : (p + 1) * (len(x) // {parts})] AS s FROM v, unnest(range({parts})) AS u(p)),
    book0 AS (SELECT p, id - 1 AS e, s AS c FROM parts WHERE id <= {entries}),
    {chain},
    digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}),
    coded AS (SELECT id, string_agg(printf('%02x', best % {entries}), '' ORDER BY p) AS code, CAST(sum(best // {entries}) AS BIGINT) AS error FROM near{rounds} GROUP BY id)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN coded USING (id), digest"""
