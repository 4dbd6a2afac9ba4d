"""DuckDB SQL of the source divergence audit, from the definition: every kept term for every pair."""

SQL = r"""
    WITH docs AS (
        SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
        FROM documents),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    placed AS (SELECT r, lang, source, unnest(words) AS term FROM docs),
    kept AS (SELECT lang, term FROM (SELECT DISTINCT r, lang, term FROM placed) GROUP BY ALL HAVING count(*) >= 3),
    counts AS (SELECT lang, source, term, count(*) AS n FROM placed SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    by_lang AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM counts GROUP BY ALL),
    langs AS (SELECT lang, sum(n)::HUGEINT AS lang_words, count(*) AS v FROM by_lang GROUP BY lang),
    sizes AS (
        SELECT lang, source, coalesce(words, 0) AS words, v
        FROM groups LEFT JOIN (SELECT lang, source, sum(n)::HUGEINT AS words FROM counts GROUP BY ALL) USING (lang, source)
        LEFT JOIN langs USING (lang)),
    shares AS (
        SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
            1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.words + s.v) AS p,
            1 + (1000000000::HUGEINT * (b.n + 1)) // (l.lang_words + l.v) AS q
        FROM sizes s JOIN kept k USING (lang) JOIN langs l USING (lang) JOIN by_lang b ON b.lang = s.lang AND b.term = k.term
        LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
    pairs AS (
        SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    every_pair AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
    terms AS (
        SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM shares WHERE n > 0 AND p > q),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
        FROM (FROM every_pair UNION ALL FROM terms))
    SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
