"""DuckDB SQL for the registered queries that SQL can express."""

from pitpanel.llm.url_filter import LOWER, RULES, SOFT, STRICT, UPPER


def _texts(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def url_sql() -> str:
    low = f"translate(coalesce(url, ''), '{UPPER}', '{LOWER}')"
    hits = "len(list_filter({}, lambda t: regexp_matches(low, '(^|[^a-z0-9])' || t || '([^a-z0-9]|$)')))"
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    return rf"""
    WITH parsed AS (
        SELECT row_number() OVER () AS r, page_id, {low} AS low,
               translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
        FROM pages),
    rules(verdict, h, p) AS (VALUES {rules}),
    fitting AS (
        SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
        FROM parsed, rules
        WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        GROUP BY r),
    counted AS (
        SELECT *, {hits.format(_texts(STRICT))} AS n_strict, {hits.format(_texts(SOFT))} AS n_soft FROM parsed)
    SELECT page_id, host, path, rule,
           coalesce(verdict, CASE WHEN n_strict > 0 OR n_soft >= 2 THEN 'block' ELSE 'allow' END) AS verdict,
           CAST(n_strict AS BIGINT) AS n_strict, CAST(n_soft AS BIGINT) AS n_soft
    FROM counted LEFT JOIN fitting USING (r)"""


LEMPEL_ZIV = r"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    starts AS (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS j FROM docs WHERE len(w) >= 50),
    windows AS (SELECT r, doc_id, j, array_to_string(w[j:j + 49], ' ') AS t FROM starts),
    least AS (SELECT t, min(doc_id) AS first FROM windows GROUP BY t),
    dup AS (SELECT r, j FROM windows JOIN least USING (t) WHERE first < doc_id),
    words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM docs),
    marked AS (
        SELECT r, j, word, max(CASE WHEN dup.r IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY words.r ORDER BY words.j ROWS 49 PRECEDING) AS gone
        FROM words LEFT JOIN dup USING (r, j)),
    kept AS (SELECT r, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (gone = 0) AS rest FROM marked GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
    FROM docs LEFT JOIN kept USING (r)"""

RANKING = rf"""
    WITH low AS (SELECT 'd' AS kind, row_number() OVER () AS r, doc_id AS id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents
                 UNION ALL
                 SELECT 'i', row_number() OVER (), item_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') FROM benchmark),
    found AS (SELECT kind, r, id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM low),
    tf AS (SELECT r, id AS doc_id, term, count(*) AS tf FROM found WHERE kind = 'd' GROUP BY ALL),
    n AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
    total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
    weight AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, docs),
    size AS (SELECT r, 100 - 50 + ((50 * n * docs) // terms) AS m FROM n, total),
    wanted AS (SELECT DISTINCT r AS item, id AS item_id, term FROM found WHERE kind = 'i'),
    scored AS (SELECT item, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
               FROM wanted JOIN tf USING (term) JOIN weight USING (term) JOIN size USING (r) GROUP BY ALL),
    ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
               FROM scored WHERE score > 0)
    SELECT * FROM ranked WHERE rank <= 50"""

ORACLE: dict[str, str] = {
    "op7_url_vocabulary": url_sql(),
    "op9_lempel_ziv": LEMPEL_ZIV,
    "op12_geometric_blocks": RANKING,
}
