"""DuckDB SQL of the dealt queries that SQL can express."""

from __future__ import annotations

from plumbline.llm import mixing, near_vectors, prefix_trie, ranked_search, secret_scan, warc

_DOCS = "SELECT doc_id, coalesce(text, '') AS t FROM documents"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secret_scan() -> str:
    patterns = [secret_scan.ASSIGN, secret_scan.ACCESS, secret_scan.HEX, *[c.pattern for c in secret_scan.CLASSES]]
    lists = " UNION ALL ".join(
        f"SELECT doc_id, {k} AS kind, regexp_extract_all(t, {_quoted(p)}) AS m, string_split_regex(t, {_quoted(p)}) AS g FROM d"
        for k, p in enumerate(patterns)
    )
    windows = " UNION ALL ".join(
        f"""SELECT doc_id, {3 + k} AS kind, s, s + min(i) - 1 AS start, s + max(i) - 1 + {c.window} AS stop
            FROM (SELECT doc_id, s, v, unnest(range(1, length(v) - {c.window} + 2)) AS i FROM found WHERE kind = {3 + k}
                  {"".join(f" AND NOT regexp_matches(v, {_quoted(p)})" for p in secret_scan.ALLOWED)})
            WHERE list_aggregate(string_split(substr(v, i, {c.window}), ''), 'entropy') >= {c.least_bits}
            GROUP BY doc_id, s, v"""
        for k, c in enumerate(secret_scan.CLASSES)
    )
    names = "[" + ", ".join(_quoted(k) for k in secret_scan.KINDS) + "]"
    return f"""
        WITH d AS ({_DOCS}), lists AS ({lists}),
        found AS (SELECT doc_id, kind, m[i] AS v, CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
                  + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS s
                  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM lists)),
        spans AS (SELECT doc_id, kind, s AS start, s + length(v) AS stop FROM found WHERE kind IN (1, 2)
                  OR kind = 0 AND length(regexp_extract(v, {_quoted(secret_scan.ASSIGN)}, 2)) >= {secret_scan.ASSIGN_LEAST}
                  UNION ALL SELECT doc_id, kind, start, stop FROM ({windows})),
        shown AS (SELECT *, ({names})[kind + 1] || ':' || start || ':' || stop AS one FROM spans)
        SELECT d.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
               count(*) FILTER (kind = 2) AS n_hex,
               sha256(coalesce(string_agg(one, ',' ORDER BY start, kind) FILTER (kind < 3), '')) AS base_sha256,
               coalesce(string_agg(one, ',' ORDER BY start, kind), '') AS spans
        FROM d LEFT JOIN shown USING (doc_id) GROUP BY d.doc_id"""


def _mixing() -> str:
    seed = _quoted(mixing.SEED)
    return f"""
        WITH sized AS (SELECT doc_id, source, text, coalesce(source, '') AS s, coalesce(CAST(doc_id AS VARCHAR), '') AS k,
                       greatest(length(coalesce(text, '')), 1) AS size FROM documents),
        sums AS (SELECT s, CAST(sum(size) AS DOUBLE) AS size FROM sized GROUP BY s),
        rates AS (SELECT s, pow(size, {mixing.EXPONENT}) / sum(pow(size, {mixing.EXPONENT})) OVER () * sum(size) OVER () / size AS mean FROM sums),
        steps AS (SELECT s, mean, k, CASE WHEN k = 0 THEN 0 ELSE ln(mean) - ln(k) END AS term
                  FROM (SELECT s, mean, unnest(range(0, CAST(ceil(mean + 12 * sqrt(mean) + 25) AS BIGINT) + 1)) AS k FROM rates)),
        pmf AS (SELECT s, k, exp(sum(term) OVER (PARTITION BY s ORDER BY k) - mean) AS p FROM steps),
        cdf AS (SELECT s, k, sum(p) OVER (PARTITION BY s ORDER BY k) AS c FROM pmf),
        draws AS (SELECT doc_id, source, text, s, k AS key, CAST('0x' || substr(md5({seed} || ':' || k), 1, 13) AS BIGINT) / pow(2, 52) AS u FROM sized),
        counts AS (SELECT doc_id, source, text, key, count(*) FILTER (c <= u) AS n FROM draws JOIN cdf USING (s) GROUP BY doc_id, source, text, key, u)
        SELECT doc_id, source, text, CAST(r AS INTEGER) AS replica, md5({seed} || ':' || key || ':' || r) AS shuffle_key
        FROM (SELECT *, unnest(range(1, n + 1)) AS r FROM counts)"""


#: nodes of ``p`` (x, y), both ways, with the smallest node that each reaches
_REACHED = """reach AS (SELECT x, y FROM p UNION SELECT r.x, p.y FROM reach r JOIN p ON r.y = p.x),
              roots AS (SELECT x AS node, min(y) AS root FROM reach GROUP BY x)"""


def _ngram_join() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(t, '{upper}', '{lower}'), '[^\\x20\\x09-\\x0D]+') AS w FROM ({_DOCS})),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS sh
              FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (sh) WHERE a.doc_id <> b.doc_id GROUP BY x, y),
        p AS (SELECT x, y FROM both_ JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * c >= 75 * (a.n + b.n - c)),
        {_REACHED}
        SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(root, w.doc_id)) AS component_id
        FROM w LEFT JOIN n USING (doc_id) LEFT JOIN roots ON node = w.doc_id"""


def _warc() -> str:
    letters = " || ".join(
        f"substr('{warc.BASE32}', ((CAST('0x' || substr(s, {at}, 5) AS INTEGER) >> {shift}) & 31) + 1, 1)"
        for at in range(1, 41, 5)
        for shift in (15, 10, 5, 0)
    )
    return f"""
        WITH h AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s FROM pages),
        m AS (SELECT *, max(page_id) OVER (PARTITION BY s) AS last FROM h)
        SELECT page_id, strlen(h) AS payload_bytes, {letters} AS payload_digest,
               CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> last THEN last END AS refers_to, page_id + {warc.FIRST_SECOND} AS captured_at FROM m"""


def _near_vectors() -> str:
    return f"""
        WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        good AS (SELECT * FROM e WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                 AND len(list_filter(v, lambda x: x <> 0)) > 0),
        p AS (SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
              WHERE list_cosine_similarity(a.v, b.v) >= {near_vectors.LEAST_COSINE}),
        {_REACHED}, links AS (SELECT x AS node, count(*) AS n FROM p GROUP BY x)
        SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(root, e.vec_id)) AS component_id,
               e.vec_id <= coalesce(root, e.vec_id) AS kept
        FROM e LEFT JOIN links ON links.node = e.vec_id LEFT JOIN roots ON roots.node = e.vec_id"""


def _ranked_search() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    term = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

    def terms(table: str, key: str) -> str:
        return f"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{term}') AS t FROM {table}"

    return f"""
        WITH d AS (SELECT doc_id, t, len(t) AS n FROM ({terms("documents", "doc_id")}) WHERE len(t) > 0),
        whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
        q AS (SELECT DISTINCT item_id, unnest(t) AS term FROM ({terms("benchmark", "item_id")})),
        tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM d)
               WHERE term IN (SELECT term FROM q) GROUP BY doc_id, n, term),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term, docs),
        parts AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * ({100 - ranked_search.LENGTH_SHARE} + ({ranked_search.LENGTH_SHARE} * n * docs) // terms))) AS part
                  FROM tf JOIN w USING (term), whole),
        scores AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM q JOIN parts USING (term) GROUP BY item_id, doc_id),
        ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
                   FROM scores WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {ranked_search.BEST}"""


def _prefix_trie() -> str:
    # crc32 of the digits: each byte is mixed in and then shifted out bit by bit
    steps = "flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = f"""xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {steps}),
              lambda a, o: CASE WHEN o >= 0 THEN xor(a, o) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"""
    path = "array_to_string(t[1:{}], ',')"
    return f"""
        WITH e AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        k AS (SELECT *, sha256(length(role) || ':' || role || text) AS digest FROM e),
        o AS (SELECT conv_id, digest, length(text) AS size,
              row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, substr(text, 1, {prefix_trie.ORDERED_BY}), digest) AS pos FROM k),
        c AS (SELECT c, {crc} % {prefix_trie.HEADS} AS h FROM (SELECT DISTINCT conv_id AS c FROM o)),
        r AS (SELECT c, 0 AS own, pos, digest, size FROM c JOIN o ON conv_id = c - c % {prefix_trie.GROUP} AND pos <= h
              UNION ALL SELECT c, 1, pos, digest, size FROM c JOIN o ON conv_id = c AND pos > h),
        s AS (SELECT c.c, coalesce(list(digest ORDER BY own, pos) FILTER (pos IS NOT NULL), []) AS t,
              coalesce(list(size ORDER BY own, pos) FILTER (pos IS NOT NULL), []) AS z FROM c LEFT JOIN r ON r.c = c.c GROUP BY c.c),
        m AS (SELECT c, t, z, unnest(range(0, len(t) + 1)) AS d FROM s),
        n AS (SELECT {path.format("d")} AS p, d, min(c) AS conv_id, count(*) AS n_convs, any_value(t[1:d]) AS t, coalesce(any_value(z[d]), 0) AS size,
              sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(t) = d), '')) AS ends_sha256 FROM m GROUP BY p, d),
        kids AS (SELECT {path.format("d - 1")} AS p, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
        f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (p, d)),
        below AS (SELECT {path.format("a")} AS p, a AS d, CAST(sum((n_convs - 1) * size) AS BIGINT) AS saved_tokens,
                  count(*) FILTER (n_children = 0) AS n_leaves
                  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM f) GROUP BY 1, 2)
        SELECT f.conv_id, f.d AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
        FROM f JOIN below USING (p, d) LEFT JOIN f up ON f.d > 0 AND up.d = f.d - 1 AND up.p = array_to_string(f.t[1:f.d - 1], ',')"""


ORACLE = {
    "op1_secret_scan": _secret_scan(),
    "op3_ngram_join": _ngram_join(),
    "op4_warc": _warc(),
    "op7_near_vectors": _near_vectors(),
    "op10_mixing": _mixing(),
    "op11_ranked_search": _ranked_search(),
    "op12_prefix_trie": _prefix_trie(),
}
