"""Registered queries of the operators, with the SQL that DuckDB can run for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm import (
    byte_bpe, collocations, exact_dedup, html_text, language_id, manifest, mixing, near_dedup, nearest, packing, token_counts, toxicity, url_filter,
)
from cohortry.llm.common import table


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = language_id.remainder(4)
    return language_id.identify(docs, language_id.train(docs, remainder != 2), remainder == 2)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def toxicity_scorer(spark: SparkSession, sf_dir: str) -> toxicity.Scorer | None:
    """The scorer of query 5, learned from the tables as the contract allows."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.train(docs, labels, language_id.remainder(3) != 1)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_texts(docs, toxicity_scorer(spark, sf_dir), language_id.remainder(3) == 1)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.documents_rollup(table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = byte_bpe.decode_ids(byte_bpe.encode_texts(table(spark, sf_dir, "documents")))
    return done.select(
        "doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.tampered_manifest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_html_text, op2_url_filter, op3_language_id, op4_near_dedup, op5_toxicity,
    op6_mixing, op7_exact_dedup, op8_nearest, op9_packing, op10_token_counts,
    op11_byte_bpe, op12_collocations, op13_manifest,
)}

def _manifest_sql(levels: int = 24) -> str:
    """One table per level: enough for 2 ** levels leaves of a language, and as many languages."""

    def tree(name: str, key: str) -> list[str]:
        return [
            f"""{name}{i + 1} AS MATERIALIZED (SELECT {key}, pos // 2 AS pos, (any_value(n) + 1) // 2 AS n,
    CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
    FROM {name}{i} GROUP BY {key}, pos // 2)"""
            for i in range(levels)
        ]

    def climb(name: str, nodes: str, key: str) -> list[str]:
        """From level to level: the siblings so far, and the digest folded with them."""
        return [
            f"""{name}{i + 1} AS MATERIALIZED (SELECT p.* EXCLUDE (spot, proof, folded), p.spot // 2 AS spot, p.proof || coalesce(s.digest, '') AS proof,
    CASE WHEN m.n = 1 THEN p.folded WHEN s.digest IS NULL THEN sha256(p.folded)
        WHEN p.spot % 2 = 0 THEN sha256(p.folded || s.digest) ELSE sha256(s.digest || p.folded) END AS folded
    FROM {name}{i} p JOIN {nodes}{i} m ON m.{key} = p.{key} AND m.pos = p.spot
    LEFT JOIN {nodes}{i} s ON s.{key} = p.{key} AND s.pos = xor(p.spot, 1::BIGINT))"""
            for i in range(levels)
        ]

    def value(column: str) -> str:
        return f"coalesce(strlen(({column})::VARCHAR) || ':' || ({column})::VARCHAR, '-')"

    def leaf(n_chars: str) -> str:
        return "sha256(" + " || ".join(map(value, ("doc_id", "source", "lang", n_chars, "text"))) + ")"

    # DuckDB has no crc32: bytes are taken in and shifted out bit by bit.
    crc = """xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END) END))"""
    parts = [
        f"""leaves AS MATERIALIZED (SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n,
    {leaf('n_chars')} AS leaf, CASE WHEN {crc} % 7 = 0 THEN {leaf('n_chars + 1')} ELSE {leaf('n_chars')} END AS given FROM documents)""",
        "a0 AS (SELECT tree, pos, n, leaf AS digest FROM leaves)",
        *tree("a", "tree"),
        f"b0 AS (SELECT 0 AS one, tree AS pos, count(*) OVER () AS n, digest FROM a{levels})",
        *tree("b", "one"),
        "c0 AS (SELECT doc_id, leaf, tree, pos AS spot, '' AS proof, given AS folded FROM leaves)",
        *climb("c", "a", "tree"),
        f"""d0 AS (SELECT c.doc_id, c.leaf, s.digest AS subroot, 0 AS one, c.tree AS spot, c.proof, c.folded
    FROM c{levels} c JOIN a{levels} s ON s.tree = c.tree)""",
        *climb("d", "b", "one"),
    ]
    return "WITH " + ",\n".join(parts) + f"""
SELECT d.doc_id, d.leaf, d.subroot, r.digest AS root, sha256(d.proof) AS proof_sha256, d.folded AS folded_root, d.folded = r.digest AS verified
FROM d{levels} d, b{levels} r
"""


ORACLES = {
    "op2_url_filter": r"""
WITH rules(verdict, host, path) AS (VALUES
    ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
parts AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages),
fits AS (
    SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
        row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host) + length(r.path) DESC, length(r.host) DESC) AS n
    FROM parts p JOIN rules r
        ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN (SELECT * FROM fits WHERE n = 1) f ON p.page_id = f.page_id
""",
    "op6_mixing": r"""
WITH sizes AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (
    SELECT source, source_size, 3 * source_size AS cap,
        [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS weight
    FROM per_source),
filling AS (
    SELECT *, cap / weight AS level_to_cap,
        sum(source_size) OVER () AS everything,
        coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
        sum(weight) OVER () AS weights,
        coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_before
    FROM weighed),
levels AS (SELECT *, (everything - cap_before)::DOUBLE / (weights - weight_before)::DOUBLE AS level FROM filling),
aims AS (
    SELECT source, source_size,
        coalesce(least(weight * max(CASE WHEN level_to_cap > level THEN level END) OVER (), cap::DOUBLE), cap::DOUBLE) AS target
    FROM levels),
parts AS (
    SELECT *, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END)::BIGINT AS whole,
        CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END
            - floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) AS part
    FROM aims),
draws AS (
    SELECT s.doc_id, s.source, s.size, p.source_size, p.target, p.whole, k.seed,
        p.whole + CASE WHEN ('0x' || substr(md5(k.seed::VARCHAR || ':' || coalesce(s.doc_id::VARCHAR, '')), 1, 13))::BIGINT
            / 4503599627370496.0::DOUBLE < p.part THEN 1 ELSE 0 END AS copies
    FROM sizes s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source CROSS JOIN (SELECT unnest(range(16)) AS seed) k),
misses AS (
    SELECT source, seed, abs(sum(size * copies) - max(target)) AS miss FROM draws GROUP BY source, seed),
best AS (SELECT source, seed FROM (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY miss, seed) AS n FROM misses) WHERE n = 1)
SELECT d.doc_id, d.size::BIGINT AS size, d.source_size, d.target, (d.size * d.copies)::BIGINT AS taken, d.copies::BIGINT AS copies
FROM draws d JOIN best b ON d.source IS NOT DISTINCT FROM b.source AND d.seed = b.seed
""",
    "op12_collocations": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents),
numbered AS (
    SELECT lang, row_number() OVER () AS id, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT lang, id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM numbered),
windows AS MATERIALIZED (
    SELECT lang, word AS w1, lead(word) OVER x AS w2, lead(word, 2) OVER x AS w3, lead(word, 3) OVER x AS w4
    FROM words WINDOW x AS (PARTITION BY id ORDER BY i)),
grams AS (
    SELECT lang, [w1] AS g FROM windows
    UNION ALL SELECT lang, [w1, w2] FROM windows WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, [w1, w2, w3] FROM windows WHERE w3 IS NOT NULL
    UNION ALL SELECT lang, [w1, w2, w3, w4] FROM windows WHERE w4 IS NOT NULL),
f AS MATERIALIZED (SELECT lang, g, len(g) AS k, count(*) AS f FROM grams GROUP BY lang, g),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT * FROM f WHERE f >= 30),
cuts AS (
    SELECT c.lang, c.g, c.f AS a, t.k AS cut, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.f) // (x.f + y.f))::BIGINT AS score
    FROM often c JOIN (SELECT unnest([1, 2, 3]) AS k) t ON t.k < c.k
    JOIN often x ON x.lang = c.lang AND x.g = c.g[1:t.k]
    JOIN often y ON y.lang = c.lang AND y.g = c.g[t.k + 1:]
    WHERE c.k >= 2),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
longer AS (
    SELECT lang, unnest(flatten([[g[i:i + m - 1] for i in range(1, k - m + 2)] for m in range(2, k)])) AS g, f AS most
    FROM often WHERE k >= 3),
around AS (SELECT lang, g, max(most) AS most FROM longer GROUP BY lang, g),
kept AS (
    SELECT l.lang, array_to_string(l.g, ' ') AS phrase, l.a, l.l, l.r, l.score
    FROM lowest l LEFT JOIN around o ON o.lang = l.lang AND o.g = l.g
    WHERE o.most IS NULL OR 100::HUGEINT * o.most < 80::HUGEINT * l.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY k.score DESC, k.a DESC, k.phrase) AS rank, k.phrase, k.a, k.l, k.r, t.n, k.score
FROM kept k JOIN totals t ON t.lang = k.lang
QUALIFY rank <= 2000
""",
    "op13_manifest": _manifest_sql(),
    "op4_near_dedup": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS MATERIALIZED (
    SELECT doc_id, unnest(list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)])) AS s
    FROM words),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (
    SELECT c.x, c.y FROM common c JOIN sizes a ON a.doc_id = c.x JOIN sizes b ON b.doc_id = c.y
    WHERE 100 * c.n >= 75 * (a.n + b.n - c.n)),
reach AS (
    SELECT x AS doc_id, y AS other FROM links
    UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other),
least_of AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(r.other, d.doc_id)) AS component_id,
    d.doc_id = least(d.doc_id, coalesce(r.other, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least_of r ON r.doc_id = d.doc_id
""",
    "op8_nearest": """
WITH vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IS NOT NULL),
good AS MATERIALIZED (
    SELECT vec_id, min(v) AS v FROM vectors
    WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
    GROUP BY vec_id),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
    FROM good q JOIN good c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v))
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= 20
""",
    "op7_exact_dedup": """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
    doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
""",
}
