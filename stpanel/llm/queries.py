"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stpanel.llm import exact, jaccard, langid, pii, pseudo
from stpanel.llm.ann import nearest
from stpanel.llm.bpe import encode, load_ranks
from stpanel.llm.licenses import PHRASES, TEMPLATES, THRESHOLD, scan
from stpanel.llm.mixing import mix
from stpanel.llm.phrases import collocations
from stpanel.llm.topk import exact_top_k
from stpanel.llm.trie import trie
from stpanel.llm.urls import judge, rule_table

RANKS = "byte_bpe_50k.tiktoken"
#: Fixed rules (host, path, verdict) of the URL query.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_query() -> Column:
    return F.coalesce(F.col("vec_id") % 20 == 0, F.lit(False))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = load_ranks(public_tokenizers.path(RANKS))
    coded = encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


ORACLES["op2_source_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS key
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source
), running AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(3 * source_size) OVER w, 0) AS held, coalesce(sum(weight) OVER w, 0) AS gone,
         row_number() OVER (ORDER BY 3 * source_size / weight::DOUBLE, source) AS place
  FROM per
  WINDOW w AS (ORDER BY 3 * source_size / weight::DOUBLE, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT place, total - held AS rest, weights - gone AS free FROM running
  WHERE (total - held) * weight <= 3 * source_size * (weights - gone) ORDER BY place LIMIT 1
), goals AS (
  SELECT r.source, r.source_size,
         CASE WHEN l.place IS NULL OR r.place < l.place THEN (3 * r.source_size)::DOUBLE
              ELSE (r.weight * l.rest)::DOUBLE / l.free::DOUBLE END AS target
  FROM running r LEFT JOIN level l ON true
), placed AS (
  SELECT s.*, g.source_size, g.target, floor(g.target)::BIGINT AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0 ELSE
          size * (budget // source_size)
          + greatest(0, least(size, budget % source_size - before)) END)::BIGINT AS taken
FROM placed
"""


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = langid.learn(docs.filter(~langid.held_out()))
    return langid.predict(docs, filters, keep=["doc_id", langid.held_out().alias("held_out")])


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents")).drop("row", "row2", "component")


ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op4_jaccard_join"] = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({ASCII_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS low FROM sets
  UNION SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.doc_id
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.low) AS component_id
FROM sets s JOIN reach r USING (doc_id) GROUP BY s.doc_id, len(s.s)
"""


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    phrases = ", ".join(f"({t.split()}, '{label}')" for t, label in PHRASES.items())
    needed = [(t.split(), label, -(-len(set(t.split())) * round(100 * THRESHOLD) // 100)) for t, label in TEMPLATES.items()]
    templates = ", ".join(f"({i}, {t}, '{label}', {n})" for i, (t, label, n) in enumerate(needed))
    return rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), places AS (
  SELECT doc_id, i - 1 AS pos, label, 1.0::DOUBLE AS share
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words)
  JOIN (VALUES {phrases}) AS p(phrase, label) ON w[i:i + len(phrase) - 1] = phrase
), templates AS (
  SELECT *, unnest(list_distinct(wanted)) AS word, len(list_distinct(wanted)) AS size, len(wanted) - 1 AS reach
  FROM (VALUES {templates}) AS t(id, wanted, label, needed)
), hits AS (
  SELECT * FROM (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM words)
  WHERE word IN (SELECT word FROM templates)
), blocks AS (
  SELECT h.doc_id, t.label, count(DISTINCT o.word) / t.size AS share
  FROM hits h JOIN templates t ON t.word = h.word
  JOIN hits o ON o.doc_id = h.doc_id AND abs(o.pos - h.pos) <= t.reach
  JOIN templates u ON u.id = t.id AND u.word = o.word
  GROUP BY h.doc_id, h.pos, t.id, t.label, t.size, t.needed HAVING count(DISTINCT o.word) >= t.needed
), base AS (
  SELECT doc_id, count(*) AS n, min(pos) AS lowest, max(pos) AS highest, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM places GROUP BY doc_id
), every AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT doc_id, label, share FROM places UNION ALL SELECT * FROM blocks) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lowest::BIGINT AS first_word,
       highest::BIGINT AS last_word, coalesce(base.labels, '') AS base_labels, coalesce(every.labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM words LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id)
"""


ORACLES["op5_license_scan"] = _license_sql()


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = pii.train(pii.labelled_table(spark))
    found = pii.find(table(spark, sf_dir, "documents"), field)
    return found.select(
        "doc_id",
        *[_count(kind) for kind in pii.KINDS],
        F.sha2(pii.digest("base"), 256).alias("base_sha256"),
        pii.digest("spans").alias("spans"),
    )


def op7_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = pseudo.word_counts(docs)
    frequent = pseudo.most_frequent(counts)
    known = pseudo.coded(docs, frequent, counts=counts)
    return pseudo.score(docs, pseudo.fit(docs, frequent, known=known), frequent, counts=counts, known=known)


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), is_query())


ORACLES["op8_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: coalesce(p[1] * p[2], 0))), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM pairs
) WHERE rank <= 20
"""


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rule_table(spark, URL_RULES))


ORACLES["op9_url_rules"] = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), urls AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), fitted AS (
  SELECT *, CASE
    WHEN ends_with('.' || host, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/') THEN 'com/'
  END AS rule FROM urls
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN host = '' THEN 'block' ELSE 'allow' END AS verdict
FROM fitted
"""


def op10_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), is_query())


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_collocations"] = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({ASCII_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), sizes AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), counts AS (
  SELECT lang, phrase, k, count(*) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM words, (SELECT unnest([1, 2, 3, 4]) AS k))
  GROUP BY ALL
), candidates AS (
  SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 30
), cuts AS (
  SELECT *, unnest(range(1, k)) AS cut FROM candidates
), scores AS (
  SELECT c.lang, c.phrase, c.k, c.a, x.f AS l, y.f AS r, cut, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')
), least AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, a AS f, array_to_string(w[i:i + j - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(2, k)) AS j FROM candidates), (SELECT unnest([1, 2, 3]) AS i) WHERE i + j - 1 <= k
), around AS (
  SELECT lang, phrase, max(f) AS most FROM inside GROUP BY ALL
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank,
       s.phrase, a, l, r, n, score
FROM least s JOIN sizes USING (lang) LEFT JOIN around o ON o.lang = s.lang AND o.phrase = s.phrase
WHERE coalesce(100::HUGEINT * most < 80::HUGEINT * a, true) QUALIFY rank <= 2000
"""


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.mark(table(spark, sf_dir, "documents"))


ORACLES["op12_exact_dedup"] = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM texts
"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


ORACLES["op13_prefix_trie"] = r"""
WITH RECURSIVE ids AS (
  SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS k, 4294967295::BIGINT AS c FROM ids
  UNION ALL
  SELECT conv_id, s, k + 1,
         list_reduce(list_concat([xor(c, ord(s[k + 1])::BIGINT)], range(8)), lambda x, i:
           CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
  FROM crc WHERE k < length(s)
), heads AS (
  SELECT conv_id, xor(c, 4294967295) % 4 AS h FROM crc WHERE k = length(s)
), told AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), coded AS (
  SELECT *, sha256(octet_length(encode(role)) || ':' || role || text) AS d,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS words FROM told
), own AS (
  SELECT conv_id, list(struct_pack(d := d, words := words) ORDER BY turn NULLS FIRST, d) AS p FROM coded GROUP BY conv_id
), built AS (
  SELECT o.conv_id, list_concat(coalesce(b.p[1:h.h], []), o.p[h.h + 1:]) AS p
  FROM own o JOIN heads h USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
), prefixes AS (
  SELECT conv_id, d, len(p) AS size, list_transform(p[1:d], lambda e: e.d) AS path,
         CASE WHEN d = 0 THEN 0 ELSE p[d].words END AS words
  FROM (SELECT *, unnest(range(len(p) + 1)) AS d FROM built)
), nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends_sha256
  FROM prefixes GROUP BY path, d
), children AS (
  SELECT path[1:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), subtrees AS (
  SELECT path[1:up] AS path, sum((n_convs - 1) * words)::BIGINT AS saved_tokens, count(*) FILTER (leaf)::BIGINT AS n_leaves
  FROM (SELECT n.*, c.n IS NULL AS leaf, unnest(range(n.d + 1)) AS up FROM nodes n LEFT JOIN children c ON c.path = n.path)
  GROUP BY 1
)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
       s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s ON s.path = n.path LEFT JOIN children c ON c.path = n.path
LEFT JOIN nodes u ON n.d > 0 AND u.path = n.path[1:n.d - 1]
"""


QUERIES = {
    fn.__name__: fn
    for fn in (
        op1_byte_bpe,
        op2_source_mix,
        op3_language_id,
        op4_jaccard_join,
        op5_license_scan,
        op6_personal_data,
        op7_pseudo_likelihood,
        op8_exact_top_k,
        op9_url_rules,
        op10_cross_polytope,
        op11_collocations,
        op12_exact_dedup,
        op13_prefix_trie,
    )
}
