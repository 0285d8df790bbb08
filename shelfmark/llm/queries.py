"""The operators applied to whole tables with production parameters, and the same results in DuckDB's SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_TOKENIZER, PIECE_MODEL = "word_bpe_49k.json", "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.fingerprints import fingerprint_documents

    return fingerprint_documents(_table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.ngramjoin import join_documents

    return join_documents(_table(spark, sf_dir, "documents"), size=4, percent=85)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm import toxicity

    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(~toxicity.held_out("doc_id")))
    scores = toxicity.score(docs, model)
    return scores.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm import common, tokenfile

    docs = _table(spark, sf_dir, "documents")
    path = tokenfile.write_token_ids(docs, common.shared_dir(spark, "token-ids"), public_tokenizers.path(WORD_TOKENIZER))
    return tokenfile.token_summary(tokenfile.read_token_ids(spark, path))


#: Fixed rules of this query.
URL_RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.urlfilter import filter_urls

    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op6_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.extraction import extract

    return extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.packing import pack

    pieces = pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.pieces import encode_pieces

    rows = encode_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.crc32(F.concat("starts", "ends")).alias("spans_crc32"),
    )


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.topk import exact_top_k

    return exact_top_k(_table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", 5)


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.substrings import find_repeats

    found = find_repeats(_table(spark, sf_dir, "documents"), columns=["doc_id"])
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.prefixtrie import prefix_trie

    return prefix_trie(_table(spark, sf_dir, "conversations")).drop("position", "end")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.repair import repair_conversations

    return repair_conversations(_table(spark, sf_dir, "conversations"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.simhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_ngram_join": op2_ngram_join,
    "op3_toxicity": op3_toxicity,
    "op4_token_file": op4_token_file,
    "op5_url_filter": op5_url_filter,
    "op6_extraction": op6_extraction,
    "op7_packing": op7_packing,
    "op8_pieces": op8_pieces,
    "op9_top_k": op9_top_k,
    "op10_substrings": op10_substrings,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_repair": op12_repair,
    "op13_simhash": op13_simhash,
}

ORACLE_SQL = {
    "op2_ngram_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), grams AS (
            SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 3], ' ') END AS g
            FROM words, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM grams GROUP BY 1
        ), met AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
        ), links AS (
            SELECT a, b FROM met JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * met.n >= 85 * (x.n + y.n - met.n)
        ), pairs AS (
            SELECT a, b FROM links UNION ALL SELECT b, a FROM links
        ), reached(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reached r JOIN pairs l ON r.other = l.a
        )
        SELECT d.doc_id, CAST(coalesce(max(s.n), 0) AS BIGINT) AS n_shingles, min(r.other) AS component_id
        FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id LEFT JOIN reached r ON d.doc_id = r.doc_id GROUP BY d.doc_id
    """,
    "op10_substrings": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), starts AS (
            SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS g FROM words, unnest(range(1, len(w) - 18)) AS t(i)
        ), repeated AS (
            SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM starts) WHERE n > 1
        ), gone AS (
            SELECT DISTINCT doc_id, i + j AS i FROM repeated, range(20) AS t(j)
        ), kept AS (
            SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.i) AS text, count(*) AS n
            FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words) x LEFT JOIN gone USING (doc_id, i) WHERE gone.doc_id IS NULL GROUP BY 1
        )
        SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
        FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
    """,
    # the tables' pages hold their main text in an article element of headings and paragraphs
    "op6_extraction": r"""
        WITH inner_html AS (
            SELECT page_id, url, replace(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '<br>', ' ') AS h FROM pages
        ), parts AS (
            SELECT page_id, url, list_transform(regexp_split_to_array(h, '</?(?:h1|p)>'), lambda x:
                trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '</?b>', '', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS p FROM inner_html
        ), texts AS (
            SELECT page_id, url, coalesce(array_to_string(list_filter(p, lambda x: x <> ''), chr(10)), '') AS text FROM parts
        )
        SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM texts
    """,
    "op5_url_filter": r"""
        WITH parts AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), split AS (
            SELECT page_id,
                translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM parts
        ), rules(verdict, rule_host, rule_path) AS (
            VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')
        ), best AS (
            SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                arg_max(verdict, length(rule_host || rule_path)) AS verdict
            FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY page_id
        )
        SELECT split.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM split LEFT JOIN best USING (page_id)
    """,
    "op9_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 50 = 0 AND len(q.e) = len(c.e)
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
        )
        SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
    """,
    "op11_prefix_trie": r"""
        WITH RECURSIVE own AS (
            SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
                len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
            FROM conversations WHERE conv_id IS NOT NULL
        ), names AS (
            SELECT DISTINCT c, CAST(c AS VARCHAR) AS s FROM own
        ), convs AS (  -- CRC-32 of the decimal number, a step for each character and bit
            SELECT c, c - c % 20 AS source, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(s) + 1), lambda i:
                list_prepend(CAST(ord(substr(s, i, 1)) AS BIGINT), list_transform(range(8), lambda j: -1::BIGINT))))), lambda a, x:
                CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END) END), 4294967295::BIGINT) % 4 AS h
            FROM names
        ), heads AS (
            SELECT v.c, o.p, o.k, o.w FROM convs v JOIN own o ON o.c = v.source AND o.p <= v.h
        ), taken AS (
            SELECT c, count(*) AS n FROM heads GROUP BY c
        ), paths AS (
            SELECT * FROM heads UNION ALL
            SELECT o.c, o.p - v.h + coalesce(t.n, 0), o.k, o.w FROM own o JOIN convs v USING (c) LEFT JOIN taken t USING (c) WHERE o.p > v.h
        ), prefixes AS (
            SELECT c, w, list(k) OVER (PARTITION BY c ORDER BY p) AS node FROM paths
        ), nodes AS (
            SELECT node, min(c) AS conv_id, count(*) AS n_convs, max(w) AS w FROM prefixes GROUP BY node
            UNION ALL SELECT CAST([] AS VARCHAR[]), min(c), count(*), 0 FROM convs HAVING count(*) > 0
        ), parents AS (
            SELECT *, CASE WHEN len(node) > 0 THEN node[1 : len(node) - 1] END AS up FROM nodes
        ), children AS (
            SELECT up AS node, count(*) AS n FROM parents WHERE up IS NOT NULL GROUP BY up
        ), own_sums AS (
            SELECT p.node, CASE WHEN c.n IS NULL THEN 1 ELSE 0 END AS leaf, (p.n_convs - 1) * p.w AS saved FROM parents p LEFT JOIN children c USING (node)
        ), sums AS (
            SELECT node[1 : d] AS node, sum(leaf) AS leaves, sum(saved) AS saved FROM own_sums, unnest(range(len(node) + 1)) AS t(d) GROUP BY 1
        ), last AS (
            SELECT v.c, coalesce(max_by(p.node, len(p.node)), CAST([] AS VARCHAR[])) AS node FROM convs v LEFT JOIN prefixes p USING (c) GROUP BY v.c
        ), ends AS (
            SELECT node, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS h FROM last GROUP BY node
        )
        SELECT n.conv_id, CAST(len(n.node) AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
            CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.h, sha256('')) AS ends_sha256
        FROM parents n LEFT JOIN nodes u ON u.node = n.up LEFT JOIN children c ON c.node = n.node JOIN sums s ON s.node = n.node LEFT JOIN ends e ON e.node = n.node
    """,
    "op12_repair": r"""
        WITH RECURSIVE given AS (
            SELECT coalesce(CAST(conv_id AS VARCHAR), ' ') AS name, turn, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations
        ), kinds AS (  -- CRC-32, a step for each character and bit
            SELECT s, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(s) + 1), lambda i:
                list_prepend(CAST(ord(substr(s, i, 1)) AS BIGINT), list_transform(range(8), lambda j: -1::BIGINT))))), lambda a, x:
                CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END) END), 4294967295::BIGINT) % 20 AS kind
            FROM (SELECT DISTINCT s FROM given)
        ), damaged AS (
            SELECT name, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, n
            FROM given JOIN kinds USING (s), unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS t(n) WHERE kind <> 0
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY name ORDER BY turn NULLS FIRST, n) AS p FROM damaged
        ), faulty AS (
            SELECT *, substr(role, 1, 1) AS i, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY name, role, text ORDER BY p) > 1 AS again,
                regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS cut_off FROM placed
        ), turns AS (
            SELECT *, blank OR again AS must, CASE WHEN cut_off AND NOT blank AND NOT again THEN 1 ELSE 0 END AS late, lag(i) OVER (PARTITION BY name ORDER BY p) AS before FROM faulty
        ), sizes AS (
            SELECT name, max(p) AS n FROM turns GROUP BY name
        ), walk(name, p, v) AS (  -- cheapest edits from a turn on, for nothing before it, s, u, and a
            SELECT name, n, [{'c': 0, 'a': '', 'k': CAST([] AS VARCHAR[])}, {'c': 4, 'a': 'II', 'k': ['user:', 'assistant:']}, {'c': 2, 'a': 'I', 'k': ['assistant:']}, {'c': 0, 'a': '', 'k': CAST([] AS VARCHAR[])}] FROM sizes
            UNION ALL
            SELECT name, p - 1, [
                list_sort([b[1], {'c': u.c + 2, 'a': 'I' || u.a, 'k': list_prepend('user:', u.k)}])[1], list_sort([b[2], {'c': u.c + 2, 'a': 'I' || u.a, 'k': list_prepend('user:', u.k)}])[1], u,
                list_sort([b[4], {'c': b[3].c + 2, 'a': 'I' || b[3].a, 'k': list_prepend('user:', b[3].k)}])[1]]
            FROM (
                SELECT name, p, b, list_sort([b[3], {'c': b[4].c + 2, 'a': 'I' || b[4].a, 'k': list_prepend('assistant:', b[4].k)}])[1] AS u
                FROM (
                    SELECT name, p, list_transform(range(1, 5), lambda s: list_sort([
                        {'c': v[s].c + 3, 'a': 'D' || v[s].a, 'k': v[s].k},
                        CASE WHEN NOT must THEN {'c': v[CASE WHEN s = 3 THEN 4 ELSE 3 END].c + 2 + late, 'a': 'R' || v[CASE WHEN s = 3 THEN 4 ELSE 3 END].a,
                            'k': list_prepend(CASE WHEN s = 3 THEN 'assistant:' ELSE 'user:' END || text, v[CASE WHEN s = 3 THEN 4 ELSE 3 END].k)} END,
                        CASE WHEN NOT must AND ((i = 's' AND s = 1) OR (i = 'u' AND s <> 3) OR (i = 'a' AND s = 3)) THEN
                            {'c': v[CASE i WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].c + late, 'a': 'K' || v[CASE i WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].a, 'k': list_prepend(role || ':' || text, v[CASE i WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].k)} END
                        ])[1]) AS b
                    FROM walk JOIN turns USING (name, p)
                )
            )
        ), counts AS (
            SELECT name, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS again, CAST(sum(late) AS BIGINT) AS late,
                count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY name
        )
        SELECT g.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.again, 0) AS duplicate, coalesce(c.late, 0) AS truncated, coalesce(c.illegal, 0) AS illegal,
            CAST(coalesce(w.v[1].c, 0) AS BIGINT) AS cost, coalesce(w.v[1].a, '') AS audit, sha256(coalesce(array_to_string(w.v[1].k, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), ' ') AS name FROM conversations) g LEFT JOIN counts c USING (name) LEFT JOIN walk w ON w.name = g.name AND w.p = 0
    """,
}
