"""The registered queries of the training-data operators, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chats, decontam, embeddings, langid, minhash, mixing, quality, repair, shards, substring, trie, urls, warc


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = warc.archive_round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), 50)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), 0.9)


#: The rules of the query.
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block")]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return urls.judge_urls(pages, urls.rule_table(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return mixing.mix_documents(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontam.contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.format_chats(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), width=2, percent=80)


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return repair.report(repair.repair_conversations(repair.damaged(turns)))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie_report(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_language_id": op3_language_id,
    "op4_shards": op4_shards,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_mixing": op7_mixing,
    "op8_decontamination": op8_decontamination,
    "op9_chat_format": op9_chat_format,
    "op10_minhash": op10_minhash,
    "op11_repair": op11_repair,
    "op12_quality": op12_quality,
    "op13_prefix_trie": op13_prefix_trie,
}



def crc32_sql(text: str) -> str:
    """DuckDB has no CRC-32; this is its bitwise form for ASCII text."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)),
        lambda x, b: list_reduce(list_prepend(xor(x, b), range(8)), lambda y, k: xor(y >> 1, 3988292384::BIGINT * (y & 1)))), 4294967295::BIGINT)"""


ORACLE: dict[str, str] = {
    "op1_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        g AS (SELECT body, min(page_id) AS origin FROM p GROUP BY body),
        x AS (SELECT page_id, body, origin, sha1(body) AS hex FROM p JOIN g USING (body))
        SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes,
               list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((('0x' || substr(hex, (k // 4)::INT * 5 + 1, 5))::BIGINT >> (15 - 5 * (k % 4))) & 31)::INT, 1)),
                   'string_agg', '') AS payload_digest,
               CASE WHEN page_id <> origin OR page_id IS NULL AND origin IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id <> origin OR page_id IS NULL THEN origin END AS refers_to
        FROM x""",
    "op2_substring_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS row, doc_id,
                       list_filter(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
        k AS (SELECT row, doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS h
              FROM (SELECT row, doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d)),
        m AS (SELECT h, min(doc_id) AS least FROM k GROUP BY h),
        c AS (SELECT DISTINCT row, p FROM (SELECT row, unnest(range(s, s + 50)) AS p FROM k JOIN m USING (h) WHERE least < doc_id)),
        r AS (SELECT row, list(p) AS gone FROM c GROUP BY row)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
               sha256(coalesce(array_to_string(list_filter(w, lambda x, i: gone IS NULL OR NOT list_contains(gone, i)), ' '), '')) AS kept_sha256
        FROM d LEFT JOIN r USING (row)""",
    "op5_embedding_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
        u AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(e, lambda x: x <> 0)) > 0),
        l AS (SELECT p.vec_id AS a, q.vec_id AS b FROM u p JOIN u q ON p.vec_id <> q.vec_id
              WHERE list_cosine_similarity(p.e, q.e) >= 0.9),
        r AS (SELECT vec_id AS v, vec_id AS c FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.v),
        n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a),
        m AS (SELECT v AS vec_id, min(c) AS component_id FROM r GROUP BY v)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
        FROM v LEFT JOIN n USING (vec_id) JOIN m USING (vec_id)""",
    "op6_url_filter": r"""
        WITH r(rule, rule_host, rule_path, verdict) AS (VALUES
            ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
            ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
            ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
        u AS (SELECT DISTINCT url,
                coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
        m AS (SELECT url, any_value(host) AS host, any_value(path) AS path,
                arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
              FROM (SELECT u.*, r.rule, r.verdict FROM u LEFT JOIN r
                    ON (u.host = r.rule_host OR ends_with(u.host, '.' || r.rule_host)) AND starts_with(u.path, r.rule_path))
              GROUP BY url)
        SELECT page_id, m.host, m.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
        FROM pages JOIN m ON pages.url IS NOT DISTINCT FROM m.url""",
    "op9_chat_format": """
        WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST,
                       text NULLS FIRST) AS place, role, text FROM conversations),
        c AS (SELECT conv_id, list(struct_pack(r := role, t := text) ORDER BY place) AS turns,
                string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10),
                           '' ORDER BY place) AS rendered FROM t GROUP BY conv_id),
        w AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS copies, any_value(rendered) AS rendered FROM c GROUP BY turns),
        p AS (SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM w))
        SELECT conv_id, len(turns)::BIGINT AS n_turns, copies, rendered FROM w
        WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.turns = w.turns)""",
    "op10_minhash": r"""
        WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
        x AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END) AS s FROM d),
        n AS (SELECT doc_id, count(*) AS n FROM x GROUP BY doc_id),
        i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM x a JOIN x b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
        l AS (SELECT i.a, i.b FROM i JOIN n p ON p.doc_id = i.a JOIN n q ON q.doc_id = i.b WHERE 100 * common >= 80 * (p.n + q.n - common)),
        e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
        r AS (SELECT doc_id AS v, doc_id AS c FROM d UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.v)
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
        FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT v AS doc_id, min(c) AS component_id FROM r GROUP BY v) USING (doc_id)""",
    # Forwards, with the cheapest edits from the start to each of the four states so far, of equal ones the least letters.
    "op11_repair": rf"""
        WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k FROM conversations),
        d AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, copy,
                CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
              FROM c, (SELECT unnest([1, 2]) AS copy) WHERE k <> 0 AND (copy = 1 OR k = 3)),
        n AS (SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text
                ORDER BY turn NULLS FIRST, copy) > 1 AS again, lag(role[1]) OVER w || role[1] AS pair,
                regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare
              FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
        f AS (SELECT conv_id, turn, i, role, text, bare = '' AS blank, bare <> '' AND again AS duplicate,
                bare <> '' AND NOT again AND NOT suffix(bare, '.') AND NOT suffix(bare, '!') AND NOT suffix(bare, '?') AS truncated,
                pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au') AS illegal FROM n),
        far AS (SELECT {{'c': 1000000, 'a': '', 'o': []::VARCHAR[]}} AS x),
        r AS (SELECT conv_id, 0 AS i, {{'c': 0, 'a': '', 'o': []::VARCHAR[]}} AS s0, x AS s1, x AS s2, x AS s3
              FROM (SELECT DISTINCT conv_id FROM conversations), far
            UNION ALL
              SELECT r.conv_id, f.i,
                {{'c': p0.c + 4, 'a': p0.a || 'D', 'o': p0.o}},
                list_sort([{{'c': p1.c + 4, 'a': p1.a || 'D', 'o': p1.o}},
                    {{'c': p0.c + e + CASE WHEN role[1] = 's' THEN 0 ELSE 1000000 END, 'a': p0.a || 'K', 'o': list_append(p0.o, line)}}])[1],
                list_sort(list_concat([{{'c': p2.c + 4, 'a': p2.a || 'D', 'o': p2.o}}], list_concat(
                    list_transform([p0, p1, p3], lambda p: {{'c': p.c + e + CASE WHEN role[1] = 'u' THEN 0 ELSE 1000000 END, 'a': p.a || 'K',
                        'o': list_append(p.o, line)}}),
                    list_transform([p0, p1, p3], lambda p: {{'c': p.c + e + 3, 'a': p.a || 'R', 'o': list_append(p.o, 'user:' || text)}}))))[1],
                list_sort([{{'c': p3.c + 4, 'a': p3.a || 'D', 'o': p3.o}},
                    {{'c': p2.c + e + CASE WHEN role[1] = 'a' THEN 0 ELSE 1000000 END, 'a': p2.a || 'K', 'o': list_append(p2.o, line)}},
                    {{'c': p2.c + e + 3, 'a': p2.a || 'R', 'o': list_append(p2.o, 'assistant:' || text)}}])[1]
              FROM (SELECT conv_id, i, s0 AS p0, s1 AS p1, p2,
                        list_sort([s3, {{'c': p2.c + 3, 'a': p2.a || 'I', 'o': list_append(p2.o, 'assistant:')}}])[1] AS p3
                    FROM (SELECT *, list_sort([s2, {{'c': s0.c + 3, 'a': s0.a || 'I', 'o': list_append(s0.o, 'user:')}},
                        {{'c': s1.c + 3, 'a': s1.a || 'I', 'o': list_append(s1.o, 'user:')}},
                        {{'c': s3.c + 3, 'a': s3.a || 'I', 'o': list_append(s3.o, 'user:')}}])[1] AS p2 FROM r)) r
              JOIN (SELECT *, role || ':' || text AS line, CASE WHEN blank OR duplicate THEN 1000000 WHEN truncated THEN 3 ELSE 0 END AS e FROM f) f
                ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i + 1),
        t AS (SELECT conv_id, max(i) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (blank) AS blank,
                count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
              FROM f GROUP BY conv_id),
        z AS (SELECT r.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
                coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
                list_sort([s0, s3, {{'c': s2.c + 3, 'a': s2.a || 'I', 'o': list_append(s2.o, 'assistant:')}},
                    {{'c': s1.c + 6, 'a': s1.a || 'II', 'o': list_concat(s1.o, ['user:', 'assistant:'])}}])[1] AS best
              FROM r LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM r.conv_id WHERE r.i = coalesce(n, 0))
        SELECT conv_id, gaps::BIGINT AS gaps, blank::BIGINT AS blank, duplicate::BIGINT AS duplicate, truncated::BIGINT AS truncated,
               illegal::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit, sha256(array_to_string(best.o, chr(10))) AS repaired_sha256
        FROM z""",
    "op13_prefix_trie": f"""
        WITH t AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
              FROM conversations WHERE conv_id IS NOT NULL),
        o AS (SELECT conv_id, list({{'r': r, 'x': x}} ORDER BY place) AS own, {crc32_sql("conv_id::VARCHAR")} % 6 AS h FROM t GROUP BY conv_id),
        c AS (SELECT o.conv_id, list_concat(coalesce(b.own[1:o.h], []), o.own[o.h + 1:]) AS turns
              FROM o LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 100),
        n AS (SELECT key, len(key) AS depth, key[1:len(key) - 1] AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
                (count(*) - 1) * coalesce(length(any_value(key)[-1].x), 0) AS weight,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (total = depth), '')) AS ends_sha256
              FROM (SELECT conv_id, len(turns) AS total, d AS depth, turns[1:d] AS key FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM c))
              GROUP BY key),
        k AS (SELECT up AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY up),
        m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (key)),
        s AS (SELECT key[1:d] AS key, sum(weight) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
              FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM m) GROUP BY 1)
        SELECT m.conv_id, m.depth::BIGINT AS depth, CASE WHEN m.depth > 0 THEN p.conv_id END AS parent_conv_id, m.n_convs::BIGINT AS n_convs,
               m.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, m.ends_sha256
        FROM m JOIN s USING (key) LEFT JOIN n p ON p.key = m.up""",
}
