"""The operators with production settings, bound to the given tables, and SQL where it can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import (
    bpe,
    collocations,
    language,
    license_scan,
    line_dedup,
    mixing,
    ngram_join,
    quality,
    ranked_search,
    simhash,
    spans,
    top_k,
    url_filter,
)
from rollcall.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = (
    url_filter.Rule("allow", "org/"),
    url_filter.Rule("block", "example.org/es/"),
    url_filter.Rule("block", "example.org/en/1"),
    url_filter.Rule("allow", "com/fr/"),
    url_filter.Rule("block", "com/de/"),
)
# Hosts and paths no rule speaks of: betting and advertising hosts, log-in pages, executables.
URL_GLOBS = (
    url_filter.Glob("block", "**.free-bets.**"),
    url_filter.Glob("block", "**.ads-track.**"),
    url_filter.Glob("block", "**/login**"),
    url_filter.Glob("block", "**.exe"),
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url")
    judged = url_filter.judge_urls(pages, URL_RULES, URL_GLOBS)
    return judged.select("page_id", "host", "path", "rule", "verdict", "glob")


OP1_SQL = r"""
    WITH split AS (
        SELECT page_id, CASE WHEN strpos(url, '://') > 0
            THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), parts AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split
    ), told AS (
        SELECT *, CASE
            WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/en/1')
                THEN 'example.org/en/1'
            WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/es/')
                THEN 'example.org/es/'
            WHEN ends_with('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
            WHEN ends_with('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
            WHEN ends_with('.' || host, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule,
            CASE WHEN contains('.' || host || path, '.free-bets.') THEN '**.free-bets.**'
                 WHEN contains('.' || host || path, '.ads-track.') THEN '**.ads-track.**'
                 WHEN contains('.' || host || path, '/login') THEN '**/login**'
                 WHEN ends_with('.' || host || path, '.exe') THEN '**.exe' END AS any_glob
        FROM parts
    )
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                WHEN any_glob IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
           CASE WHEN rule IS NULL THEN any_glob END AS glob
    FROM told"""


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, _table(spark, folder, "labels"))
    judged = quality.judge_quality(docs, model)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "probability",
    )


def op3_spans(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return spans.remove_repeated(docs).select("doc_id", "n_removed", "text")


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select(
        F.col("row_id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return bpe.decode_digest(bpe.encode(docs))


def op6_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = top_k.quantized(_table(spark, folder, "embeddings"))
    return top_k.top_k(vectors, vectors.filter(F.col("vec_id") % top_k.EVERY == 0))


OP6_SQL = """
    WITH good AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
        FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), asked AS (
        SELECT DISTINCT vec_id, q FROM good WHERE vec_id % 50 = 0
    ), scored AS (
        SELECT a.vec_id AS query_id, a.q AS query, b.vec_id,
               list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS score
        FROM asked a JOIN good b ON a.vec_id <> b.vec_id
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id, query ORDER BY score DESC, vec_id) AS rank
        FROM scored
    )
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
    FROM ranked WHERE rank <= 5"""


def op7_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source")


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language.train(docs.filter(~held_out))
    told = language.identify(docs.select("doc_id", "text"), model)
    return told.select(
        "doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


def op9_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    kept = line_dedup.without_common_lines(docs)
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


OP9_SQL = r"""
    WITH split AS (
        SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
    ), listed AS (
        SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split
    ), keyed AS (
        SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM listed
    ), common AS (
        SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 40
        GROUP BY key HAVING count(DISTINCT doc_id) >= 5
    ), told AS (
        SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.last_doc AS gone
        FROM keyed k LEFT JOIN common c ON k.key = c.key
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), ''))
               AS kept_sha256
    FROM told GROUP BY doc_id"""


def op10_license(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return license_scan.scan(docs).drop("spans")


def op11_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return ngram_join.similar_groups(docs)


OP11_SQL = r"""
    WITH RECURSIVE split AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), grams AS (
        SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
            END) AS gram FROM split
    ), held AS (
        SELECT DISTINCT doc_id, gram FROM grams
    ), sizes AS (
        SELECT doc_id, count(*) AS n FROM held GROUP BY doc_id
    ), common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
        FROM held a JOIN held b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
    ), linked AS (
        SELECT c.a, c.b FROM common c JOIN sizes s ON c.a = s.doc_id JOIN sizes t ON c.b = t.doc_id
        WHERE 100 * c.c >= 90 * (s.n + t.n - c.c)
    ), reach(doc_id, other) AS (
        SELECT doc_id, doc_id FROM documents
        UNION SELECT r.doc_id, l.b FROM reach r JOIN linked l ON r.other = l.a
    ), least AS (
        SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least.component_id
    FROM documents d JOIN least ON d.doc_id = least.doc_id LEFT JOIN sizes s ON d.doc_id = s.doc_id"""


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


OP12_SQL = r"""
    WITH held AS (
        SELECT doc_id, row_number() OVER () AS place,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+') AS terms FROM documents
    ), total AS (
        SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS all_terms FROM held WHERE len(terms) > 0
    ), asked AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark
    ), listed AS (
        SELECT place, len(terms) AS n, unnest(terms) AS term FROM held
    ), counted AS (
        SELECT place, n, term, count(*) AS tf FROM listed
        WHERE term IN (SELECT term FROM asked) GROUP BY place, n, term
    ), weights AS (
        SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM counted, total GROUP BY term, docs
    ), impacts AS (
        SELECT c.place, c.term,
               w.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // all_terms))) AS impact
        FROM counted c JOIN weights w ON c.term = w.term, total
    ), scored AS (
        SELECT a.item_id, i.place, CAST(sum(impact) AS BIGINT) AS score
        FROM asked a JOIN impacts i ON a.term = i.term GROUP BY a.item_id, i.place
    ), ranked AS (
        SELECT s.item_id, h.doc_id, score,
               row_number() OVER (PARTITION BY s.item_id ORDER BY score DESC, h.doc_id) AS rank
        FROM scored s JOIN held h ON s.place = h.place WHERE score > 0
    )
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50"""


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(_table(spark, folder, "documents"))


OP13_SQL = r"""
    WITH pieces AS (
        SELECT lang, row_number() OVER () AS piece, regexp_extract_all(part, '[^\x20\x09]+') AS w FROM (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS part
            FROM documents)
    ), runs AS (
        SELECT lang, unnest(w) AS one, unnest(list_concat(w[2:], [NULL])) AS two,
               unnest(list_concat(w[3:], [NULL, NULL])[1:len(w)]) AS three FROM pieces WHERE len(w) > 0
    ), ones AS (
        SELECT lang, one, count(*) AS f FROM runs GROUP BY lang, one
    ), totals AS (
        SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM ones GROUP BY lang
    ), twos AS (
        SELECT lang, one, two, count(*) AS f FROM runs WHERE two IS NOT NULL GROUP BY lang, one, two
    ), threes AS (
        SELECT lang, one, two, three, count(*) AS f FROM runs WHERE three IS NOT NULL
        GROUP BY lang, one, two, three HAVING count(*) >= 10
    ), longer AS (
        SELECT lang, one, two, max(f) AS f FROM (
            SELECT lang, one, two, f FROM threes UNION ALL SELECT lang, two, three, f FROM threes)
        GROUP BY lang, one, two
    ), found AS (
        SELECT t.lang, t.one || ' ' || t.two AS phrase, t.f AS a, x.f AS l, y.f AS r
        FROM twos t JOIN ones x ON t.lang = x.lang AND t.one = x.one
        JOIN ones y ON t.lang = y.lang AND t.two = y.one
        LEFT JOIN longer g ON t.lang = g.lang AND t.one = g.one AND t.two = g.two
        WHERE t.f >= 10 AND (g.f IS NULL OR 100 * g.f < 50 * t.f)
        UNION ALL
        SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END
        FROM (
            SELECT t.lang, t.one || ' ' || t.two || ' ' || t.three AS phrase, t.f AS a,
                   x.f AS l1, v.f AS r1, u.f AS l2, z.f AS r2,
                   (1000000 * CAST(t.f AS HUGEINT) * t.f) // (CAST(x.f AS HUGEINT) * v.f) AS s1,
                   (1000000 * CAST(t.f AS HUGEINT) * t.f) // (CAST(u.f AS HUGEINT) * z.f) AS s2
            FROM threes t JOIN ones x ON t.lang = x.lang AND t.one = x.one
            JOIN ones z ON t.lang = z.lang AND t.three = z.one
            JOIN twos u ON t.lang = u.lang AND t.one = u.one AND t.two = u.two
            JOIN twos v ON t.lang = v.lang AND t.two = v.one AND t.three = v.two)
    ), scored AS (
        SELECT *, CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score
        FROM found
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored
    )
    SELECT r.lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r.r, n, score
    FROM ranked r JOIN totals t ON r.lang = t.lang WHERE rank <= 2000"""


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_quality": op2_quality,
    "op3_spans": op3_spans,
    "op4_simhash": op4_simhash,
    "op5_bpe": op5_bpe,
    "op6_top_k": op6_top_k,
    "op7_mix": op7_mix,
    "op8_language": op8_language,
    "op9_lines": op9_lines,
    "op10_license": op10_license,
    "op11_ngram_join": op11_ngram_join,
    "op12_ranked_search": op12_ranked_search,
    "op13_collocations": op13_collocations,
}
SQL: dict[str, str] = {
    "op1_url_filter": OP1_SQL,
    "op6_top_k": OP6_SQL,
    "op9_lines": OP9_SQL,
    "op11_ngram_join": OP11_SQL,
    "op12_ranked_search": OP12_SQL,
    "op13_collocations": OP13_SQL,
}


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return query(spark, folder)

    return run


def queries() -> dict[str, Query]:
    return {name: _shipped(query) for name, query in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
