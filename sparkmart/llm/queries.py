"""Registered queries of the operators for training data, over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    decontaminate,
    html_text,
    importance,
    language_id,
    license_scan,
    prefix_trie,
    quality_rules,
    secret_scan,
    simhash,
    substring_dedup,
    suffix_dedup,
    url_filter,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_documents(spark, sf_dir), 13, with_text=False)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_documents(spark, sf_dir))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = secret_scan.scan(_documents(spark, sf_dir), by_part=True)

    def number(kind: str):
        return F.size(
            F.filter("secrets", lambda s: s["kind"] == secret_scan.KINDS.index(kind))
        ).cast("long")

    base = F.filter("secrets", lambda s: s["kind"] < secret_scan.KINDS.index("entropy"))
    return scanned.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(secret_scan.labels(base), 256).alias("base_sha256"),
        secret_scan.labels(F.col("secrets")).alias("spans"),
        number("entropy").alias("n_entropy"),
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = language_id.train(docs.where(~language_id.held_out()))
    return language_id.predict(docs, model).select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score"
    )


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir), shingle=4, radius=4)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "quality",
    )


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = _table(spark, sf_dir, "benchmark")
    return decontaminate.matches(_documents(spark, sf_dir), benchmark)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    done = bpe.decode(bpe.encode(_documents(spark, sf_dir), path), path)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_documents(spark, sf_dir), 400, with_text=False)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    model = importance.fit(docs, _table(spark, sf_dir, "benchmark"), max_n=1)
    drawn = importance.draw(importance.weigh(docs, model, keep=["doc_id"]))
    return drawn.select(
        "doc_id", "importance.n_features", "importance.weight", "score", "rank"
    )


#: Actions and rules of the registered query.
URL_RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    rules = url_filter.rules_table(spark, URL_RULES)
    return url_filter.judge(pages, rules).select(
        "page_id",
        "host",
        "path",
        "rule",
        "verdict",
        F.col("n_strict").cast("long").alias("n_strict"),
        F.col("n_soft").cast("long").alias("n_soft"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return prefix_trie.trie(prefix_trie.rebuilt(conversations, prefix_trie.crc_head(6)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_license_scan,
        op3_secret_scan,
        op4_language_id,
        op5_simhash_dedup,
        op6_quality_rules,
        op7_html_extraction,
        op8_decontamination,
        op9_bpe,
        op10_suffix_dedup,
        op11_importance_resampling,
        op12_url_filter,
        op13_prefix_trie,
    )
}


def _crc32(text: str) -> str:
    """SQL for the CRC-32 of the UTF-8 bytes of ``text``, with the table ``crc`` of 256 states."""
    spelled = f"hex(encode({text}))"
    return f"""xor(list_reduce(
        list_transform(range(0, octet_length(encode({text}))),
                       lambda i: ('0x' || substr({spelled}, 2 * i + 1, 2))::BIGINT),
        lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"""


_CRC_TABLE = """crc AS MATERIALIZED (
  SELECT list_transform(range(0, 256), lambda i: list_reduce(range(0, 8), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
)"""
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RUNS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

#: DuckDB SQL where it can express a query; the tests hold the others against brute force.
ORACLE_SQL = {
    "op1_substring_dedup": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS s, w FROM words
), keyed AS (
  SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS k FROM windows
), firsts AS (
  SELECT k, min(doc_id) AS least FROM keyed GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS i
  FROM keyed JOIN firsts USING (k) WHERE least < doc_id
), marks AS (
  SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id
), kept AS (
  SELECT doc_id, w, coalesce(gone, []) AS gone FROM words LEFT JOIN marks USING (doc_id)
), split AS (
  SELECT doc_id, len(w) AS n_words, len(gone) AS n_removed,
         CASE WHEN len(gone) = 0 THEN w
              ELSE list_transform(list_filter(range(1, len(w) + 1),
                     lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END AS kept
  FROM kept
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM split
""",
    "op11_importance_resampling": f"""
WITH {_CRC_TABLE}, docs AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, {_RUNS}) AS w FROM documents
), tokens AS (
  SELECT doc_id, unnest(w) AS word FROM docs
), wanted AS (
  SELECT unnest(regexp_extract_all({_LOWERED}, {_RUNS})) AS word FROM benchmark
), vocabulary AS (
  SELECT word, {_crc32("word")} % 10000 AS bucket
  FROM (SELECT word FROM tokens UNION SELECT word FROM wanted), crc
), s AS (
  SELECT bucket, count(*) AS n FROM tokens JOIN vocabulary USING (word) GROUP BY bucket
), t AS (
  SELECT bucket, count(*) AS n FROM wanted JOIN vocabulary USING (word) GROUP BY bucket
), gains AS (
  SELECT b AS bucket, CAST(floor(1000 * ln(
           (coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM tokens) + 10000)
           / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM wanted) + 10000))
         )) AS BIGINT) AS gain
  FROM range(0, 10000) AS r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b
), weights AS (
  SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight
  FROM tokens JOIN vocabulary USING (word) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE
         ))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (doc_id)
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r,
         10 * count(*) OVER () // 100 AS drawn
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= drawn THEN r END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
""",
    "op12_url_filter": r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), rules(host, path, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), terms(term, weight) AS (
  VALUES """ + ", ".join(f"('{t}', {w})" for t, w in sorted(url_filter.VOCABULARY.items())) + r"""
), urls AS (
  SELECT DISTINCT host, path, regexp_replace(translate(host || path,
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '%[0-9a-f]{2}', ' ', 'g') AS low
  FROM parts
), found AS (
  SELECT host, path, count(*) FILTER (weight >= 2) AS n_strict,
         count(*) FILTER (weight < 2) AS n_soft, sum(weight) AS weight
  FROM urls JOIN terms
    ON regexp_matches(low, '(^|[^a-z0-9\x{80}-\x{10FFFF}])' || term || '($|[^a-z0-9\x{80}-\x{10FFFF}])')
  GROUP BY host, path
), fitting AS (
  SELECT u.host, u.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
         arg_max(action, length(r.host || r.path)) AS action
  FROM urls u JOIN rules r
    ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY u.host, u.path
)
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN weight >= 2 THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(n_strict, 0) AS n_strict, coalesce(n_soft, 0) AS n_soft
FROM parts LEFT JOIN fitting USING (host, path) LEFT JOIN found USING (host, path)
""",
    "op13_prefix_trie": f"""
WITH {_CRC_TABLE}, own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                       ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (
  SELECT conv_id, turns, {_crc32("conv_id::VARCHAR")} % 6 AS h FROM own, crc
), convs AS (
  SELECT c.conv_id, list_concat(coalesce(hub.turns, [])[1:h], c.turns[h + 1:]) AS turns
  FROM heads c LEFT JOIN own hub ON hub.conv_id = c.conv_id - c.conv_id % 100
), steps AS (
  SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM convs
), keyed AS (
  SELECT conv_id, depth, len(turns) AS size, sha256(to_json(turns[1:depth])::VARCHAR) AS k,
         CASE WHEN depth > 0 THEN sha256(to_json(turns[1:depth - 1])::VARCHAR) END AS above,
         CASE WHEN depth > 0 THEN length(turns[depth].text) ELSE 0 END AS chars
  FROM steps
), nodes AS (
  SELECT k, any_value(above) AS above, any_value(depth) AS depth, any_value(chars) AS chars,
         min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS deepest,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                         FILTER (size = depth), '')) AS ends_sha256
  FROM keyed GROUP BY k
), families AS (
  SELECT above AS k, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above
), tops AS (
  SELECT DISTINCT t.k AS top, b.k
  FROM keyed t JOIN keyed b ON t.conv_id = b.conv_id AND t.depth <= b.depth
), sums AS (
  SELECT top AS k, count(*) FILTER (depth = deepest) AS n_leaves,
         CAST(sum((n_convs - 1) * chars) AS BIGINT) AS saved_tokens
  FROM tops JOIN nodes USING (k) GROUP BY top
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN sums USING (k) LEFT JOIN families USING (k) LEFT JOIN nodes p ON p.k = n.above
""",
}
