"""Registered queries of the training-data operators, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.llm.exact_dedup import exact_groups
from tokenmill.llm.host_rules import judge
from tokenmill.llm.html_text import extract
from tokenmill.llm.language_crf import identify
from tokenmill.llm.lexical_search import search
from tokenmill.llm.merkle_manifest import prove
from tokenmill.llm.ngram_jaccard import jaccard_components
from tokenmill.llm.piece_codec import code
from tokenmill.llm.secret_scan import scan
from tokenmill.llm.source_mix import mix
from tokenmill.llm.substring_dedup import dedup_substrings
from tokenmill.llm.token_counts import count_redacted
from tokenmill.llm.topk_search import top_k

#: Folder with the vocabulary files of public tokenizers.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pre-token pattern that belongs to the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD = r"[^\x20\x09-\x0D]+"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(_documents(spark, sf_dir)).drop("kept_text")


OP1_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d),
windows AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h FROM starts),
least AS (SELECT h, min(doc_id) AS m FROM windows GROUP BY h),
hits AS (SELECT doc_id, i FROM windows JOIN least USING (h) WHERE doc_id > m),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM hits),
words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS w FROM d),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_documents(spark, sf_dir))


OP2_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW best AS (PARTITION BY norm ORDER BY n DESC, doc_id)
"""

def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_documents(spark, sf_dir)).drop("ord", "th")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet"))


def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_documents(spark, sf_dir))


OP5_SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d),
grams AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 7], ' ')) AS n FROM starts),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM grams WHERE n > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d),
worded AS (SELECT doc_id, count(*) AS n, count(DISTINCT l) AS k FROM lines WHERE regexp_matches(l, '{WORD}') GROUP BY doc_id),
m AS (SELECT doc_id, source, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
      length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(w.n - w.k, 0)::BIGINT AS n_dup_lines,
      coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(w.n, 0) AS n_lines
      FROM d LEFT JOIN rep r USING (doc_id) LEFT JOIN worded w USING (doc_id)),
f AS (SELECT *, n_words < 20 AS short, 100 * n_repeat_words > 30 * n_words AS repeated, n_symbols > n_words AS symbols, 2 * n_dup_lines > n_lines AS lines FROM m),
long AS (UNPIVOT (SELECT source, count(*)::DOUBLE AS n, sum(short::INT)::DOUBLE AS short, sum(repeated::INT)::DOUBLE AS repeated,
         sum(symbols::INT)::DOUBLE AS symbols, sum(lines::INT)::DOUBLE AS lines FROM f WHERE source IS NOT NULL GROUP BY source)
         ON short, repeated, symbols, lines INTO NAME rule VALUE k),
means AS (SELECT rule, sum(k) / sum(n) AS mean FROM long GROUP BY rule),
spreads AS (SELECT rule, mean, sum(n * (k / n - mean) * (k / n - mean)) / sum(n) - mean * (1 - mean) * count(*) / sum(n) AS spread
            FROM long JOIN means USING (rule) GROUP BY rule, mean),
priors AS (SELECT rule, mean, CASE WHEN spread > 0 THEN greatest(2.0, least(1000.0, mean * (1 - mean) / spread - 1)) ELSE 1000.0 END AS weight FROM spreads),
hosts AS (SELECT source, bool_or((k + mean * weight) / (n + weight) > 0.5) AS rejected FROM long JOIN priors USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeated AS base_failed,
       NOT (short OR repeated) AND NOT coalesce(rejected, false) AS kept
FROM f LEFT JOIN hosts USING (source)
"""


def op6_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_documents(spark, sf_dir)).drop("key")


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


OP7_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b USING (s) JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
          WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.c AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_redacted(_documents(spark, sf_dir), f"{TOKENIZERS}/byte_bpe_50k.tiktoken", PATTERN)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(_documents(spark, sf_dir), f"{TOKENIZERS}/byte_bpe_50k.tiktoken", PATTERN)


def op10_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = code(_documents(spark, sf_dir), f"{TOKENIZERS}/piece_bpe_32k.model")
    return coded.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prove(_documents(spark, sf_dir))


def _merkle_sql(levels: int = 7, top_levels: int = 7) -> str:
    """Level by level; enough for 8 ** levels leaves in a language and as
    many languages. CRC-32 is a fold over the bits of the decimal id."""
    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
    digest = "sha256(" + " || ".join(["{0}" if c == "text" else field(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = """xor(4294967295, list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''),
             lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
             lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""
    ctes = [f"""leaves AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos FROM (
            SELECT doc_id, coalesce('=' || lang, '') AS t, {digest.format(field('text'))} AS leaf,
            CASE WHEN {crc} % 3 = 0 THEN {digest.format(field(lower))} END AS changed FROM documents))""",
            "n0 AS (SELECT t, pos, leaf AS node FROM leaves)", "f0 AS (SELECT doc_id, leaf, t, pos, coalesce(changed, leaf) AS node, '' AS proof FROM leaves)"]

    def climb(n: str, f: str, count: int) -> tuple[str, str]:
        for i in range(count):
            ctes.append(f"""{n}{i + 1} AS (SELECT t, pos // 8 AS pos, any_value(c) AS c, list(node ORDER BY pos) AS run,
                CASE WHEN any_value(c) = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node
                FROM (SELECT t, pos, node, count(*) OVER (PARTITION BY t) AS c FROM {n}{i}) GROUP BY t, pos // 8)""")
            ctes.append(f"""{f}{i + 1} AS (SELECT * EXCLUDE (others, near, far, old, c), CASE WHEN c = 1 THEN old ELSE sha256(near || old || far) END AS node,
                CASE WHEN c = 1 THEN others ELSE others || near || far END AS proof FROM (
                SELECT f.* EXCLUDE (pos, node, proof), f.pos // 8 AS pos, f.node AS old, f.proof AS others, n.c,
                array_to_string(n.run[1:f.pos % 8], '') AS near, array_to_string(n.run[f.pos % 8 + 2:], '') AS far
                FROM {f}{i} f JOIN {n}{i + 1} n ON n.t = f.t AND n.pos = f.pos // 8))""")
        return f"{n}{count}", f"{f}{count}"
    n, f = climb("n", "f", levels)
    ctes += [f"m0 AS (SELECT 0 AS t, t AS lang, node, row_number() OVER (ORDER BY t) - 1 AS pos FROM {n})",
             f"g0 AS (SELECT f.doc_id, f.leaf, f.node, f.proof, m0.node AS subroot, m0.pos, 0 AS t FROM {f} f JOIN m0 ON m0.lang = f.t)"]
    m, g = climb("m", "g", top_levels)
    return f"""WITH {', '.join(ctes)} SELECT g.doc_id, g.leaf, g.subroot, m.node AS root, sha256(g.proof) AS proof_sha256,
        g.node AS folded_root, g.node = m.node AS verified FROM {g} g, {m} m"""


OP11_SQL = _merkle_sql()


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    return top_k(vectors, 5, F.col("vec_id") % 50 == 0)


OP12_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r)
SELECT query_id, (row_number() OVER best)::INT AS rank, vec_id, score FROM s
WINDOW best AS (PARTITION BY r ORDER BY score DESC, vec_id) QUALIFY rank <= 5
"""


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


TERM_SQL = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TERM_SQL.format('text')} AS ts FROM documents),
total AS (SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS n_all FROM d WHERE len(ts) > 0),
hits AS (SELECT r, doc_id, any_value(len(ts)) AS n, term, count(*) AS tf FROM (SELECT *, unnest(ts) AS term FROM d) GROUP BY r, doc_id, term),
items AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({TERM_SQL.format('text')}) AS term FROM benchmark) GROUP BY item_id, term),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM hits GROUP BY term), total),
parts AS (SELECT i.item_id, h.r, h.doc_id, i.times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + 25 * n * n_docs // n_all))) AS s
          FROM items i JOIN hits h USING (term) JOIN weights USING (term), total),
scores AS (SELECT item_id, r, doc_id, sum(s)::BIGINT AS score FROM parts GROUP BY item_id, r, doc_id HAVING sum(s) > 0)
SELECT item_id, (row_number() OVER best)::INT AS rank, doc_id, score FROM scores
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY rank <= 20
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_source_mix": op3_source_mix,
    "op4_html_text": op4_html_text,
    "op5_host_rules": op5_host_rules,
    "op6_language_crf": op6_language_crf,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_token_counts": op8_token_counts,
    "op9_secret_scan": op9_secret_scan,
    "op10_piece_codec": op10_piece_codec,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_topk_search": op12_topk_search,
    "op13_lexical_search": op13_lexical_search,
}
ORACLES: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op2_exact_dedup": OP2_SQL,
    "op5_host_rules": OP5_SQL,
    "op7_ngram_jaccard": OP7_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op12_topk_search": OP12_SQL,
    "op13_lexical_search": OP13_SQL,
}
