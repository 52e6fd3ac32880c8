"""One query per operator, over whole tables, with production parameters; the
operators keep their own interfaces, the queries derive the digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import (decontaminate, exact_dedup, line_dedup, merkle, minhash, mixing, pii, quality, quality_rules,
                         sampling, token_alignment, token_codes, toxicity, url_filter)

#: Fixed values of the URL query: (verdict, host, path).
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: The near-duplicate query's contract sets its own shingle length.
NEAR_SHINGLE = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def q_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix's words per document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def q_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark overlap per document."""
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def q_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written as directly addressable codes and read back."""
    return token_codes.token_codes(table(spark, sf_dir, "documents"), tokenizer_path())


def q_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict per page."""
    rules = spark.createDataFrame(list(URL_RULES), "verdict string, host string, path string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def q_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component per document."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=NEAR_SHINGLE).select(
        "doc_id", "n_shingles", "component_id", "kept")


def q_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without cross-site boilerplate lines."""
    out = line_dedup.remove_spread_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def q_long_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``q_line_dedup``, and long lines go from ``LONG_SITES`` sites on."""
    out = line_dedup.remove_spread_lines(table(spark, sf_dir, "documents"), long_words=line_dedup.LONG_WORDS)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score per document."""
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts per document."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score per document."""
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data per document."""
    return pii.find_personal_data(table(spark, sf_dir, "documents")).drop("n_more")


def q_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict per document."""
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", *quality_rules.BASE, "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


def q_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof and check per document; where 7 divides the id's CRC-32, of a row whose n_chars grew by 1."""
    found = merkle.manifest(table(spark, sf_dir, "documents"), changed={"n_chars": F.col("n_chars") + 1},
                            changes=sampling.remainder(F.col("doc_id"), 7) == 0)
    return merkle.verify(found).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def q_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers per document."""
    return token_alignment.align(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {
    "op1_source_mixing": q_mixing,
    "op2_benchmark_decontamination": q_decontamination,
    "op3_token_codes": q_token_codes,
    "op4_url_filter": q_url_filter,
    "op5_minhash_near_dedup": q_near_dedup,
    "op6_line_dedup": q_line_dedup,
    "op6_long_line_dedup": q_long_line_dedup,
    "op7_quality_classifier": q_quality,
    "op8_exact_dedup": q_exact_dedup,
    "op9_toxicity": q_toxicity,
    "op10_pii": q_pii,
    "op11_quality_rules": q_quality_rules,
    "op12_merkle_manifest": q_merkle,
    "op13_token_alignment": q_token_alignment,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE = {
    "op1_source_mixing": r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         coalesce(greatest(0.25, 1 - 4 * (1 - length(translate(text, '#$%&*|<>{}[]=+_~^\/@!', ''))
                                              / CAST(greatest(length(text), 1) AS DOUBLE))), 0.25) AS w,
         (CAST(CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
           / 4503599627370496.0 AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (
  SELECT source, source_size, 3.0 * CAST(source_size AS DOUBLE) AS cap,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3
              WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM s),
l AS (
  SELECT *, cap / weight AS ratio,
         (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER before, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM r WINDOW before AS (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT min_by(level, (ratio, source)) AS level FROM l WHERE level <= ratio),
t AS (SELECT source, source_size, coalesce(least(cap, f.level * weight), cap) AS target FROM l LEFT JOIN f ON true),
b AS (
  SELECT source, source_size, target, CAST(round(target) AS BIGINT) AS budget,
         CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t),
o AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY -ln(u) / w, d.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + CASE WHEN rest > seen AND 2 * (rest - seen) >= size THEN size ELSE 0 END AS BIGINT) AS taken FROM o""",
    "op2_benchmark_decontamination": rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
w AS (
  SELECT DISTINCT item, least(len(ws), 13) AS n, array_to_string(ws[k:k + least(len(ws), 13) - 1], ' ') AS win
  FROM (SELECT item, ws, unnest(generate_series(1, len(ws) - least(len(ws), 13) + 1)) AS k FROM i WHERE len(ws) > 0)),
p AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws))) AS k FROM d WHERE len(ws) > 0),
h AS (
  SELECT p.doc_id, p.k, w.n, w.item
  FROM p JOIN (SELECT DISTINCT n FROM w) sizes ON p.k + sizes.n - 1 <= len(p.ws)
  JOIN w ON w.n = sizes.n AND w.win = array_to_string(p.ws[p.k:p.k + sizes.n - 1], ' ')),
c AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit, count(DISTINCT item) AS n_items,
         string_agg(DISTINCT item, ',' ORDER BY item) AS items
  FROM (SELECT doc_id, item, unnest(generate_series(k, k + n - 1)) AS pos FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id""",
    "op4_url_filter": rf"""
WITH r(verdict, host, path) AS (VALUES {", ".join(str(x) for x in URL_RULES)}),
u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                            '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
m AS (
  SELECT u.page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
         max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM u JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY u.page_id)
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM u LEFT JOIN m ON u.page_id = m.page_id""",
    "op6_line_dedup": r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, text IS NULL AS gone FROM documents),
l AS (
  SELECT doc_id, source, generate_subscripts(parts, 1) AS k, unnest(parts) AS line, gone
  FROM (SELECT *, string_split(text, chr(10)) AS parts FROM d)),
b AS (
  SELECT trim(line, ' ') AS line FROM l WHERE trim(line, ' ') <> '' AND NOT gone
  GROUP BY 1 HAVING count(DISTINCT coalesce('s' || source, '')) >= 10),
k AS (SELECT l.*, b.line IS NOT NULL AS out FROM l LEFT JOIN b ON trim(l.line, ' ') = b.line)
SELECT doc_id, CASE WHEN any_value(gone) THEN 0 ELSE count(*) END AS n_lines,
       CAST(count(*) FILTER (out) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT out), '')) AS text_sha256
FROM k GROUP BY doc_id""",
    "op8_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op12_merkle_manifest": """
WITH RECURSIVE e AS (
  SELECT doc_id, n_chars, coalesce('=' || lang, '') AS grp,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                                                        lambda c: CAST(ascii(c) AS BIGINT))),
             lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
               lambda r, z: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)), 4294967295) AS crc
  FROM documents),
f AS (
  SELECT doc_id, grp, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(head || coalesce(strlen(CAST(n_chars + CASE WHEN crc % 7 = 0 THEN 1 ELSE 0 END AS VARCHAR)) || ':'
                                 || (n_chars + CASE WHEN crc % 7 = 0 THEN 1 ELSE 0 END), '-') || tail) AS changed FROM e),
l AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id ASC NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY grp) AS n FROM f),
t(grp, lvl, pos, h, n) AS (
  SELECT grp, 0, pos, leaf, n FROM l
  UNION ALL
  SELECT grp, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 1) // 2
  FROM t WHERE n > 1 GROUP BY grp, lvl, pos // 2),
s AS (SELECT grp, h AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u(lvl, pos, h, n) AS (
  SELECT 0, pos, subroot, n FROM s
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 1) // 2 FROM u WHERE n > 1 GROUP BY lvl, pos // 2),
steps AS (
  SELECT l.grp, l.pos, g.lvl, t.h, t.pos < l.pos >> g.lvl AS before
  FROM l JOIN (SELECT DISTINCT grp, lvl FROM t WHERE n > 1) g ON l.grp = g.grp
  LEFT JOIN t ON t.grp = l.grp AND t.lvl = g.lvl AND t.pos = xor(l.pos >> g.lvl, 1)
  UNION ALL
  SELECT l.grp, l.pos, 1000 + g.lvl, u.h, u.pos < s.pos >> g.lvl
  FROM l JOIN s ON l.grp = s.grp CROSS JOIN (SELECT DISTINCT lvl FROM u WHERE n > 1) g
  LEFT JOIN u ON u.lvl = g.lvl AND u.pos = xor(s.pos >> g.lvl, 1)),
p AS (
  SELECT grp, pos, coalesce(string_agg(h, '' ORDER BY lvl), '') AS proof,
         list(CASE WHEN h IS NULL THEN 'N' WHEN before THEN 'L' || h ELSE 'R' || h END ORDER BY lvl) AS path
  FROM steps GROUP BY grp, pos),
o AS (
  SELECT l.doc_id, l.leaf, s.subroot, r.h AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
         list_reduce(list_prepend(l.changed, coalesce(p.path, [])), lambda a, b: sha256(
           CASE b[1] WHEN 'L' THEN b[2:] || a WHEN 'R' THEN a || b[2:] ELSE a END)) AS folded_root
  FROM l JOIN s ON l.grp = s.grp LEFT JOIN p ON l.grp = p.grp AND l.pos = p.pos JOIN (SELECT h FROM u WHERE n = 1) r ON true)
SELECT *, folded_root = root AS verified FROM o""",
}
