"""The registered queries opN_<name> (and the pipeline) with their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql.strip()
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from marketframe.llm.components import small_batches

    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op5_benchmark_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketframe.llm.decontaminate import verdicts

    return verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketframe.llm.langid import held_out, predict, sample

    docs = table(spark, sf_dir, "documents")
    texts = sample(docs.where(~held_out() & docs.doc_id.isNotNull()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), texts, drop_text=True).select("doc_id", "held_out", "lang_pred", "score")


@query("op9_pii")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketframe.llm.pii import find

    return find(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii.*")


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS key
  FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, 2 * source_size AS cap FROM t),
l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
      - CAST(coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
      / CAST(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM w),
x AS (SELECT level AS x FROM l WHERE level * w <= cap ORDER BY cap / w, source NULLS LAST LIMIT 1),
g AS (
  SELECT source, source_size,
         CASE WHEN (SELECT x FROM x) IS NULL OR (SELECT x FROM x) * w >= cap THEN CAST(cap AS DOUBLE) ELSE (SELECT x FROM x) * w END AS target
  FROM w),
q AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN target > 0 THEN CAST(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) / target - size / (target * 2) END AS mid
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, round(target, 6) + 0.0 AS target,
       CAST(size * (CASE WHEN mid <= 1 THEN 1 ELSE 0 END + CASE WHEN mid + source_size / target <= 1 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM q
"""


@query("op6_source_mix", MIX_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from marketframe.llm.mix import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


LINE_SQL = r"""
WITH p AS (SELECT row_number() OVER () AS r, * FROM documents),
s AS (SELECT r, source, unnest(string_split(text, chr(10))) AS raw, unnest(range(len(string_split(text, chr(10))))) AS i FROM p),
l AS (SELECT *, trim(raw, ' ' || chr(9) || chr(13)) AS line FROM s),
c AS (SELECT source, line, count(DISTINCT r) AS n FROM l WHERE line <> '' GROUP BY ALL),
t AS (SELECT source, count(*) AS total FROM p GROUP BY source),
b AS (SELECT c.source, line FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source WHERE n >= 5 AND n > total * 0.05),
k AS (
  SELECT r, count(*) AS n_lines, count(b.line) AS n_removed, string_agg(CASE WHEN b.line IS NULL THEN raw END, chr(10) ORDER BY i) AS text
  FROM l LEFT JOIN b ON l.line = b.line AND l.source IS NOT DISTINCT FROM b.source GROUP BY r)
SELECT doc_id, p.source, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CASE WHEN p.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM p LEFT JOIN k USING (r)
"""


@query("op1_line_dedup", LINE_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketframe.llm.lines import line_dedup

    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "source", "n_lines", "n_removed", "text")


@query("op4_html_extraction")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from marketframe.llm.extract import extract

    pages = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS d, max(page_id) OVER (PARTITION BY html) AS top FROM p),
b AS (
  SELECT page_id, n, top, d, list_transform(range(160 // 5), lambda i: i * 5) AS starts,
         array_to_string(list_transform(string_split_regex(d, ''), lambda c: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (instr('0123456789abcdef', c) - 1) + 1, 4)), '') AS bits
  FROM h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(starts, lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * CAST(substr(bits, i + 1, 1) AS INT) + 8 * CAST(substr(bits, i + 2, 1) AS INT) + 4 * CAST(substr(bits, i + 3, 1) AS INT) + 2 * CAST(substr(bits, i + 4, 1) AS INT) + CAST(substr(bits, i + 5, 1) AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM b
"""


@query("op8_warc", WARC_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketframe.llm.warc import merge_index, read_archives, write_archives
    from marketframe.session import scratch_dir

    path = scratch_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return merge_index(read_archives(spark, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_nearest_neighbours")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from marketframe.llm.ann import neighbours

    return neighbours(table(spark, sf_dir, "embeddings"), F.pmod(F.col("id"), F.lit(20)) == 0)


@query("op3_ngram_jaccard_join")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketframe.llm.jaccard import jaccard_groups

    return jaccard_groups(table(spark, sf_dir, "documents"))


@query("op2_substring_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from marketframe.llm.substrings import substring_dedup

    return substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


MANIFEST_SQL = r"""
WITH RECURSIVE
k AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS crc),
f AS (
  SELECT doc_id, lang, list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text], lambda v: coalesce(octet_length(encode(v)) || ':' || v, '-')) AS v,
         coalesce(octet_length(encode(text)) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS folded,
         xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)),
             lambda c, d: xor(c // 256, crc[CAST(xor(c % 256, d) AS INT) + 1]), 4294967295), 4294967295) % 3 = 0 AS changed
  FROM documents CROSS JOIN k),
d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256(array_to_string(v, '')) AS leaf,
         sha256(array_to_string(CASE WHEN changed THEN list_append(v[:4], folded) ELSE v END, '')) AS held
  FROM f),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, held) - 1 AS pos FROM d),
sub AS (
  SELECT 0 AS level, tree, pos, leaf AS node, count(*) OVER (PARTITION BY tree) AS n FROM l
  UNION ALL
  SELECT level + 1, tree, pos, sha256(run), CAST((n + 7) // 8 AS BIGINT)
  FROM (SELECT level, tree, pos // 8 AS pos, string_agg(node, '' ORDER BY pos) AS run, max(n) AS n FROM sub WHERE n > 1 GROUP BY level, tree, sub.pos // 8)),
ends AS (SELECT tree, level AS h, node, row_number() OVER (ORDER BY tree) - 1 AS pos FROM sub WHERE n = 1),
top AS (
  SELECT 0 AS level, pos, node, count(*) OVER () AS n FROM ends
  UNION ALL
  SELECT level + 1, pos, sha256(run), CAST((n + 7) // 8 AS BIGINT)
  FROM (SELECT level, pos // 8 AS pos, string_agg(node, '' ORDER BY pos) AS run, max(n) AS n FROM top WHERE n > 1 GROUP BY level, top.pos // 8)),
runs AS (
  SELECT tree, level, pos // 8 AS run, list(node ORDER BY pos) AS nodes FROM sub WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT '*', level, pos // 8, list(node ORDER BY pos) FROM top WHERE n > 1 GROUP BY ALL),
walk AS (
  SELECT doc_id, l.tree, leaf, held, l.pos, 0 AS level, l.pos AS place, l.tree AS within, ends.h, ends.pos AS top_at, ends.node AS subroot, held AS node, '' AS proof
  FROM l JOIN ends USING (tree)
  UNION ALL
  SELECT doc_id, w.tree, leaf, held, pos, CASE WHEN stop THEN 0 ELSE w.level + 1 END, CASE WHEN stop THEN top_at ELSE place // 8 END,
         CASE WHEN stop THEN '*' ELSE within END, h, top_at, subroot,
         CASE WHEN stop THEN node ELSE sha256(array_to_string(nodes[:place % 8], '') || node || array_to_string(nodes[place % 8 + 2:], '')) END,
         CASE WHEN stop THEN proof ELSE proof || array_to_string(nodes[:place % 8], '') || array_to_string(nodes[place % 8 + 2:], '') END
  FROM (SELECT *, within <> '*' AND level = h AS stop FROM walk) w LEFT JOIN runs r ON NOT stop AND r.tree = within AND r.level = w.level AND r.run = place // 8
  WHERE stop OR nodes IS NOT NULL),
last AS (SELECT * FROM walk WHERE within = '*' AND level = (SELECT max(level) FROM top))
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM last CROSS JOIN (SELECT node AS root FROM top WHERE n = 1)
"""


@query("op12_merkle_manifest", MANIFEST_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from marketframe.llm import manifest

    docs = table(spark, sf_dir, "documents")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lower).otherwise(F.col("text"))
    held = manifest.leaf_digest([text if c == "text" else F.col(c) for c in manifest.FIELDS])
    made = manifest.build(docs, carry={"held": held})
    root, fold = F.lit(made.root), manifest.folded(F.col("held"), F.col("proof"))
    out = manifest.proofs(made).select(F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", root.alias("root"), F.sha2(manifest.siblings(F.col("proof")), 256).alias("proof_sha256"), fold.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op13_quality_classifier")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from marketframe.llm import quality

    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = quality.fit(quality.labelled(docs.select("doc_id", "text"), labels.where(~held_out)))
    out = quality.classify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


SEARCH_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_words FROM d WHERE len(w) > 0),
i AS (
  SELECT item_id, row_number() OVER () AS k, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark),
q AS (SELECT item_id, k, t, count(*) AS c FROM (SELECT item_id, k, unnest(w) AS t FROM i) GROUP BY ALL),
p AS (SELECT r, doc_id, n, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS t FROM d) GROUP BY ALL),
f AS (SELECT t, CAST(count(*) AS BIGINT) AS df FROM p GROUP BY t),
x AS (
  SELECT t, r, doc_id, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_words))) AS gain
  FROM p JOIN f USING (t) CROSS JOIN s),
z AS (SELECT item_id, k, doc_id, r, CAST(sum(c * gain) AS BIGINT) AS score FROM q JOIN x USING (t) GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM z WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 10
"""


@query("op11_ranked_search", SEARCH_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketframe.llm.search import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
