"""The registered queries of this subpackage and, where SQL can express them,
their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return register


@query("op2_token_orc")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from starledger.llm.tokenfiles import tokenize

    return tokenize(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


@query("op3_ring_shards")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starledger.llm.sharding import shard

    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "overflowed")


OP6_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('17|' || coalesce(doc_id::VARCHAR, 'null')) AS key FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
weighed AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS place FROM totals),
capped AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 2 AS cap,
         sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM weighed),
levels AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING
                AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW
                AND UNBOUNDED FOLLOWING) AS level FROM capped),
aims AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * max(level) OVER ()) AS target FROM levels),
parts AS (
  SELECT source, source_size, target,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM aims),
ranked AS (
  SELECT r.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
         coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.key, r.doc_id, r.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM rows r JOIN parts p ON r.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN before + size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM ranked
"""


@query("op6_water_mix", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starledger.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op10_minhash_oph")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starledger.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_decontaminate")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starledger.llm.decontaminate import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP7_SQL = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.v, r.v)::BIGINT AS score
  FROM rows q JOIN rows r ON r.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 10
"""


@query("op7_topk_search", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starledger.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starledger.llm.langid import fit, identify

    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))


@query("op8_quality_nbsvm")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starledger.llm.quality import THRESHOLD, fit, held_out, scorer

    docs = table(spark, sf_dir, "documents")
    score = scorer(fit(docs, table(spark, sf_dir, "labels")))
    return (docs.select("doc_id", held_out("doc_id").alias("held_out"), score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


# documents have no paths: id blocks of a source stand for its directories, and
# the first document of a block for the directory's licence file
OP1_FILES = """
  SELECT doc_id, text, CASE
    WHEN doc_id IS NULL THEN concat(coalesce(source, 'none'), '/unnamed.txt')
    WHEN k % 100 = 0 THEN concat(coalesce(source, 'none'), '/g', k100, '/LICENSE-', doc_id)
    WHEN k % 10 = 0 THEN concat(coalesce(source, 'none'), '/g', k100, '/h', k10, '/LICENSE-', doc_id)
    ELSE concat(coalesce(source, 'none'), '/g', k100, '/h', k10, '/f', doc_id, '.txt') END AS path
  FROM (SELECT doc_id, text, source, CAST(floor(doc_id / 20) AS BIGINT) AS k,
               CAST(floor(doc_id / 200) AS BIGINT) AS k10, CAST(floor(doc_id / 2000) AS BIGINT) AS k100 FROM documents)
"""


def _op1_sql() -> str:
    from starledger.llm.licences import LEAST, TEMPLATES, TERM

    values = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(TEMPLATES))
    return rf"""
WITH files AS ({OP1_FILES}),
templates(template, license, text) AS (VALUES {values}),
tterms AS (SELECT template, license, unnest(regexp_extract_all(lower(text), '{TERM}')) AS term FROM templates),
ttf AS (SELECT template, license, term, count(*) AS tf FROM tterms GROUP BY ALL),
n AS (SELECT count(*) AS files FROM files),
df AS (SELECT term, count(DISTINCT path) AS holding
       FROM (SELECT path, unnest(regexp_extract_all(lower(text), '{TERM}')) AS term FROM files) GROUP BY term),
vocabulary AS (
  SELECT v.term, floor(1000 * (ln((1 + files)::DOUBLE / (1 + coalesce(holding, 0))) + 1) + 0.5)::BIGINT AS weight
  FROM (SELECT DISTINCT term FROM ttf) v LEFT JOIN df USING (term), n),
tvec AS (SELECT template, license, term, tf * weight AS part FROM ttf JOIN vocabulary USING (term)),
tsquare AS (SELECT template, sum(part * part)::BIGINT AS square FROM tvec GROUP BY template),
pieces AS (SELECT DISTINCT path, text FROM files WHERE text IS NOT NULL),
-- templates of whose norm a text covers enough for any of its windows
ptemplates AS (
  SELECT path, text, template FROM (
    SELECT DISTINCT path, text, unnest(regexp_extract_all(lower(text), '{TERM}')) AS term FROM pieces)
  JOIN tvec USING (term) JOIN tsquare USING (template)
  GROUP BY path, text, template, square HAVING sum(part * part) >= 0.99 * {LEAST} * {LEAST} * square),
tlist AS (SELECT template, list(term) AS held, sum(tf) AS n FROM ttf GROUP BY template),
split AS (SELECT path, text, string_split(text, chr(10)) AS ls FROM pieces SEMI JOIN ptemplates USING (path, text)),
rawlines AS (SELECT path, text, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM split),
lines AS (
  SELECT *, sum(size) OVER (PARTITION BY path, text ORDER BY pos) - size AS at
  FROM (SELECT *, regexp_extract_all(lower(line), '{TERM}') AS lterms, len(lterms) AS size FROM rawlines) WHERE size > 0),
windows AS (
  SELECT s.path, p.template, string_agg(l.line, ' ' ORDER BY l.at) AS until,
         string_agg(l.line, ' ' ORDER BY l.at) FILTER (l.at + l.size <= s.at + n OR l.at = s.at) AS within
  FROM lines s JOIN ptemplates p USING (path, text) JOIN tlist t ON t.template = p.template AND list_has_any(s.lterms, held)
  JOIN lines l ON l.path = s.path AND l.text = s.text AND l.at >= s.at AND l.at < s.at + n
  GROUP BY s.path, s.text, p.template, s.at),
units AS (
  SELECT DISTINCT path, -1 AS "of", unnest(string_split(text, chr(10))) AS notice FROM files
  UNION SELECT path, -1, text FROM files WHERE text IS NOT NULL
    AND regexp_matches(path, '(?i)(^|/)(licen[cs]e|copying|unlicense|notice)([-._][^/]*)?$')
  UNION SELECT path, template, until FROM windows UNION SELECT path, template, within FROM windows),
utf AS (SELECT path, "of", notice, term, count(*) AS tf FROM (
          SELECT path, "of", notice, unnest(regexp_extract_all(lower(notice), '{TERM}')) AS term FROM units) GROUP BY ALL),
uvec AS (
  SELECT path, "of", notice, term,
         tf * coalesce(weight, floor(1000 * (ln((1 + files)::DOUBLE) + 1) + 0.5)::BIGINT) AS w
  FROM utf LEFT JOIN vocabulary USING (term), n),
usquare AS (SELECT path, "of", notice, sum(w * w)::BIGINT AS square FROM uvec GROUP BY ALL),
scored AS (
  SELECT path, license, dot::DOUBLE / (sqrt(u.square::DOUBLE) * sqrt(t.square::DOUBLE)) AS score
  FROM (SELECT path, "of", notice, template, license, sum(w * part)::BIGINT AS dot FROM uvec JOIN tvec USING (term)
        WHERE "of" IN (-1, template) GROUP BY ALL)
  JOIN usquare u USING (path, "of", notice) JOIN tsquare t USING (template)),
own AS (SELECT path, license AS own_license, score AS own_score FROM scored WHERE score >= {LEAST}
        QUALIFY row_number() OVER (PARTITION BY path ORDER BY score DESC, license) = 1),
placed AS (SELECT path, CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') ELSE '' END AS dir
           FROM (SELECT DISTINCT path FROM files)),
given AS (
  SELECT dir AS licensed_by, own_license AS dir_license FROM own JOIN placed USING (path)
  WHERE regexp_matches(path, '(?i)(^|/)(licen[cs]e|copying|unlicense|notice)([-._][^/]*)?$')
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY own_score DESC, own_license) = 1),
nearest AS (
  SELECT dir, licensed_by, dir_license,
         (CASE WHEN dir = '' THEN 0 ELSE len(string_split(dir, '/')) END
          - CASE WHEN licensed_by = '' THEN 0 ELSE len(string_split(licensed_by, '/')) END)::INTEGER AS up
  FROM (SELECT DISTINCT dir FROM placed) JOIN given
    ON licensed_by = '' OR dir = licensed_by OR starts_with(dir, licensed_by || '/')
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY len(licensed_by) DESC) = 1)
SELECT f.doc_id, path, own_license, own_score, coalesce(own_license, dir_license) AS license,
       CASE WHEN own_license IS NULL THEN licensed_by END AS licensed_by,
       CASE WHEN own_license IS NULL THEN up END AS levels_up
FROM files f JOIN placed p USING (path) LEFT JOIN own USING (path) LEFT JOIN nearest n ON n.dir = p.dir
"""


@query("op1_license_scan", _op1_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starledger.llm.licences import scan

    files = spark.sql(OP1_FILES.replace("FROM documents", "FROM {documents}"), documents=table(spark, sf_dir, "documents"))
    # the file table is one row per document, so paths go back to ids by a join
    return files.select("doc_id", "path").join(scan(files), "path")


@query("op4_suffix_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starledger.llm.passages import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


@query("op11_pointer_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from starledger.llm.crosstok import alignment

    return alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                     public_tokenizers.path("piece_bpe_32k.model"))


@query("op12_cut_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from starledger.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).boundaries()


@query("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starledger.llm.conversations import digests

    return digests(table(spark, sf_dir, "conversations"))
