"""The registered queries of this package: thin, each applies one operator
with production parameters to its whole table, and its DuckDB SQL where SQL
can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, scratch_path
from ..sources.tables import read_table
from . import bpe, decontaminate, importance, langid, license_scan, minhash, neighbours, packing, phrases, repeats, token_files, url_rules, warc

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


# Rows of an Arrow batch: whole texts are long, so the default of 10,000 would be tens of megabytes.
BATCH_ROWS = 1000


def prepared(spark: SparkSession) -> SparkSession:
    """The session with what the operators rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return configure(spark)


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepared(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_token_files")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "token-files")
    shards = token_files.write_token_files(read_table(spark, sf_dir, "documents"), out, tokenizer_path())
    return token_files.read_token_files(shards).select("doc_id", "start", "n_tokens", "ids_crc32")


URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

URL_SQL = """
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(v, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                          ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (
  SELECT page_id, host, path, (
    SELECT max(struct_pack(n := length(h) + length(p), hn := length(h), r := h || p, v := v)) FROM rules
    WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best FROM parts)
SELECT page_id, host, path, best.r AS "rule", coalesce(best.v, CASE WHEN host = '' THEN 'block' ELSE 'allow' END) AS verdict FROM fit
"""


@query("op9_url_rules", URL_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"), url_rules.rules_table(spark, URL_RULES))
    default = F.when(F.col("host") == "", url_rules.BLOCK).otherwise(url_rules.ALLOW)
    return judged.select("page_id", "host", "path", "rule", F.coalesce("verdict", default).alias("verdict"))


WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT payload_digest, max(page_id) AS kept FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < kept THEN 'revisit' ELSE 'response' END AS record_type,
       CAST(CASE WHEN page_id < kept THEN kept END AS BIGINT) AS refers_to
FROM p LEFT JOIN k USING (payload_digest)
"""


@query("op5_warc", WARC_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_warc(read_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return (warc.read_warc(files, with_payload=False)
            .select("page_id", "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), "refers_to"))


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5 = 0; null for a null doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def language_model(docs: DataFrame) -> langid.Model:
    """Learned from the text and language of documents that aren't held out."""
    return langid.train(docs.filter(~held_out(F.col("doc_id"))).select("text", "lang", F.col("doc_id").alias("key")))


@query("op7_language")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), language_model(docs))
    return found.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op2_licenses", license_scan.duckdb_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query("op8_near_duplicates")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query("op10_repeated_passages")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.explode("removed").alias("span")).select("doc_id", "span.*")


@query("op4_contamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", "item_id", "start_word", "n_words", "similarity")


@query("op3_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(read_table(spark, sf_dir, "documents"), tokenizer_path()))


@query("op6_neighbours")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 20 = 0"))


@query("op11_importance")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_bpe")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = read_table(spark, sf_dir, "documents").select("doc_id", bpe.encoded(F.col("text"), tokenizer_path()).alias("ids"))
    both = ids.select("doc_id", "ids", bpe.decoded(F.col("ids"), tokenizer_path()).alias("decoded"))
    decimals = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(decimals.cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


PHRASES_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \x09]+'), lambda x: x <> '') AS ws FROM p),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) v(k) WHERE len(ws) >= k),
f AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, phrase, f AS a, k, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cut AS (SELECT lang, phrase, a, ws, k, unnest(range(1, k)) AS cut_at FROM c),
scored AS (
  SELECT cut.lang, cut.phrase, a, cut_at, l.f AS l, r.f AS r, CAST((CAST(2000000 AS HUGEINT) * a) // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = array_to_string(ws[1:cut_at], ' ')
           JOIN f r ON r.lang = cut.lang AND r.phrase = array_to_string(ws[cut_at + 1:cut.k], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut_at) = 1),
part AS (SELECT lang, a, k, ws, unnest(range(2, k)) AS m FROM c WHERE k > 2),
inside AS (SELECT lang, a, m, ws, unnest(range(1, k - m + 2)) AS i FROM part),
around AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM inside GROUP BY 1, 2),
kept AS (SELECT best.* FROM best LEFT JOIN around USING (lang, phrase) WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST(80 AS HUGEINT) * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


@query("op13_phrases", PHRASES_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))
