"""Registered queries of this package: the operators with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.llm import archive, byte_bpe, decontaminate, exact_dedup, jaccard, language, line_dedup, packing, pii, spelling, toxicity, url_filter, vector_codes
from tallyhouse.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, modulus: int):
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(modulus))


def op1_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_components(table(spark, sf_dir, "documents"), words=3, percent=90)


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    order = F.create_map(*[x for i, k in enumerate(pii.KINDS) for x in (F.lit(k), F.lit(i))])
    ranked = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return found.select("doc_id", *[of(k) for k in pii.KINDS], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(ranked).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, vocabulary = table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    model = language.train(docs.where(remainder("doc_id", 4) != 2), vocabulary)
    return language.predict(docs, model, vocabulary).select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1)
    model = toxicity.train(toxicity.labelled(docs, labels), draw=lambda share: toxicity.labelled(docs, labels, share))
    scored = toxicity.scored(docs, model)
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.repeated(pages)).select("page_id", "host", "path", "rule", "verdict", "listed")


def op6_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.without_boilerplate(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "lines", "removed", F.sha2("clean", 256).alias("clean_sha256"))


def op7_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def pack(docs: DataFrame) -> DataFrame:
    path = public_tokenizers.path
    return packing.pack(docs, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "warc")
    archive.write(table(spark, sf_dir, "pages"), folder)
    archive.read(spark, folder).write.parquet(f"{folder}-index")
    merged = archive.merge(spark.read.parquet(f"{folder}-index"))
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "date", "shard", "rank")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.corpus_words(table(spark, sf_dir, "documents")))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    summed = vector_codes.with_label_error(codes)
    return summed.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256"), F.col("scans").alias("n_scans"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode(encoded, path)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2("ids_le", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_jaccard_components, op2_personal_data, op3_language, op4_toxicity, op5_url_filter, op6_line_spread, op7_benchmark_passages, op8_packing, op9_exact_dedup, op10_warc, op11_spelling_variants, op12_vector_codes, op13_byte_bpe, pipeline)}

_HOST = "translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1)"
_NORMAL = r"regexp_replace(coalesce(text, ''), '[ \t\n\v\f\r]+', ' ', 'g')"
_FITS = "(host = '{0}' OR host LIKE '%.{0}') AND starts_with(path, '{1}')"

CHECKS = {
    "op5_url_filter": f"""
WITH parsed AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
named AS (SELECT *, regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '(/index)?(\\.html?)?/*$', '') AS canonical FROM parsed),
listed AS (SELECT canonical FROM named WHERE canonical <> '' GROUP BY 1 HAVING count(*) > 1),
ruled AS (SELECT *, CASE {' '.join(f"WHEN {_FITS.format(h, p)} THEN '{h}{p}'" for h, p, _ in sorted(url_filter.RULES, key=lambda r: -len(r[0]) - len(r[1])))} END AS rule,
  canonical IN (SELECT canonical FROM listed) AND canonical <> '' AS on_list FROM named)
SELECT page_id, host, path, rule, CASE {' '.join(f"WHEN rule = '{h}{p}' THEN '{v}'" for h, p, v in url_filter.RULES)} WHEN on_list THEN 'block' ELSE 'allow' END AS verdict,
  on_list AS listed FROM ruled""",
    "op6_line_spread": f"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, source FROM documents),
split AS (SELECT r, doc_id, source, string_split(text, chr(10)) AS parts FROM numbered),
lines AS (SELECT r, source, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS nth FROM split),
plain AS (SELECT *, trim(regexp_replace(line, '[ \t\\n\\v\\f\\r]+', ' ', 'g'), ' ') AS key FROM lines),
bad AS (SELECT key FROM plain WHERE key <> '' GROUP BY key HAVING count(DISTINCT source) >= {line_dedup.SITES}),
cleaned AS (SELECT r, count(*) AS lines, count(*) FILTER (WHERE key IN (SELECT key FROM bad)) AS removed, coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (WHERE key NOT IN (SELECT key FROM bad)), '') AS clean FROM plain GROUP BY r)
SELECT doc_id, c.lines, removed, sha256(clean) AS clean_sha256 FROM split JOIN cleaned c USING (r)""",
    "op9_exact_dedup": f"""
WITH n AS (SELECT doc_id, {_NORMAL} AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AND row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256 FROM n WINDOW w AS (PARTITION BY t)""",
}
