"""Queries for product documents and vector search."""

from pyspark.sql import functions as F

from tallyhouse.operators import narrative, retrieval as rt
from tallyhouse.plans import common
from tallyhouse.plans.registry import query
from tallyhouse.session import work_dir
from tallyhouse.sources import sinks

VENDOR_SQL = """SELECT product_id, vendor_id, line_count FROM (SELECT product_id, vendor_id, count(*) AS line_count FROM g_sales GROUP BY 1, 2) c
    QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY line_count DESC, vendor_id) = 1"""


@query("rag_1_primary_vendor", VENDOR_SQL)
def primary_vendor(t):
    return rt.primary_vendor(common.sales(t))


SLOW_SQL = """SELECT product_id, max(days_since_last_sale) AS max_days_since_last_sale, array_to_string(list_sort(list(DISTINCT region)), ', ') AS slow_regions,
    CAST(sum(total_quantity_sold) AS BIGINT) AS total_quantity_sold FROM g_slow GROUP BY 1"""


@query("rag_2_slow_summary", SLOW_SQL)
def slow_summary(t):
    return rt.slow_summary(common.slow(t)).withColumn("slow_regions", F.array_join("slow_regions", ", "))


REGION_SQL = "SELECT region, sum(total_sales) AS region_total_sales, sum(total_profit) AS region_total_profit, CAST(sum(order_count) AS BIGINT) AS region_order_count FROM g_revenue GROUP BY 1"


@query("rag_2_region_revenue", REGION_SQL)
def region_revenue(t):
    return rt.region_revenue(common.revenue(t))


def _enriched(t):
    return rt.enriched_products(t.products, rt.primary_vendor(common.sales(t)), t.vendors, rt.slow_summary(common.slow(t)), common.rates(t))


ENRICHED_SQL = f"""SELECT p.product_id, p.product_name, p.brand, p.categories, p.manufacturer, v.vendor_id, coalesce(n.vendor_name, 'Unknown Vendor') AS vendor_name,
    coalesce(s.max_days_since_last_sale, 0) AS max_days_since_last_sale, s.slow_regions, coalesce(s.total_quantity_sold, 0) AS total_quantity_sold,
    coalesce(r.return_rate_pct, 0.0) AS return_rate_pct, coalesce(r.total_returns, 0) AS total_returns
    FROM s_products p LEFT JOIN ({VENDOR_SQL}) v ON p.product_id = v.product_id LEFT JOIN s_vendors n ON v.vendor_id = n.vendor_id
    LEFT JOIN ({SLOW_SQL}) s ON p.product_id = s.product_id LEFT JOIN g_rates r ON v.vendor_id = r.vendor_id"""


@query("rag_3_enriched_products", ENRICHED_SQL)
def enriched_products(t):
    return _enriched(t).select(
        "product_id", "product_name", "brand", "categories", "manufacturer", "vendor_id", "vendor_name", "max_days_since_last_sale",
        F.array_join("slow_regions", ", ").alias("slow_regions"), "total_quantity_sold", "return_rate_pct", "total_returns")


def _known(c):
    return f"coalesce(nullif(CAST({c} AS VARCHAR), ''), 'unknown')"


def _money(c):
    return f"CAST(CAST({c} AS DECIMAL(18,2)) AS VARCHAR)"


DOCUMENT_SQL = f"""
    SELECT product_id, {_known('product_name')} || ' (item ' || {_known('product_id')} || ') | maker: ' || {_known('manufacturer')} || ' | brand: ' || {_known('brand')} || ' | filed under: ' || {_known('categories')}
        || ' | vendor: ' || {_known('vendor_name')} || ', no. ' || {_known('vendor_id')} || ' | goods sent back to the vendor: ' || {_known('total_returns')} || ', or ' || CAST(CAST(return_rate_pct AS DECIMAL(10,2)) AS VARCHAR) || ' percent'
        || ' | pace: ' || CASE WHEN slow_regions <> '' THEN 'slow, idle for ' || CAST(max_days_since_last_sale AS VARCHAR) || ' days in ' || slow_regions
                WHEN max_days_since_last_sale > 90 THEN 'slow, idle for ' || CAST(max_days_since_last_sale AS VARCHAR) || ' days' ELSE 'steady' END
        || coalesce(' | regions: ' || (SELECT string_agg(region || ' sales ' || {_money('region_total_sales')} || ' profit ' || {_money('region_total_profit')} || ' orders ' || CAST(region_order_count AS VARCHAR), '; ' ORDER BY region)
                FROM ({REGION_SQL}) g WHERE list_contains(string_split(e.slow_regions, ', '), g.region)), '') AS document
    FROM ({ENRICHED_SQL}) e"""


@query("rag_4_documents", DOCUMENT_SQL)
def documents(t):
    return rt.documents(_enriched(t), rt.region_revenue(common.revenue(t)))


@query("rag_4_document_openings", f"SELECT product_id, string_split(document, ' | goods')[1] AS opening FROM ({DOCUMENT_SQL}) d")
def document_openings(t):
    """First half of every document: identity and vendor."""
    docs = rt.documents(_enriched(t), rt.region_revenue(common.revenue(t)))
    return docs.select("product_id", F.split("document", r" \| goods")[0].alias("opening"))


@query("rag_5_embedded_documents")
def embedded_documents(t):
    return rt.embed(t.raw("documents").select("doc_id", "text"), "text", 64).drop("text")


@query(
    "rag_6_nearest_vectors",
    """WITH q AS (SELECT label AS query_label, list(m ORDER BY pos) AS qv FROM (SELECT label, pos, avg(CAST(embedding[pos] AS DOUBLE)) AS m
                  FROM embeddings CROSS JOIN (SELECT unnest(generate_series(1, 64)) AS pos) p GROUP BY 1, 2) x GROUP BY 1),
        d AS (SELECT query_label, vec_id, list_sum(list_transform(generate_series(1, 64), lambda i: (CAST(embedding[i] AS DOUBLE) - qv[i]) * (CAST(embedding[i] AS DOUBLE) - qv[i]))) AS distance
              FROM embeddings CROSS JOIN q)
        SELECT query_label, vec_id, CAST(rn AS INTEGER) AS rank, round(distance, 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY query_label ORDER BY distance, vec_id) AS rn FROM d) r WHERE rn <= 5""",
)
def nearest_vectors(t):
    """The five vectors nearest to the centre of every label, over all vectors."""
    vectors = t.raw("embeddings")
    queries = rt.centroids(vectors, "label").withColumnRenamed("label", "query_label")
    return rt.nearest(vectors, queries, "vec_id", "query_label", 5).withColumn("distance", F.round("distance", 6))


def _approximate(t):
    """Ten centres and every 50th vector as questions, over all vectors."""
    vectors, path = t.raw("embeddings"), work_dir(t.spark, "index")
    rt.build_index(vectors, path, "vec_id")
    asked = rt.centroids(vectors, "label").select(F.concat(F.lit("label "), F.col("label").cast("string")).alias("question"), "embedding").unionByName(
        vectors.where("vec_id % 50 = 0").select(F.concat(F.lit("vector "), F.col("vec_id").cast("string")).alias("question"), F.col("embedding").cast("array<double>").alias("embedding")))
    return vectors, asked, rt.approximate_nearest(asked, path, "vec_id", "question")


@query("rag_7_approximate_neighbours")
def approximate_neighbours(t):
    return _approximate(t)[2].withColumn("distance", F.round("distance", 6))


@query("rag_7_recall")
def approximate_recall(t):
    """Share of the exact five neighbours that the index finds, and of the vectors that a question is compared with."""
    vectors, asked, found = _approximate(t)
    exact = rt.nearest(vectors, asked, "vec_id", "question", 5).select("question", "vec_id")
    hits = exact.join(found.select("question", "vec_id", F.lit(1).alias("hit")), ["question", "vec_id"], "left")
    total = vectors.agg(F.count(F.lit(1))).scalar()
    compared = found.groupBy("question").agg(F.max("compared").alias("compared"))
    return hits.agg(F.round(F.count("hit") / F.count(F.lit(1)), 4).alias("recall_at_5"), F.count_distinct("question").alias("questions")).join(
        compared.agg(F.round(F.avg(F.col("compared") / total), 4).alias("compared_share")), F.lit(True))


@query(
    "rag_8_stored_vectors",
    r"""SELECT doc_id, 64 AS dim, CASE WHEN regexp_matches(changed, '[\p{L}\p{N}]') THEN 1.0 ELSE 0.0 END AS norm, (SELECT count(*) FROM documents) AS embedded_first, CAST(0 AS BIGINT) AS embedded_second,
              (SELECT count(*) FROM documents WHERE doc_id % 10 = 3) AS embedded_third FROM (SELECT doc_id, CASE WHEN doc_id % 10 = 3 THEN 'anew ' || coalesce(text, '') ELSE coalesce(text, '') END AS changed FROM documents WHERE doc_id % 10 <> 7) d""",
)
def stored_vectors(t):
    """Build the store, ask for it again, then change one document in ten and drop another one in ten."""
    docs, path = t.raw("documents").select("doc_id", "text"), work_dir(t.spark, "vectors")
    _, first = rt.refresh_store(docs, "doc_id", "text", path, 64)
    _, second = rt.refresh_store(docs, "doc_id", "text", path, 64)
    changed = docs.where("doc_id % 10 <> 7").withColumn("text", F.when(F.col("doc_id") % 10 == 3, F.concat(F.lit("anew "), F.coalesce("text", F.lit("")))).otherwise(F.col("text")))
    vectors, third = rt.refresh_store(changed, "doc_id", "text", path, 64)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return vectors.select("doc_id", F.size("embedding").alias("dim"), F.round(norm, 3).alias("norm"), *[F.lit(n).cast("bigint").alias(f"embedded_{c}") for n, c in ((first, "first"), (second, "second"), (third, "third"))])


QUESTIONS = [
    (1, "items idle for most days, slow pace"),
    (2, "goods sent back to the vendor, percent"),
    (3, "sheets with regions West sales and profit"),
    (4, "slow pace in East"),
    (5, "brand and maker of steady items"),
    (6, "orders and profit by regions"),
    (7, "zzz qqq xxx"),
]


def _answers(t):
    """Documents are read for the search and for the texts, so they are written once."""
    docs = common.staged(t, "sheets", rt.documents(_enriched(t), rt.region_revenue(common.revenue(t))))
    questions = t.spark.createDataFrame(QUESTIONS, "question_id int, question string")
    hits = rt.nearest(rt.embed(docs, "document"), rt.embed(questions, "question"), "product_id", "question_id", 5)
    return rt.answers(hits, docs, questions, "question_id", "product_id", max_distance=1.9)


@query("rag_9_answers")
def answers(t):
    return _answers(t)


@query(
    "rag_10_history_kpis",
    "SELECT TIMESTAMP '2024-02-01 00:00:00' AS first_queried_at, TIMESTAMP '2024-02-01 00:00:00' AS last_queried_at, CASE WHEN (SELECT count(*) FROM s_products) > 0 THEN 7 END AS queries_answered",
)
def history_kpis(t):
    path = work_dir(t.spark, "history")
    rt.record_answers(narrative.checked(_answers(t), "answer", min_words=10), path, common.run_at())
    kpis = rt.history_kpis(sinks.read_merged(t.spark, path))
    return kpis.where(F.col("passed") + F.col("review") == F.col("queries_answered")).select("first_queried_at", "last_queried_at", F.col("queries_answered").cast("int"))
