"""Web archives: WARC files written by Spark, read back, and their indexes merged in order.

Each writing task sorts its records by URL key, time and page and writes files of bounded record count
and bytes: every file is one sorted run of captures. Reading parses a file by its content lengths and yields index
entries in file order. The merge gives each task one range of (URL key, time, page), cut by
sampled splitters; inside it the entries of each run stay in file order and a loser tree merges the runs.
So the captures of one URL follow each other in time, over all files and tasks.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse.llm.bloom import marked, possible
from tallyhouse.llm.components import files
from tallyhouse.session import work_dir

RECORDS_PER_FILE = 2000
#: Entries of one range of the merge, which one task holds.
RANGE = 100_000
#: Bytes that a file of more than one record holds at most, and the record sizes up to which records share files.
FILE_BYTES, SIZES = 64 << 20, (1 << 17, 1 << 20, 1 << 23, 1 << 26)
#: Most bytes of a record besides its URL and payload.
HEAD_BYTES = 1024
CRLF = "\r\n"
FIRST_CAPTURE = 1_704_067_200
BASE32, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
URN = "urn:tallyhouse:page:"


def base32_sha1(text: Column) -> Column:
    """SHA-1 of the UTF-8 bytes in upper-case base 32: four groups of forty bits, eight digits each."""
    digest = F.sha1(text)
    return F.translate(F.concat(*[F.lpad(F.upper(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32)), 8, "0") for i in range(4)]), DIGITS, BASE32)


def url_key(url: Column) -> Column:
    """Host labels reversed, then path and query: ``com,example)/a?b``. Scheme, ``www.`` and fragment fall away; without ``://`` the text itself."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[^:]*://([^/?#]*)", 1)), r"^www\.", "")
    rest = F.regexp_extract(url, r"^[^:]*://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)).otherwise(F.coalesce(url, F.lit("")))


def _plain(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    return pages.select(F.col(f"`{key}`").alias("_page"), F.regexp_replace(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"[\x00-\x20\x7F]", "").alias("_url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("_html"))


def copied(plain: DataFrame, least: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """The payloads that stand on several pages, and the pages that may have one of them, without their payload; both are written once.

    Copies of one payload may be a third of all pages: the first page of each is found by an aggregation that combines in the tasks,
    payloads that occur once leave, and a Bloom filter of the rest picks the pages that take part in the join. A page
    gets ``_refers`` if another page comes first; without it, it is the first one or passed the filter by chance. Pages with a null
    key are no copies.
    """
    spark = plain.sparkSession
    rows = plain.where("_page IS NOT NULL").select("_page", "_url", base32_sha1(F.col("_html")).alias("_digest"), F.octet_length("_html").cast("long").alias("_size"))
    several = rows.where(F.col("_size") >= least).groupBy("_digest", "_size").agg(F.min("_page").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    several.drop("_n").write.parquet(f"{folder}/payloads")
    first = spark.read.parquet(f"{folder}/payloads")
    joined = possible(rows, first, "_digest").join(first, ["_digest", "_size"], "left")
    joined.select("_page", "_url", "_digest", "_size", F.when(F.col("_first") != F.col("_page"), F.col("_first")).alias("_refers")).write.parquet(f"{folder}/pages")
    return first, spark.read.parquet(f"{folder}/pages")


def records(pages: DataFrame, least: int = 0, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Sort columns, size class and the text of one WARC record per page, without the two line ends after it.

    Of equal payloads of at least ``least`` bytes the page with the smallest key is a response and the others revisit it; rows with that
    same key are responses too. A null key is a response of nobody. Null payloads and URLs are empty. An empty table gives no records.

    Payloads stay where they are read, but for those first pages: a page whose payload is surely unique needs
    no decision, and a revisit has no payload.
    """
    plain, folder = _plain(pages, key, url, html), work_dir(pages.sparkSession, "copies")
    first, few = copied(plain, least, folder)
    rows = plain.withColumns({"_digest": base32_sha1(F.col("_html")), "_size": F.octet_length("_html").cast("long")})
    flagged = marked(rows, first, "_digest", "_maybe")
    unique = flagged.where("_page IS NULL OR NOT _maybe").drop("_maybe").withColumn("_refers", F.lit(None).cast("long"))
    kept = few.where("_refers IS NULL").select("_page", "_digest").distinct()
    some = possible(flagged.where("_page IS NOT NULL AND _maybe").drop("_maybe"), kept, "_page").join(kept, ["_page", "_digest"]).withColumn("_refers", F.lit(None).cast("long"))
    revisits = few.where("_refers IS NOT NULL").withColumn("_html", F.lit(""))
    few_files = files(kept.count())
    every = unique.unionByName(some.coalesce(few_files)).unionByName(revisits.coalesce(few_files))
    revisit = F.col("_refers").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("_size"), F.lit(CRLF * 2))
    block = F.concat(http, "_html")
    stamp = F.lit(FIRST_CAPTURE) + F.coalesce("_page", F.lit(0))
    head = F.concat_ws(
        CRLF, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")), F.concat(F.lit(f"WARC-Record-ID: <{URN}"), F.coalesce(F.col("_page").cast("string"), F.lit("null")), F.lit(">")),
        F.concat(F.lit("WARC-Date: "), F.date_format(F.timestamp_seconds(stamp), "yyyy-MM-dd'T'HH:mm:ss'Z'")), F.concat(F.lit("WARC-Target-URI: "), F.col("_url")), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("_digest")),
        F.when(revisit, F.concat_ws(CRLF, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), F.concat(F.lit(f"WARC-Refers-To: <{URN}"), F.col("_refers"), F.lit(">")))),
        F.lit("Content-Type: application/http; msgtype=response"), F.concat(F.lit("Content-Length: "), F.octet_length(block)),
    )
    return every.select(url_key(F.col("_url")).alias("urlkey"), stamp.alias("timestamp"), F.col("_page").alias("page"), _size_class(F.octet_length("_url") + F.col("_size")).alias("class"), F.concat(head, F.lit(CRLF * 2), block).alias("value"))


def _size_class(size: Column) -> Column:
    return sum(((size + HEAD_BYTES > limit).cast("int") for limit in SIZES), F.lit(0))


def write(pages: DataFrame, folder: str, url: str = "url", html: str = "html", **options) -> None:
    """Write ``records`` as WARC files, each sorted by URL key, time and page. An empty table writes an empty file.

    Spark's text writer appends the line separator to every row, and two line ends are what closes a record. It bounds
    files by records only, so records of each class of sizes are written on their own, the larger the fewer to a file. What
    is a revisit is decided once for all classes.
    """
    every = records(pages, url=url, html=html, **options)
    sizes = _plain(pages, options.get("key", "page_id"), url, html).select(_size_class(F.octet_length("_url") + F.octet_length("_html").cast("long")).alias("class"))
    held = sorted(r[0] for r in sizes.distinct().collect())
    for n, c in enumerate(held or [0]):
        most = min(RECORDS_PER_FILE, max(1, FILE_BYTES // SIZES[c])) if c < len(SIZES) else 1
        sorted_ = (every.where(F.col("class") == c) if len(held) > 1 else every).sortWithinPartitions("urlkey", "timestamp", "page")
        sorted_.select("value").write.mode("append" if n else "errorifexists").option("lineSep", CRLF * 2).option("maxRecordsPerFile", most).text(folder)


def parse(content: bytes) -> Iterator[dict]:
    """Index entries of one file, in order: headers, offset, and size and digest of the payload found in the record."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at) + 4
        head = dict(line.split(": ", 1) for line in content[at:end].decode().split(CRLF)[1:] if ": " in line)
        stop = end + int(head["Content-Length"])
        body = content.index(b"\r\n\r\n", end) + 4
        payload = content[body:stop]
        size = int(re.search(rb"\r\nContent-Length: (\d+)", content[end:body])[1])
        if content[stop : stop + 4] != b"\r\n\r\n" or head["WARC-Type"] == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != head["WARC-Payload-Digest"][5:]):
            raise ValueError(f"damaged record at {at}: {head}")
        yield head | {"offset": at, "size": size}
        at = stop + 4


ENTRY = "run string, seq long, offset long, page_id long, url string, date string, record_type string, refers_to long, payload_digest string, payload_bytes long"


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One index entry per record of all WARC files of a folder; ``run`` is the file, ``seq`` the place in it.

    Payloads are checked against their digests; a damaged record fails the task. A folder of empty files gives no rows.
    """
    schema = pa.schema([(c.split()[0], pa.string() if c.split()[1] == "string" else pa.int64()) for c in ENTRY.split(", ")])

    def number(urn: str | None) -> int | None:
        return None if urn is None or urn.endswith(":null>") else int(urn.removeprefix(f"<{URN}").removesuffix(">"))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                run = batch.column(0)[i].as_py().rsplit("/", 1)[-1]
                rows = [(run, n, e["offset"], number(e["WARC-Record-ID"]), e.get("WARC-Target-URI", ""), e["WARC-Date"], e["WARC-Type"], number(e.get("WARC-Refers-To")), e["WARC-Payload-Digest"][5:], e["size"]) for n, e in enumerate(parse(batch.column(1)[i].as_py()))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)

    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return found.select("path", "content").mapInArrow(entries, ENTRY)


class LoserTree:
    """Merge of k sorted lists: each inner node keeps the loser of its match, so the next smallest costs one path to the root."""

    def __init__(self, runs: list[list]):
        self.runs, self.at, k = runs, [0] * len(runs), len(runs)
        self.tree = [-1] * max(k, 1)
        for i in range(k):
            self._play(i)

    def _before(self, a: int, b: int) -> bool:
        """Whether run a's head comes first; an empty place wins while the tree is filled, an exhausted run always loses."""
        if a < 0 or b < 0:
            return a < 0
        if self.at[b] == len(self.runs[b]):
            return True
        return self.at[a] < len(self.runs[a]) and (self.runs[a][self.at[a]], a) < (self.runs[b][self.at[b]], b)

    def _play(self, winner: int) -> None:
        node = (winner + len(self.runs)) // 2
        while node > 0:
            if self._before(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator:
        while self.runs:
            w = self.tree[0]
            if self.at[w] == len(self.runs[w]):
                return
            yield self.runs[w][self.at[w]]
            self.at[w] += 1
            self._play(w)


def merge(entries: DataFrame) -> DataFrame:
    """All entries in global order of (urlkey, date, page): partitions are ranges, and ``shard`` and ``rank`` give the place.

    The page is part of the splitters, so a URL with very many captures spans several tasks. There are so many ranges that one
    has about ``RANGE`` entries. ``entries`` is read several times, so give it written. Null pages come first, rows that
    are equal in all three stay in the order of their runs; no entries give no rows.
    """
    parts = max(int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-entries.count() // RANGE))
    keyed = entries.select(url_key(F.col("url")).alias("urlkey"), "*")
    columns = keyed.columns
    ranged = keyed.repartitionByRange(parts, "urlkey", "date", "page_id").sortWithinPartitions("run", "seq").select(F.spark_partition_id().cast("long").alias("shard"), *columns)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        table = pa.Table.from_batches(got) if got else None
        if table is None or not len(table):
            return
        name, key, date, page = (table.column(c).to_pylist() for c in ("run", "urlkey", "date", "page_id"))
        runs: list[list] = []
        for i in range(len(table)):
            if not i or name[i] != name[i - 1]:
                runs.append([])
            runs[-1].append((key[i].encode(), date[i], page[i] is not None, page[i] or 0, i))
        order = [x[-1] for x in LoserTree(runs)]
        table = table.take(pa.array(order, pa.int64())).append_column("rank", pa.array(range(len(order)), pa.int64()))
        yield from table.combine_chunks().to_batches(max_chunksize=5000)

    return ranged.mapInArrow(merged, "shard long, urlkey string, " + ENTRY + ", rank long")
