import base64
import hashlib
import random

from tallyhouse.llm import archive, bloom, url_filter
from tallyhouse.session import work_dir


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, _digest string, rank int")


def test_round_trip(spark):
    rng = random.Random(6)
    bodies = [None, "", "<p>é</p>", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nb", "x" * 200000, *[f"body {i}" for i in range(20)]]
    rows = [(i, rng.choice([None, "", "no scheme", f"https://www.a{i % 4}.example.com/p?q={i % 3}#f", "http://b.c/\n x"]), rng.choice(bodies)) for i in range(300)]
    rows += [rows[5], (None, "http://n.o/", "of nobody")]
    folder = work_dir(spark, "warc")
    archive.write(pages(spark, rows), folder)
    entries = archive.read(spark, folder).collect()
    least = {}
    for i, _, h in rows:
        if i is not None:
            least[h or ""] = min(i, least.get(h or "", i))
    want = sorted(((i, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(), *(("response", None) if i is None or least[h or ""] == i else ("revisit", least[h or ""]))) for i, _, h in rows), key=str)
    assert sorted(((e.page_id, e.payload_bytes, e.payload_digest, e.record_type, e.refers_to) for e in entries), key=str) == want
    merged = archive.merge(archive.read(spark, folder)).orderBy("shard", "rank").collect()
    order = [(e.urlkey.encode(), e.date, e.page_id is not None, e.page_id or 0) for e in merged]
    assert len(merged) == len(rows) and order == sorted(order)


def test_small_payloads_are_all_responses(spark):
    folder = work_dir(spark, "warc")
    archive.write(pages(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]), folder, least=3)
    assert {(e.page_id, e.refers_to) for e in archive.read(spark, folder).collect()} == {(1, None), (2, None), (3, None), (4, 3)}


def test_loser_tree_merges():
    rng = random.Random(7)
    for k in range(9):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(0, 12))) for _ in range(k)]
        assert list(archive.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_empty_archive(spark):
    folder = work_dir(spark, "warc")
    archive.write(pages(spark, []), folder)
    assert archive.merge(archive.read(spark, folder)).count() == 0


def test_filter_and_exact_join(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MAX_BLOCKS", 2)  # a filter that is far too small only lets more through
    urls = [None, "", "nothing", "HTTP://WWW.Example.com/en/x", "a://example.com/en/", "a://b.example.com/en/?q", "a://net/es/", "a://x.net/fr", "a://x.net/fr/", "a://y.org/a.html", "a://m.y.org/a/", "a://y.org/b", "a://É.org/\n?x", "x://a.com"]
    rows = [(i, u, "") for i, u in enumerate(urls + urls[9:10] * 30 + [f"a://z{i}.org/{i}" for i in range(200)])]
    listed = spark.createDataFrame([("y.org/a",), ("y.org/a",), (None,), ("",), *[(f"q{i}.org/",) for i in range(500)]], "canonical string")
    got = {r.page_id: r for r in url_filter.judge(pages(spark, rows), listed).collect()}
    assert len(got) == len(rows)
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(14)] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("www.example.com", "/en/x", "www.example.com/en/", "allow"), ("example.com", "/en/", "example.com/en/", "block"), ("b.example.com", "/en/", "example.com/en/", "block"),
        ("net", "/es/", "net/es/", "block"), ("x.net", "/fr", None, "allow"), ("x.net", "/fr/", "net/fr/", "block"), ("y.org", "/a.html", None, "block"), ("m.y.org", "/a/", None, "block"), ("y.org", "/b", None, "allow"), ("É.org", "/\n", None, "allow"), ("a.com", "", None, "allow"),
    ]
    assert all(got[i].verdict == "block" for i in range(14, 44)) and all(got[i].verdict == "allow" for i in range(44, len(rows)))
    assert url_filter.judge(pages(spark, []), listed).count() == 0
    assert url_filter.judge(pages(spark, rows), listed.limit(0)).where("listed").count() == 0


def test_files_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archive, "FILE_BYTES", 16_000, raising=False)
    monkeypatch.setattr(archive, "SIZES", (2_000, 8_000), raising=False)
    rng = random.Random(12)
    rows = [(i, f"http://a.b/{i % 9}", f"{i} " + "y" * rng.choice([10, 500, 3_000, 6_000, 30_000])) for i in range(120)]
    rows += [(200, "http://a.b/long", rows[4][2]), (201, None, None)]
    folder = str(tmp_path / "warc")
    archive.write(pages(spark, rows).coalesce(2), folder)
    entries = archive.read(spark, folder).collect()
    assert sorted(e.page_id for e in entries) == sorted(r[0] for r in rows)
    held = {}
    for e in entries:
        held.setdefault(e.run, []).append(e)
    assert sum(f.stat().st_size > 16_000 and len(held[f.name]) > 1 for f in (tmp_path / "warc").glob("part-*")) == 0
    merged = archive.merge(archive.read(spark, folder)).orderBy("shard", "rank").collect()
    order = [(e.urlkey.encode(), e.date, e.page_id) for e in merged]
    assert len(merged) == len(rows) and order == sorted(order)
    assert {e.page_id: e.refers_to for e in merged}[200] == 4
