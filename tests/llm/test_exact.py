import hashlib
import re

import pytest

from tallyhouse.llm import exact_dedup


def brute(rows):
    plain = [re.sub(r"[\x20\x09-\x0d]+", " ", t or "") for _, t in rows]
    groups = {}
    for (i, _), p in zip(rows, plain, strict=True):
        groups.setdefault(p, []).append(i)
    out, seen = [], set()
    for (i, _), p in zip(rows, plain, strict=True):
        ids = [x for x in groups[p] if x is not None]
        keep = min(ids) if ids else None
        kept = i == keep and p not in seen
        if kept:
            seen.add(p)
        out.append((i, keep, len(groups[p]), kept, hashlib.sha256(p.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [False, True])
def test_decisions(spark, documents, edge_cases, hot):
    rows = edge_cases + [(100 + i, "many  copies" if i % 2 else "many\ncopies") for i in range(200 if hot else 4)]
    got = exact_dedup.exact_duplicates(documents(rows)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got), key=str) == brute(rows)


def test_kept_rows_have_their_columns(documents, edge_cases):
    """``keep_id`` is a column of the documents here, and stays theirs."""
    docs = documents(edge_cases)
    kept = exact_dedup.first_copies(docs)
    assert kept.schema == docs.schema
    rows = {tuple(r) for r in docs.collect()}
    got = [tuple(r) for r in kept.collect()]
    assert set(got) <= rows and len(got) == exact_dedup.exact_duplicates(docs).where("kept").count()
    assert {r.keep_id for r in kept.collect()} == {"x"}


def test_plan_is_native(spark, sf_dir, capsys):
    exact_dedup.exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).explain("formatted")
    plan = capsys.readouterr().out
    assert "rangepartitioning" in plan and "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_empty_table(documents):
    assert exact_dedup.exact_duplicates(documents([])).count() == 0
