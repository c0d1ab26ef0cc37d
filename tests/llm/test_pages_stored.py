"""Blocks of pages are written once and never shuffled."""

from __future__ import annotations

from areaweave.llm import html_extract


def test_blocks_of_pages_stay_where_they_are(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "CHUNK_CHARS", 500)
    menu = "<div class=x><p>one same long line that stands on every page of the site</p></div>"
    rows = [(i if i % 9 else None, f"http://h{i % 2}/{i}" if i % 5 else None,
             f"<body>{menu}<article><p>text {i} of its own</p></article></body>" if i % 7 else None) for i in range(60)]
    pages = spark.createDataFrame(rows + rows[:3], "page_id long, url string, html string").repartition(3)
    stored, store = [], html_extract.stored
    monkeypatch.setattr(html_extract, "stored", lambda df, name, **o: stored.append(df.columns) or store(df, name, **o))
    found = html_extract.extract_pages(pages)
    got = sorted((r.page_id is not None, r.page_id or 0, r.url or "", r.text) for r in found.collect())
    want = [(i, u, f"text {n % 60} of its own" if h else "") for n, (i, u, h) in enumerate(rows)]
    assert got == sorted((i is not None, i or 0, u or "", t) for i, u, t in want + want[:3])
    assert not any("blocks" in columns for columns in stored)
    physical = found._jdf.queryExecution().executedPlan().toString()
    assert "blocks" not in "".join(line for line in physical.splitlines() if "Exchange" in line)
