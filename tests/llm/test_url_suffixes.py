"""The registered query knows suffixes of several labels."""

import tempfile

from modelsmith.llm.registry import op1_url_filters


def test_sites_under_one_suffix_are_no_domain(spark, make):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    pages, labels = [], []
    for s in range(12):  # a site of one bad page among others under one suffix, good but for those of one name
        for k in range(40 if s else 3):
            pages.append((len(pages), f"http://{'www' if s else 'new'}.{'bad' if s % 2 == 0 else f'good{s}'}.co.uk/{k}"))
            if s:
                labels.append((len(labels) + 3, int(s % 2)))
    make(pages, "page_id long, url string").write.parquet(f"{folder}/pages.parquet")
    make(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    got = {r.host: r.verdict for r in op1_url_filters(spark, folder).select("host", "verdict").distinct().collect()}
    assert got["www.bad.co.uk"] == "block" and got["new.bad.co.uk"] == "block"
