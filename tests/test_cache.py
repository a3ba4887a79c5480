from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from foliolens.operators.encoding import encode
from foliolens.sources import cache
from foliolens.sources.tables import markup_blocks
from foliolens.streaming.incremental import parse_new


def test_cached_documents_are_skipped(rows):
    documents = rows("path string, modified timestamp", [("a.pdf", None), ("b.pdf", None)])
    known = rows("cache_key string", [(hashlib.md5(b"a.pdf").hexdigest(),)] * 2)
    new = cache.new_documents(documents, known, cache.cache_key("path")).collect()
    assert [r.path for r in new] == ["b.pdf"]


def test_each_file_is_parsed_once(spark, rows, tmp_path):
    arrivals, table, progress = (str(tmp_path / n) for n in ("in", "blocks", "progress"))
    page = "<html><head><title>no</title></head><body><h1>Head &amp; more</h1><p>One<br>two</p></body></html>"
    schema = "page_id long, html string"

    def run():
        parse_new(spark, arrivals, schema, markup_blocks, table, progress).awaitTermination(120)
        return spark.read.parquet(table).orderBy("doc_id", "block_idx").collect()

    rows(schema, [(1, page)]).write.parquet(arrivals)
    first = run()
    assert [(r.tag, r.text, r.font_size) for r in first] == [("h1", "Head & more", 24.0), ("p", "One", 11.0), ("br", "two", 11.0)]
    rows(schema, [(2, "plain <script>var x = '<p>';</script><b>bold</b> rest")]).write.mode("append").parquet(arrivals)
    second = run()
    assert [(r.doc_id, r.text) for r in second][3:] == [(2, "plain"), (2, "bold"), (2, "rest")]
    assert run() == second


def test_own_encoder(rows):
    def make_encoder():
        import numpy as np

        return lambda texts: np.array([[len(t), 4.0] for t in texts], dtype="float32")

    vectors = encode(rows("text string", [("abc",), ("",)]), make_encoder).orderBy(F.desc("text")).collect()
    assert [[round(x, 6) for x in r.embedding] for r in vectors] == [[0.6, 0.8], [0.0, 1.0]]
