"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

from spherecube.llm import decontaminate, html_text, license_scan, near_dup, packing, quality_model, quality_rules, substring_dedup, toxicity, warc
from spherecube.llm.queries import tokenizer_path

LONG = " ".join(f"w{k % 977}x{k}" for k in range(30_000))
ROWS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (6, LONG), (6, LONG),
    (7, "one two three four five six seven eight nine ten eleven twelve"), (None, "a text without id"), (8, "   café 中文 <|endoftext|>"), (9, "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, "en", 1, 2, True, "s", 0.5) for r in ROWS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, row string, start bigint, n_words bigint, _kept boolean, hash string, score double")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, (k + 1) % 2) for k in range(1, 10)] + [(None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "Two THREE four five six seven eight nine ten eleven"), (1, "Two THREE four five six seven eight nine ten eleven"), (2, None), (3, ""), (4, "café 中文"), (None, "x")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def ids(df):
    return sorted([r[0] for r in df.select("doc_id").collect()], key=lambda x: (x is None, x))


ALL = sorted([r[0] for r in ROWS], key=lambda x: (x is None, x))


def test_license_scan(spark, docs):
    assert license_scan.scan_licenses(docs).count() == 0
    text = "first words. " + license_scan.TEMPLATES["MIT notice"].upper() + " last"
    found = license_scan.scan_licenses(docs.limit(0).select("doc_id", "text").union(spark.createDataFrame([(1, text)], "doc_id bigint, text string"))).collect()
    assert [(r.license, r.start, r.end, r.coverage) for r in found] == [("MIT notice", 2, 7, 1.0)]
    assert license_scan.scan_licenses(docs, {"none": ""}).count() == 0


def test_decontamination(docs, benchmark):
    out = decontaminate.annotate(docs, benchmark)
    assert out.columns == [*docs.columns, "_leak"]
    rows = {r.doc_id: r._leak for r in out.filter("doc_id is not null").collect()}
    assert len(rows) == 9 and ids(out) == ALL
    assert (rows[1].n_hit, rows[1].item_ids) == (10, ["1"]) and rows[7] == rows[1]
    assert (rows[8].n_hit, rows[8].item_ids) == (2, ["4"]) and rows[2].n_words == rows[3].n_words == 0
    assert rows[9].n_hit == 0  # an item without id has no windows
    assert decontaminate.annotate(docs, benchmark.limit(0)).filter("_leak.n_hit > 0").count() == 0
    assert decontaminate.annotate(docs.limit(0), benchmark).count() == 0


def test_quality_rules(docs, labels):
    out = quality_rules.assess(docs, labels)
    assert ids(out) == ALL and set(docs.columns) <= set(out.columns)
    stats = {r.doc_id: r._stats for r in out.filter("doc_id is not null").collect()}
    assert stats[2].n_words == stats[3].n_words == stats[4].n_words == 0 and stats[5].n_words == 30_000
    assert out.filter("doc_id = 5").first()._base_failed is False
    assert quality_rules.assess(docs, labels.limit(0)).filter("_rule is not null").count() == 0
    assert quality_rules.assess(docs.limit(0), labels).count() == 0


def test_packing(docs):
    out = packing.pack(docs, tokenizer_path(), with_ids=False)
    rows = out.collect()
    sizes = {r.doc_id: r.doc_tokens for r in rows}
    assert sizes[2] == sizes[3] == 1 and len(rows) == sum(-(-r.doc_tokens // 1024) for r in rows if r.start == 0)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(docs.limit(0), tokenizer_path()).count() == 0


@pytest.mark.parametrize("classify", [quality_model.quality, toxicity.toxicity])
def test_classifiers(docs, labels, classify):
    out = classify(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert ids(out) == ALL and all(0 <= r.score <= 1 for r in rows)
    assert classify(docs, labels.limit(0)).count() == len(ROWS)
    assert classify(docs.limit(0), labels).count() == 0


def test_near_duplicates(docs):
    out = near_dup.near_duplicates(docs, shingle=2)
    assert ids(out) == ALL
    rows = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out.filter("doc_id is not null").collect()}
    assert rows[1] == (11, 1, True) and rows[7] == (11, 1, False) and rows[6][1:] == (5, False) and rows[5][2]
    assert rows[2] == (0, 2, True) and rows[4] == (0, 4, True) and rows[9] == (1, 9, True)
    assert out.filter("doc_id is null").first().kept
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_substring_dedup(docs):
    rows = substring_dedup.repeated_passages(docs).collect()
    assert [(r.doc_id, r.start, r.end, r.source_doc_id) for r in rows] == [(6, 0, 30_000, 5)]
    cut = substring_dedup.without_passages(docs, substring_dedup.repeated_passages(docs))
    assert cut.columns == [*docs.columns, "_cut"] and ids(cut) == ALL
    assert [r.text for r in cut.filter("doc_id = 6").collect()] == ["", ""]
    assert substring_dedup.repeated_passages(docs.limit(0)).count() == 0


def test_warc(spark, docs):
    page = "<p>" + "words " * 50
    rows = [(1, "http://A.example.org:80/x?y#z", page), (2, "http://a.example.org/x?y", page), (3, None, None), (4, "odd", ""), (5, "http://b/", page), (5, "http://b/", page), (6, "u", "\r\n\r\nWARC/1.1\r\n" + LONG), (None, "http://n/", "short")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, start int")
    out = warc.round_trip(spark, pages)
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in out.collect()), key=str)
    size = len(page)
    want = [(1, size, "response", None), (2, size, "revisit", 1), (3, 0, "response", None), (4, 0, "response", None), (5, size, "revisit", 1), (5, size, "revisit", 1), (6, len(LONG) + 14, "response", None), (None, 5, "response", None)]
    assert got == sorted(want, key=str)
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_html(spark):
    page = "<html><body><div class='x'>Site name</div><div class='text'><p>body {}</p></div>"
    rows = [(k, f"http://h/{k}", page.format(k)) for k in range(4)] + [(9, None, None), (10, "http://h/e", ""), (11, "odd", "<p>no &amp; host")] + [(0, "http://h/0", page.format(0))]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id bigint, url string, html string, text string")
    out = html_text.main_text(pages)
    got = sorted((r.page_id, r.text, r.n_chars) for r in out.collect())
    # the name of the site comes on every page and is template
    assert got == [(0, "body 0", 6), *[(k, f"body {k}", 6) for k in range(4)], (9, "", 0), (10, "", 0), (11, "no & host", 9)]
    assert html_text.main_text(pages.limit(0)).count() == 0


def test_words_of_other_types(spark):
    # ids may be strings
    docs = spark.createDataFrame([("a", LONG), ("b", LONG), ("c", None)], "doc_id string, text string").withColumn("n", F.lit(1))
    assert {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs).collect()} == {"a": "a", "b": "a", "c": "c"}
    assert [r.doc_id for r in substring_dedup.repeated_passages(docs).collect()] == ["b"]
