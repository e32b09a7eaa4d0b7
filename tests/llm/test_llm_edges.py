"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pageflow.llm import (bpe, chunks, decontaminate, html_crf, jaccard, quality_fm, quality_rules, secrets, shards,
                          url_filter)
from pageflow.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = " ".join(f"word{i % 89} the of and number{i % 97}." for i in range(60))
CLASHES = ("ids", "decoded", "spans", "score", "leaks", "class", "row", "digest", "k0", "n_secrets", "masked_text",
           "token", "shard", "key", "size", "features", "unnamed", "rule", "verdict")


def documents(spark, rows):
    df = spark.createDataFrame([(i, t, lang, "src0", None if t is None else len(t)) for i, t, lang in rows], DOCS)
    for c in CLASHES:
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def odd(spark):
    long = PROSE * 400
    return documents(spark, [
        (1, PROSE, "en"), (1, PROSE, "en"), (2, PROSE, None), (3, None, "en"), (4, "", "fr"), (5, " \n\t ", "de"), (None, PROSE, "en"),
        (None, None, None), (6, "one", "en"), (7, "ONE", "xx"), (8, long, "en"), (9, "a" * 300_000, "en"), (10, "la " * 50_000, "fr"),
        (11, "password=abcdefghijkl0 " + PROSE[:300], "en"), (12, "é\u0085\u00a0\x1c世界 \U0001F600 ͏\ue000", "es")])


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, []).limit(0)


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_chunks(odd, none):
    rows = chunks.repeats(odd).collect()
    prose = [r for r in rows if r["doc_id"] in (1, 2) and r["start"] == 0]
    assert sorted((r["doc_id"], r["removed"]) for r in prose) == [(1, False), (1, False), (2, True)]
    assert all(r["end"] == len(PROSE) for r in prose)
    assert {r["doc_id"] for r in rows} >= {9, 10} and not {3, 4, 6, 7} & {r["doc_id"] for r in rows}
    assert chunks.repeats(none).count() == 0


def test_jaccard(odd, none):
    rows = jaccard.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows}
    assert {(3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 6), (9, 1, 9)} <= got
    assert [r["component_id"] for r in rows if r["doc_id"] in (1, 2)] == [1, 1, 1]
    assert sorted(str(r["component_id"]) for r in rows if r["doc_id"] is None) == ["1", "None"]
    assert jaccard.near_duplicates(none).count() == 0


def test_bpe(odd, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    coded = bpe.decode(bpe.encode(odd, tokenizer_path()), tokenizer_path()).collect()
    texts = [r["text"] for r in odd.select("doc_id", "text").collect()]
    assert len(coded) == len(texts)
    for r, text in zip(coded, texts):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False)
    assert bpe.decode(bpe.encode(none, tokenizer_path()), tokenizer_path()).count() == 0


def test_html(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "u", "<p>a"), (3, "u", "<div>" * 5000 + "<p>x  y</p>"),
                                   (3, "u", "<div>" * 5000 + "<p>x  y</p>")], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    rows = html_crf.extract(pages).collect()
    assert len(rows) == 5 and by_page(rows, 1) == [""] and by_page(rows, 2) == [""]
    assert len(set(by_page(rows, 3))) == 1
    assert html_crf.extract(pages.limit(0)).count() == 0


def by_page(rows, page_id):
    return [r["text"] for r in rows if r["page_id"] == page_id]


def test_decontaminate(spark, odd, none):
    items = spark.createDataFrame([(1, " ".join(PROSE.split()[10:40])), (2, None), (3, ""), (4, "one"), (4, "one")],
                                  "item_id long, text string").withColumn("leaks", F.lit(1))
    rows = decontaminate.leaks(odd, items).collect()
    assert {r["doc_id"] for r in rows if r["item_id"] == 1} == {None, 1, 2, 8, 11}
    assert {r["doc_id"] for r in rows if r["item_id"] == 4} == {6, 7}
    assert decontaminate.leaks(none, items).count() == 0 and decontaminate.leaks(odd, items.limit(0)).count() == 0


def test_secrets(odd, none):
    rows = secrets.scan(odd).collect()
    assert [x["kind"] for r in rows if r["doc_id"] == 11 for x in r["spans"]] == ["assign"]
    assert [(x["start"], x["end"]) for r in rows if r["doc_id"] == 9 for x in r["spans"] if x["kind"] == "hex"] == [(0, 300_000)]
    assert all(r["spans"] == [] for r in rows if r["doc_id"] in (1, 2, 3, 4, 5, 12))
    masked = secrets.redacted(odd, name="n_found")
    assert masked.columns == [*odd.columns, "n_found"]
    got = by_id(masked.where("doc_id IN (11, 3)").collect())
    assert got[11]["text"].startswith("[SECRET] ") and got[3]["text"] is None and got[11]["spans"] == "clash"
    assert secrets.scan(none).count() == 0 and secrets.redacted(none, name="n_found").count() == 0


def test_quality_rules(odd, none):
    rows = quality_rules.quality_rules(odd).collect()
    assert len(rows) == odd.count()
    got = by_id(rows)
    assert [got[i]["n_words"] for i in (3, 4, 5, 6)] == [0, 0, 0, 1] and got[10]["n_repeat_words"] == 50_000
    assert all(got[i]["base_failed"] and not got[i]["kept"] for i in (3, 4, 5, 6, 7, 8, 9, 10, 12))
    assert quality_rules.quality_rules(none).count() == 0


def test_url_filter(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://A.B.Net/x?y#z"), (5, "HTTP://A.B.Net/x?y#z"),
                                   (None, "x://net/" + "a." * 20_000), (6, "x://" + "a." * 20_000 + "net/"), (7, "a://net?/"), (8, "a://xnet/")],
                                  "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("rule", F.lit("clash"))
    rules = url_filter.rule_table(spark, [("net", "/", "block"), ("net", "/", "block"), ("b.net", "/x", "allow"), ("b.net", "/x", "block")])
    rows = url_filter.apply_rules(pages, rules).collect()
    assert len(rows) == 10
    got = {r["page_id"]: (r["path"], r["rule"], r["verdict"]) for r in rows}
    assert got[1] == got[2] == got[3] == got[4] == ("", None, "allow")
    assert got[5] == ("/x", "b.net/x", "block") and got[None][1:] == got[6][1:] == ("net/", "block")
    assert got[7] == ("", None, "allow") and got[8] == ("/", None, "allow")
    assert {r["verdict"] for r in url_filter.apply_rules(pages, rules.limit(0)).collect()} == {"allow"}
    assert url_filter.apply_rules(pages.limit(0), rules).count() == 0


def test_quality_fm(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (99, 1), (None, 1)], "doc_id long, quality int")
    model = quality_fm.train(odd, labels)
    rows = quality_fm.score(odd, model, ["doc_id"], name="p").collect()
    assert len(rows) == odd.count() and all(0 <= r["p"] <= 1 for r in rows)
    empty = quality_fm.train(odd, labels.limit(0))
    assert {r["p"] for r in quality_fm.score(odd, empty, ["doc_id"], name="p").collect()} == {0.5}
    assert quality_fm.score(none, model, ["doc_id"], name="p").count() == 0


def test_shards(odd, none):
    rows = shards.shard(odd).collect()
    assert len(rows) == odd.count()
    for k in range(16):
        slots = sorted(r["slot"] for r in rows if r["shard"] == k)
        assert slots == list(range(len(slots)))
    assert by_id(rows)[3]["size"] == 1 and shards.shard(none).count() == 0


def test_stages(spark, odd, none):
    """Every stage on the odd table and on an empty one keeps the columns."""
    sf = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, sf).columns == odd.columns, name
        assert stage(spark, none, sf).count() == 0, name
    near = corpus_pipeline.keep_one_of_near_copies(spark, odd, sf).collect()
    assert sorted(str(r["doc_id"]) for r in near) == sorted(["1", "None", "None", "3", "4", "5", "6", "9", "10", "11", "12"])  # 8 repeats 1
    masked = by_id(corpus_pipeline.mask_secrets(spark, odd, sf).collect())
    assert masked[11]["n_chars"] == len(masked[11]["text"]) and masked[3]["n_chars"] is None and masked[1]["n_chars"] == len(PROSE)
    assert corpus_pipeline.tokens(spark, odd, sf).count() == odd.count()
