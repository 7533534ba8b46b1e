from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions import html_title, html_to_text, parse_order_id, terms, words
from ledgerloom.sources import landing_files, read_bronze, read_documents, read_table
from ledgerloom.streaming import ingest_files

SCHEMA = StructType().add("id", "long").add("what", "string")


def values(spark, column, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return [r[0] for r in df.select(column(F.col("text"))).collect()]


def test_order_ids(spark):
    texts = [
        "is ORD-12 late?", "ORD-", "none", "ORD-" + "9" * 30, "WORD-7", "(ORD-3) ORD-4", None,
    ]
    assert values(spark, parse_order_id, *texts) == [12, None, None, None, None, 3, None]


def test_html(spark):
    page = (
        "<html><head><TITLE> A\n b </TITLE><script>var t='<p>';</script>"
        "<style>p{}</style></head><body><!-- x --><p>Tom &amp; <b>Jo</b></p></body></html>"
    )
    assert values(spark, html_to_text, page, "no tags") == ["A b Tom &amp; Jo", "no tags"]
    assert values(spark, html_title, page, "no tags") == ["A b", ""]


def test_words_and_terms(spark):
    assert values(spark, words, " A  b\tc\n", "") == [["A", "b", "c"], []]
    assert values(spark, terms, "Élan, ORD-12 élan!") == [["élan", "ord", "12", "élan"]]


def test_bronze_keeps_bad_lines_and_file_names(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "what": "x"}\nbroken\n')
    rows = read_bronze(spark, str(tmp_path), "json", SCHEMA).collect()
    assert {r["source_file"] for r in rows} == {"a.json"}
    assert sorted((r["id"] or 0, r["_corrupt_record"] or "") for r in rows) == [
        (0, "broken"), (1, ""),
    ]
    with pytest.raises(ValueError):
        read_bronze(spark, str(tmp_path), "json")


def test_tables_by_path_and_by_name(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "t"))
    read_table(spark, str(tmp_path / "t")).createOrReplaceTempView("four")
    assert read_table(spark, "four").count() == 4


def test_landing(spark, tmp_path):
    (tmp_path / "a.txt").write_text("abc")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "b.txt").write_text("x")
    (tmp_path / "empty.txt").write_text("")
    found = landing_files(spark, str(tmp_path)).collect()
    assert {(r["path"], r["file_name"], r["n_bytes"]) for r in found} == {
        ("a.txt", "a.txt", 3), ("deep/b.txt", "b.txt", 1), ("empty.txt", "empty.txt", 0),
    }


@pytest.mark.parametrize("folder", ["plain", "rules (v1)", "受発注 ルール", "a [b] 100%+"])
def test_documents_of_several_formats(spark, tmp_path, folder):
    tmp_path = tmp_path / folder
    tmp_path.mkdir()
    where = str(tmp_path) if "[" not in folder else str(tmp_path).replace("[", "\\[").replace("]", "\\]")
    (tmp_path / "rules").mkdir()
    (tmp_path / "rules" / "a.txt").write_text("Returns\nWithin 30 days.")
    (tmp_path / "b.md").write_text("# Terms")
    (tmp_path / "c.HTML").write_text("<title>T</title><p>Body</p>")
    (tmp_path / "d.bin").write_text("skip")
    (tmp_path / "発注 1.txt").write_text("発注")
    (tmp_path / "e.txt").write_text("")
    found = read_documents(spark, where).collect()
    rows = {r["doc_id"]: (r["title"], r["text"], r["format"]) for r in found}
    assert rows == {
        "rules/a.txt": ("Returns", "Returns\nWithin 30 days.", "plain"),
        "b.md": ("# Terms", "# Terms", "plain"),
        "c.HTML": ("T", "T Body", "html"),
        "d.bin": (None, None, "unknown"),
        "発注 1.txt": ("発注", "発注", "plain"),
        "e.txt": ("", "", "plain"),
    }


def write_json(path, *ids):
    path.write_text("".join(f'{{"id": {i}, "what": "w{i}"}}\n' for i in ids))


def test_each_file_is_ingested_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    args = (str(landing), str(tmp_path / "bronze"), str(tmp_path / "progress"), SCHEMA, "json")
    write_json(landing / "a.json", 1, 2)
    write_json(landing / "b.json", 3)
    assert ingest_files(spark, *args, files_per_batch=1).count() == 3
    write_json(landing / "c.json", 4)
    ingest_files(spark, *args)
    rows = ingest_files(spark, *args).collect()
    assert sorted((r["id"], r["source_file"]) for r in rows) == [
        (1, "a.json"), (2, "a.json"), (3, "b.json"), (4, "c.json"),
    ]
