from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions.text import clean_lines, html_to_text, term_counts
from shelfmark.operators.extract import extract_text, join_pages
from shelfmark.plans.ingest import extract_files
from shelfmark.session import arrow_batch_rows
from shelfmark.sources.files import scan_files
from shelfmark.sources.tables import read_questions


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t")).alias("x")).first().x


def test_term_counts(spark):
    got = one(spark, "The cat, the CAT; a été 42!", term_counts)
    assert [(r.term, r.tf) for r in got] == [("42", 1), ("a", 1), ("cat", 2), ("the", 2), ("été", 1)]
    assert one(spark, "?!", term_counts) == []
    assert one(spark, None, term_counts) is None


def test_html(spark):
    page = "<html><head><title>x</title></head><body><script>var a='<p>';</script><p>One&nbsp;&amp;lt; two<br>three</p><!-- no --></body>"
    assert one(spark, page, html_to_text) == "One &lt; two\nthree"


def test_clean_lines(spark):
    text = "Intro text\n1 ...... 3\n\nIntro text\nBody of it\n---"
    assert one(spark, text, clean_lines) == "Intro text\nBody of it"
    assert one(spark, " 0 zero is kept\n 1 one is kept ", clean_lines) == "0 zero is kept\n1 one is kept"


def test_join_pages_in_order(spark):
    rows = [(1, n, f"p{n}") for n in (2500, 3, 1001, 1, 2)] + [(2, 1, None), (2, 2, "b")]
    got = {r.doc: r.text for r in join_pages(spark.createDataFrame(rows, "doc int, page_no int, text string"), "doc").collect()}
    assert got == {1: "p1\np2\np3\np1001\np2500", 2: "b"}


def write_files(tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "top.txt").write_bytes("tête\n".encode())
    (tmp_path / "a" / "empty.txt").write_bytes(b"")
    (tmp_path / "a" / "bad.txt").write_bytes(b"\xff\xfe\x00")
    (tmp_path / "a" / "b" / "page.html").write_bytes(b"<p>Hello <b>you</b></p>")
    return str(tmp_path)


def test_scan_and_extract(spark, tmp_path):
    files = scan_files(spark, write_files(tmp_path))
    got = {r.path.rsplit("/", 1)[1]: (r.text, r.error) for r in extract_text(files).collect()}
    assert got == {"top.txt": ("tête\n", None), "bad.txt": (None, "not valid UTF-8"), "page.html": ("Hello you", None)}
    assert scan_files(spark, str(tmp_path), "*.html").count() == 1
    plan = files.where("path like '%top%'").select("path", "length")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_failing_extractor(spark, tmp_path):
    def make():
        def pages(content: bytes):
            if content.startswith(b"\xff"):
                raise ValueError("broken")
            return [content.decode(), "end"]

        return pages

    texts, rejects = extract_files(scan_files(spark, write_files(tmp_path)), make)
    assert texts.count() == 2
    assert [r.error for r in rejects.collect()] == ["ValueError: broken"]
    assert any(r.text == "tête\n\nend" for r in texts.collect())


def test_arrow_batch_setting_is_restored(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    with arrow_batch_rows(spark, 10):
        assert spark.conf.get(name) == "10"
    assert spark.conf.get(name, None) == before


def test_question_csv(spark, tmp_path):
    path = tmp_path / "questions.csv"
    path.write_bytes(
        'question,ground_truth,evolution_type,episode_done\r\n"What, then?","One, two; it’s ""three""",simple,TRUE\r\n'
        "Why?,Because,reasoning,TRUE\r\n\r\n".encode()
    )
    rows = read_questions(spark, str(path)).collect()
    assert len(rows) == 2 and rows[1].ground_truth == "Because" and rows[0].episode_done is True
