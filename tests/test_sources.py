import base64
import gzip
import io
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.sources import documents as D
from millrace.sources import examples as X
from millrace.sources import store


def zipped(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        for name, data in parts.items():
            book.writestr(name, data)
    return out.getvalue()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("files")
    (at / "a.txt").write_text("hello é")
    (at / "b.csv").write_text("x,y\n1,2\n")
    (at / "c.html").write_text("<html><nav>skip</nav><p>Hi &amp; bye</p><script>x()</script><p>two</p></html>")
    (at / "d.md").write_text("# Title\n\nSome *bold* [link](http://x)\n")
    (at / "e.png").write_bytes(b"\x89PNG\r\n\x1a\n")
    w, a = 'xmlns:w="w"', 'xmlns:a="a" xmlns:p="p"'
    (at / "f.docx").write_bytes(zipped({"word/document.xml": f"<w:document {w}><w:body><w:p><w:r><w:t>One</w:t></w:r></w:p><w:p><w:r><w:t>Two</w:t></w:r></w:p></w:body></w:document>"}))
    slide = "<p:sld {a}><p:txBody><a:p><a:r><a:t>{t}</a:t></a:r></a:p></p:txBody></p:sld>"
    (at / "g.pptx").write_bytes(zipped({f"ppt/slides/slide{i}.xml": slide.format(a=a, t=f"S{i}") for i in (10, 2, 1)}))
    sheet = '<worksheet><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>3</v></c></row></sheetData></worksheet>'
    (at / "h.xlsx").write_bytes(zipped({"xl/worksheets/sheet1.xml": sheet, "xl/sharedStrings.xml": "<sst><si><t>a,b</t></si></sst>"}))
    (at / "bad.docx").write_bytes(b"no zip")
    return str(at)


def test_each_format(spark, folder):
    one = lambda df: df.first()["content"]
    assert one(D.text_files(spark, folder)) == "hello é"
    assert one(D.csv_files(spark, folder)) == "x,y\n1,2\n"
    assert one(D.html_files(spark, folder)) == "Hi & bye\ntwo"
    assert one(D.markdown_files(spark, folder)).strip() == "Title\n\nSome bold link"
    assert D.image_files(spark, folder).first()["content"] is None
    docx = {r["meta"]["file_path"]: r for r in D.office_files(spark, folder, "docx").collect()}
    assert docx["f.docx"]["content"] == "One\nTwo" and docx["bad.docx"]["content"] is None and "BadZip" in docx["bad.docx"]["meta"]["error"]
    assert one(D.office_files(spark, folder, "pptx")) == "S1\fS2\fS10"
    assert one(D.office_files(spark, folder, "xlsx")) == '"a,b",,3'


def test_all_formats_at_once(spark, folder):
    rows = {r["meta"]["file_path"]: r for r in D.any_files(spark, folder).collect()}
    assert len(rows) == 9 and rows["c.html"]["meta"]["mime"] == "text/html" and rows["g.pptx"]["content"].startswith("S1")
    assert len({r["id"] for r in rows.values()}) == 9


def test_json_data_uris_and_archives(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"laureates": [{"firstname": "A", "motivation": "m1"}, {"firstname": "B", "motivation": "m2"}]}')
    docs = D.json_records(spark, str(tmp_path / "x.json"), "laureates array<struct<firstname:string,motivation:string>>", "laureates", "motivation", ["firstname"])
    assert sorted((r["content"], r["meta"]["firstname"]) for r in docs.collect()) == [("m1", "A"), ("m2", "B")]
    uris = spark.createDataFrame([("data:text/plain;base64," + base64.b64encode(b"hi").decode(),), ("data:text/plain,a%20b",)], "u string")
    assert [bytes(r["content"]) for r in D.data_uris(uris, "u").collect()] == [b"hi", b"a b"]
    with tarfile.open(tmp_path / "t.tar.gz", "w:gz") as book:
        info = tarfile.TarInfo("in/one.txt")
        info.size = 3
        book.addfile(info, io.BytesIO(b"abc"))
    (tmp_path / "z.zip").write_bytes(zipped({"two.txt": b"de"}))
    assert sorted((r["member"], bytes(r["content"])) for r in D.archive_members(spark, str(tmp_path), "*.{tar.gz,zip}").collect()) == [("in/one.txt", b"abc"), ("two.txt", b"de")]


def test_example_readers(spark, tmp_path):
    (tmp_path / "s.tsv.gz").write_bytes(gzip.compress(b"a\tb\t5\nc\td\t2.5\n"))
    assert sorted((r["a"], r["score"]) for r in X.scored_pairs(spark, str(tmp_path / "s.tsv.gz")).collect()) == [("a", 1.0), ("c", 0.5)]
    for name, lines in (("1", "x\ny\nz\n"), ("2", "p\nq\n"), ("3", "neutral\nentailment\nneutral")):
        (tmp_path / name).write_text(lines)
    paths = [str(tmp_path / n) for n in "123"]
    assert [r["texts"] for r in X.parallel_lines(spark, paths[:2]).orderBy("line_no").collect()] == [["x", "p"], ["y", "q"]]
    assert [(r["a"], r["label"]) for r in X.inference_pairs(spark, *paths).orderBy("line_no").collect()] == [("x", 2), ("y", 1)]
    (tmp_path / "t.tsv").write_text("a\tb\tc\n")
    assert X.triplets(spark, str(tmp_path / "t.tsv")).first().asDict() == {"anchor": "a", "positive": "b", "negative": "c"}
    rows = spark.createDataFrame([(0, "z"), (1, "a"), (2, "z")], "pos int, label string")
    assert sorted((r["pos"], r["label_id"]) for r in X.labelled_sentences(rows, "pos", "label").collect()) == [(0, 0), (1, 1), (2, 0)]
    tagged = spark.createDataFrame([("I|O like|O London|I-GPE and|O New|B-GPE York|I-GPE City|B-LOC",)], "t string")
    assert [tuple(s) for s in tagged.select(X.iob_spans(F.col("t")).alias("s")).first()["s"]] == [(2, 3, "GPE"), (4, 6, "GPE"), (6, 7, "LOC")]


def test_store(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), spark.createDataFrame([(2, "c"), (3, "d"), (3, "d")], "id int, v string")
    got = lambda df: sorted(map(tuple, df.collect()))
    assert got(store.upsert(old, new, "id", "skip")) == [(1, "a"), (2, "b"), (3, "d")]
    assert got(store.upsert(old, new, "id", "overwrite")) == [(1, "a"), (2, "c"), (3, "d")]
    with pytest.raises(ValueError):
        store.upsert(old, new, "id", "fail")
    with pytest.raises(KeyError):
        store.delete(old, new, "id")
    assert got(store.delete(old, new.where("id = 2"), "id")) == [(1, "a")]
