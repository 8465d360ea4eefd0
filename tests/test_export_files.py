"""Many small files: written and read back without work per file that grows beyond the file."""

import pyarrow as pa
from pyspark.sql import Row

import __spark_entry__ as entry
from webcapture.sources import writers


def _documents(spark, path):
    rows = [(1, "a\r\nÜ\n", "en", "web", 5), (2, None, "de", "web", None), (3, "", None, None, 0), (4, "  x", "fr", "b", 3), (4, "other", "fr", "b", 3), (7, "no", "en", "b", 2)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")


def test_files_come_back_as_they_were_written(spark, tmp_path):
    """Of the two texts of one name the last is there; a failed row has no file. No reader of whole texts, with a job per file."""
    _documents(spark, str(tmp_path))
    found = entry.queries()["write_exports_files"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content:binary" in plan and "Scan text" not in plan
    got = {r.export_name: r.export_text for r in found.collect()}
    assert found.columns == ["export_name", "export_text"] and found.schema["export_text"].dataType.simpleString() == "string"
    assert sorted(got) == [f"exports/doc{i}.md" for i in (1, 2, 3, 4)]
    assert got["exports/doc4.md"].endswith("---\n\nother\n" if "other" > "  x" else "---\n\n  x\n")
    head = "## title: {}\n## description: {}\n## url: https://docs.example/{}\n## language: {}\n## creditsUsed: {}\n\n---\n\n{}\n"
    assert got["exports/doc1.md"] == head.format("web", "", 1, "en", "", "a\r\nÜ\n") and got["exports/doc3.md"] == head.format("", "", 3, "", 0, "")


def test_a_folder_is_made_once_in_a_row(tmp_path, monkeypatch):
    made = []

    class Folder:
        def __init__(self, own):
            self.own = own

        def __getattr__(self, name):
            return getattr(self.own, name)

        def create_dir(self, path, recursive):
            made.append(path)
            self.own.create_dir(path, recursive=recursive)

    own = writers.fs.LocalFileSystem()
    monkeypatch.setattr(writers.fs, "FileSystem", type("", (), {"from_uri": staticmethod(lambda uri: (Folder(own), uri))}))
    batch = pa.RecordBatch.from_pylist([Row(export_name=f"{d}/{i}.md", export_text="x").asDict() for d in "ab" for i in range(5)])
    assert [b.to_pydict() for b in writers._files(str(tmp_path))(iter([batch]))] == [{"written": [10]}]
    assert made == [f"{tmp_path}/a", f"{tmp_path}/b"] and len(list(tmp_path.glob("*/*.md"))) == 10
