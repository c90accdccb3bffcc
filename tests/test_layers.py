"""Text layers, parts and their problems."""

import hashlib

from pyspark.sql import functions as F

from sparkledger.sources import layers as L
from sparkledger.sources import readers


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_pages_of_layers_and_identity_of_originals(spark, tmp_path):
    names = {"a.pdf": "%PDF scan", "a.txt": "one\ftwo\f \n", "s.txt": "sup", "b.pages.jsonl": '{"page": 3, "text": "three"}\n\n{"text": null}\n', "c.pdf": "no layer", "e.txt": "", "twin.txt": "sup", "xappendix.txt": "colon"}
    for name, text in names.items():
        (tmp_path / name).write_text(text)
    files = readers.files(spark, str(tmp_path)).withColumn("path", F.element_at(F.split("path", "/"), -1))
    parts = spark.createDataFrame([
        ("A", "a.pdf", "a.txt", "main", 0), ("A", "s.txt", None, "supplement", 1), ("A", "xappendix.txt", None, "odd", 2), ("A", "twin.txt", None, "appendix", 3),
        ("B", "b.pages.jsonl", None, "main", 0), ("C", "c.pdf", None, "main", 0), ("D", "a.pdf", "none.txt", "main", 0), ("E", "e.txt", None, "main", 0), ("F", "gone.txt", None, "main", 0),
    ], "doc string, path string, layer string, kind string, given int")
    pages, problems = L.layered_pages(parts, files)
    got = sorted((r["doc"], r["part"], r["page"], r["text"], r["sha256"], r["media_type"], r["text_layer"], r["text_layer_sha256"]) for r in pages.collect())
    scan = (sha(names["a.pdf"]), "application/pdf", "a.txt", sha(names["a.txt"]))
    assert got == [
        ("A", "main", 1, "one", *scan), ("A", "main", 2, "two", *scan), ("A", "supplement", 1, "sup", sha("sup"), "text/plain", None, None), ("A", "supplement_2", 1, "colon", sha("colon"), "text/plain", None, None),
        ("B", "main", 2, "", sha(names["b.pages.jsonl"]), "application/jsonl", None, None), ("B", "main", 3, "three", sha(names["b.pages.jsonl"]), "application/jsonl", None, None),
    ]
    assert sorted(map(tuple, problems.collect())) == [("A", "twin.txt", "given_twice"), ("C", "c.pdf", "no_pages"), ("D", "a.pdf", "no_layer"), ("E", "e.txt", "no_file"), ("F", "gone.txt", "no_file")]
    assert L.layered_pages(parts.limit(0), files)[0].count() == 0
    empty = files.limit(0).unionByName(spark.createDataFrame([("e.txt", 0, bytearray(), sha(""))], "path string, length long, content binary, sha256 string"))
    pages, problems = L.layered_pages(parts.where("doc = 'E'"), empty)
    assert pages.count() == problems.count() == 0


def test_specs_of_parts(spark):
    files = spark.createDataFrame([("s.txt",), ("C:x.pdf",), ("y:appendix",)], "path string")
    specs = spark.createDataFrame([("d", "s.txt: Appendix", 1), ("d", "C:x.pdf", 2), ("d", "z.txt:appendix", 3), ("d", "y:appendix", 4), ("d", "s.txt", 5), ("d", ":appendix", 6), ("d", None, 7)], "doc string, spec string, given int")
    got = [(r["path"], r["kind"]) for r in L.part_specs(specs, files).orderBy("given").collect()]
    assert got == [("s.txt", "appendix"), ("C:x.pdf", "supplement"), ("z.txt:appendix", "supplement"), ("y:appendix", "supplement"), ("s.txt", "supplement"), (":appendix", "supplement"), (None, "supplement")]
