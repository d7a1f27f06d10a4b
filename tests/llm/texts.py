"""Small documents with every odd case, and the given small table."""

SCHEMA = "doc_id long, text string, score double, row long, label string"
ODD = [
    (1, "A plain text, with some words.", 0.5, 1, "x"),
    (2, "", 0.5, 1, None),
    (3, None, None, None, None),
    (4, "  white \n\n space\t\r\n ", 0.5, 1, "x"),
    (5, "naïve 漢字かな 한국어 😀😀   ՘ x՘ ½²", 0.5, 1, "x"),
    (6, "a<|endoftext|>b  <|endoftext|>", 0.5, 1, "x"),
    (7, "word " * 30_000, 0.5, 1, "x"),
    (8, "x" * 70_000, 0.5, 1, "x"),
    (9, "same text", 0.5, 1, "x"),
    (10, "same text", 0.5, 1, "x"),
    (10, "same text", 0.5, 1, "x"),
    (10, "other text with the same id", 0.5, 1, "x"),
    (-5, "I'll don't we've 123456 ١٢٣", 0.5, 1, "x"),
    (None, "no id", 0.5, 1, "x"),
]
SMALL = "/root/testdata/sf0.001"


def odd(spark, rows=ODD):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def plain(rows=ODD):
    return [(r[0], r[1] or "") for r in rows]


def small(spark):
    return [(r[0], r[1] or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
