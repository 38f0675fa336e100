"""Documents that every operator has to take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

LONG = "over and over. " * 3000
TEXTS = [None, "", " \n", "?!", "one", "eins zwei drei vier", "eins zwei drei vier", "1234 5678", "ab\tcd\x0bef gh",
         "Ça là où été", "日本 語", LONG, "word" * 4000]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, v int"


def edge_rows():
    rows = [(i, text, None if i % 3 == 0 else "en", None, None, "x", None, i) for i, text in enumerate(TEXTS)]
    return [*rows, rows[4], rows[11], (None, "no id", "en", None, None, None, None, None),
            (None, None, None, None, None, None, None, None)]


def edge_frame(spark):
    return spark.createDataFrame(edge_rows(), COLUMNS)


def empty_frame(spark):
    return spark.createDataFrame([], COLUMNS)


def documents(spark, sf_dir):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
