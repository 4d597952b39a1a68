"""Rows that every operator has to cope with."""

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))


def odd_rows():
    texts = [
        None, "", " \t\n", "x", "The same text twice, once more.", "The same text twice, once more.", LONG,
        "Große Straße über Äcker", "😀 emoji and a<|endoftext|>b", "a" * 3000, "   spaced   out   ", "1 2 3 4 5",
    ]
    rows = [(i, t, "en" if i % 2 else "de", "s0", len(t or "")) for i, t in enumerate(texts)]
    return rows + [(None, "no id here", None, None, None), (3, "x", "en", "s0", 1), (3, "x", "en", "s0", 1)]


def odd_documents(spark, *clashing):
    """The odd rows with extra columns of the given names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows(), DOCS).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in clashing})


def empty_documents(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
