import pytest


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source, n_chars): null columns, empty and long texts, ties, repeats."""
    long = " ".join(f"w{i * 7919 % 3001}" for i in range(6000))
    prose = [" ".join(f"{c}{i * 31 % 97}" for i in range(k)) for c, k in (("a", 80), ("b", 140), ("c", 60))]
    rows = [(1, prose[0], "en", "s1", 1), (2, prose[0], "en", "s1", 1), (3, prose[0] + " tail", None, "s2", None), (4, None, "en", "s1", 0),
            (5, "", "en", None, 0), (6, " \n\t ", None, None, None), (7, prose[1] + " " + prose[2], "de", "s2", 5), (8, "x y " + prose[2] + " z", "de", "s2", 5),
            (8, "x y " + prose[2] + " z", "de", "s2", 5), (None, prose[1], "fr", "s3", 3), (9, long, "en", "s1", 9), (10, "one two", "en", "s3", 7),
            (11, "ÉTÉ été x <|im_end|> " + prose[1], "fr", "é", 2), (12, long + " more", "en", "s1", 9), (13, "a\nb\n\na\nb\n", "en", "s1", 8)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows with extra columns whose names operators use themselves."""
    df = spark.createDataFrame(odd_rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    from pyspark.sql import functions as F

    for c in ("h", "size", "shard", "piece", "score", "band", "component", "row", "n", "start", "sequence_id"):
        df = df.withColumn(c, F.lit("extra"))
    return df.repartition(3).cache()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("false")
