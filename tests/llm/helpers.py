"""Small tables for the edge cases all operators share."""

SCHEMA = "doc_id long, text string, lang string, n_words long, token long, gid long, block int, row string, kept string"


def documents(spark, texts, schema=SCHEMA):
    """Documents from (doc_id, text) pairs, with columns whose names operators use themselves."""
    rows = [(i, t, None, -1, -2, None, -3, "row", None) for i, t in texts]
    return spark.createDataFrame(rows, schema)


def words(start, n):
    return " ".join(f"w{i}" for i in range(start, start + n))
