"""Small tables that the tests of this folder share."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, bucket int, n int, key string, size string, norm string"


def documents(spark, rows):
    """(doc_id, text) rows as documents, with extra columns whose names operators use themselves."""
    full = [(i, t, "en", "src0", None if t is None else len(t), "k", 1, 2, "x", "s", "z") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_documents(spark):
    """NULLs in any column, empty and white texts, ties, repeated rows, a long text, odd characters."""
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "plain text of a few words here"), (5, "plain text of a few words here"),
        (5, "plain text of a few words here"), (None, "no id at all"), (None, None), (6, "é 中文 🤦🏼‍♂️    x"), (7, "\x00\x01 nul"),
        (8, "word " * 30000), (9, "x" * 20000), (10, "Tab\tand\nlines\r\n\r\nend"),
    ]
    df = documents(spark, rows)
    return df.unionByName(spark.createDataFrame([(11, "bare row", None, None, None, None, None, None, None, None, None)], SCHEMA))
