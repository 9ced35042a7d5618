"""Small tables for the corpus operators."""

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, *texts, first=0, sources=None):
    """Documents with extra columns whose names operators use inside."""
    rows = [
        (first + i, t, "en", sources[i] if sources else f"src{i % 2}", None if t is None else len(t), i, "x", None)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCUMENTS + ", row int, key string, size long")


def as_rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)
