"""Small tables that hold the awkward rows every operator must take."""

LONG = "lorem ipsum dolor " * 40_000

TEXTS = [None, "", "   \n\t ", "one", "one", "Ünïcödé 日本語 😀 text", LONG, LONG,
         "a b c d e f g h i j k l m n", "A B C d e f g h i j k l m n"]


def documents(spark, texts=TEXTS, ids=None):
    """Documents with repeated and null ids, null members and columns whose names
    the operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, None if n % 3 == 0 else "en", f"src{n}", len(t) if t else None, "x", -1, "y", "z")
            for n, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, "
              "contamination string, bits int, secrets string, toxicity string")


def awkward(spark):
    """All texts, one id twice with one text, one id with two texts, two null ids."""
    return documents(spark, TEXTS, [0, 1, 2, 3, 3, 5, 6, 6, None, None])


def none(spark):
    return documents(spark, [], [])


def benchmark(spark, rows=()):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def pairs(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
