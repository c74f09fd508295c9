"""Odd rows that every document operator must take: nulls, empty and long texts, repeats, clashing columns."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n_words long, score double, size long, "
          "part int, doc string, kept boolean, component_id string")


def odd_documents(spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon "
    texts = [
        (1, base * 4), (2, base * 4), (3, (base * 4).replace("xi", "xx", 1)), (4, None), (5, ""), (6, " \n\t "),
        (7, "one"), (8, "One"), (9, "word " * 30_000), (10, "\n".join([base] * 3)), (11, "### $$$ !!! ||| &&&"),
        (12, "é漢字 \U0001f600 ß x"), (None, "null id text"), (None, base * 4), (2, base * 4), (13, "a\r\nb\x0bc"),
    ]
    rows = [(i, t, None if k % 3 else "en", None if k % 4 == 0 else f"s{k % 3}", None, 7, 0.5, 3, 1, "d", True, "c")
            for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
