import pytest

ODD = [
    (1, None, "en", "s", 0),
    (2, "", "en", "s", 0),
    (3, " \n\t ", None, None, 0),
    (4, "the same words in a short text of twelve words or so then", "en", "s", 0),
    (4, "the same words in a short text of twelve words or so then", "en", "s", 0),
    (5, "the same words in a short text of twelve words or so then", "fr", "s", 0),
    (None, "a text without an id that still has a good many words in it", "xx", "t", 0),
    (7, "<|endoftext|> </s> \\ 　 \x1c é́ \U0001f600 'S 12½", "de", "t", 0),
    (8, " ".join(f"word{i % 977} and{i}" for i in range(30_000)), "en", "s", 0),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for themselves or add.
CLASHES = (
    "_words _text _row row q of lang_of host drop fingerprint_of root smallest u v leak_of at n "
    "anchor content ident mark again page covered _size _key0 _bucket _node parts kept"
).split()


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, ties, repeated rows and a very long text."""
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(spark, odd):
    """The same with more columns, named as operators' own."""
    from pyspark.sql import functions as F

    return odd.withColumns({name: F.concat(F.lit(name), F.col("doc_id")) for name in CLASHES})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
