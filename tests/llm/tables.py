"""Small tables with every awkward case, and plain versions of what the operators have to find."""

from __future__ import annotations

import pyspark.sql.types as T

LONG = " ".join(f"word{i % 977} other{i % 31}." for i in range(40_000))

#: Nulls, empty and very long texts, white space, ties, repeated rows and ids, odd characters.
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (2, "the QUICK brown fox jumps over the lazy dog near the river bank today."),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "word"),
    (7, LONG),
    (7, LONG),
    (8, "éß漢字 'tis 12½ a b\r\nc  d\u0000e ▁x <s> ''' don't"),
    (8, "the same id with another text"),
    (9, "\n\n double  spaces \n and breaks\n"),
    (None, "a row without an id"),
    (None, None),
    (10, "x" * 5000),
]

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for columns of their own.
        *(T.StructField(name, T.StringType()) for name in ("fingerprint", "member", "label", "ids", "score", "_score", "key", "u", "slot", "_slot")),
    ]
)


def documents(spark, rows=None):
    rows = TEXTS if rows is None else rows
    more = ("clash",) * (len(DOCS) - 5)
    langs = (None, "en", "de")
    values = [(i, t, langs[n % 3], None if n % 4 == 0 else f"s{n % 4}", None if t is None else len(t), *more) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(values, DOCS)


VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        *(T.StructField(name, T.StringType()) for name in ("vector", "list", "digest", "links", "node")),
    ]
)


def vectors(spark, rows):
    return spark.createDataFrame([(*row, *("clash",) * 5) for row in rows], VECTORS)


def smallest_reachable(ids, linked):
    """Component of each id by plain union of all linked pairs."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
