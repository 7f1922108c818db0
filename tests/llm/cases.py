"""Rows that every text operator must bear, and small readers."""

import duckdb

SF = "/root/testdata/sf0.001"

#: Nulls, empty, white space, long, repeated rows and ids, characters beyond the basic plane; columns with names used inside.
COLUMNS = "doc_id long, text string, lang string, node long, key string, block int, label int, n_lines int, score double, spans string, __text string"
LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
TEXTS = [
    (1, None),
    (2, ""),
    (3, "   \n \n"),
    (4, "The quick brown fox jumps over the lazy dog again and again.\nshort\nAnother line that is long enough to be compared."),
    (5, "The quick brown fox jumps over the lazy dog again and again.\nshort\nAnother line that is long enough to be compared."),
    (6, "The quick brown fox jumps over the lazy dog again and agaim.\nshort\nsomething else of no length at all, really not"),
    (6, "The quick brown fox jumps over the lazy dog again and agaim.\nshort\nsomething else of no length at all, really not"),
    (7, LONG),
    (None, "a row without an id"),
    (8, "ﬁ ▁ 𝒳 é́ \t tab  two  spaces \n\n token=abcdefgh12 <|endoftext|> "),
    (9, LONG + " tail"),
]


def edge_docs(spark):
    return spark.createDataFrame([(i, t, "en", 7, "k", 1, 0, 5, 0.5, "s", "clash") for i, t in TEXTS], COLUMNS)


def empty_docs(spark):
    return edge_docs(spark).limit(0)


def table(name, sf=SF):
    return duckdb.sql(f"select * from '{sf}/{name}.parquet'").fetchall()


def documents(sf=SF):
    return [(r[0], r[1] or "") for r in duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet' order by 1").fetchall()]


class Groups:
    """Union-find; a group's name is its least member."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
