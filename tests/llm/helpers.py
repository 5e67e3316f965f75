"""Small inputs with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing names."""

import duckdb
import public_tokenizers

SF = "/root/testdata/sf0.001"
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

DOCS_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, length string, ids string, "
               "piece string, spans string, removed string, score string, stratum string, id string, key string, vector string")
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(9000))
TEXTS = [
    None, "", " ", "\n\n", "one", "a b c", "The cat sat on the mat. It's 12:30!\nThe cat sat.", LONG, LONG, LONG + " tail",
    "x<|endoftext|> y <|startoftext|>z", "tab\tand  two spaces \r\n end ", "Ünïcödé ñandú ßtraße É́ 日本語 テキスト 🙂🙂 1234",
    "ends with blank ", " nbsp em space\x1cfs\x85nel", "mail a.b@c.de, a@b@c.d.e and 1.2.3.4 or 1.2.3.4.5.6.7.8 999.1.1.1",
]


def documents(spark, texts=TEXTS, ids=None, empty=False):
    rows = [(i, t, "en" if i % 3 else None, f"s{i}", None) for i, t in enumerate(texts)]
    rows = [(ids[i] if ids else r[0], *r[1:]) for i, r in enumerate(rows)]
    if not ids:
        rows += [(None, "no id", "en", None, 5), (6, texts[6 % len(texts)], "en", "again", 1), (6, texts[6 % len(texts)], "en", "again", 1)]
    rows = [] if empty else rows
    return spark.createDataFrame([(*r, *["clash"] * 10) for r in rows], DOCS_SCHEMA)


def rows_of(name, sf=SF):
    return duckdb.sql(f"select * from '{sf}/{name}.parquet'").fetchall()


def texts_of(sf=SF):
    return {r[0]: r[1] for r in duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()}
