"""Small inputs that every operator must take, and the whole small tables."""

import re

import duckdb

SF_DIR = "/root/testdata/sf0.001"
ODD_TEXTS = [
    None, "", " \n\t ", "one", "a b c", "a b c", "a\x1cb \x85c\xa0d", "É é é İ ß ς", "日本語 テキスト",
    "A <|endoftext|> b<|startoftext|>c", "don't WE'LL 12a3 x--y", "w\n" * 70, "lorem ipsum dolor sit amet " * 4000,
    "z" * 30000, "\x00 \x7f #*$%&|<>", "lorem ipsum dolor sit amet " * 4000,
]


def texts(sf_dir=SF_DIR):
    return dict(duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall())


def odd_documents(spark):
    """Nulls in every column, repeated rows and ids, extra columns whose names clash."""
    rows = [(i, t, "en", f"src{i % 3}", len(t or ""), 1.0, "x") for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[3], rows[4], (None, "a b c", None, None, None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score double, n_tokens string")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
