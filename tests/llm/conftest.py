from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators make or use inside, with values of other types than theirs.
CLASHING = {c: "x" for c in ("shard", "slot", "place", "fp", "component", "digest", "hits", "blob", "rules", "findings", "spans", "score", "lang_pred", "word", "lines", "h")}

ODD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (None, "a text without an id", "en", "a"),
    (None, "a text without an id", "en", "a"),
    (3, "the same text twice and the same id", "en", "b"),
    (3, "the same text twice and the same id", "en", "b"),
    (3, "one id and another text", "en", "b"),
    (4, " \n\t 12 ... ", "de", None),
    (5, "long " * 300_000 + "end", "en", "a"),
    (6, "x" * 1_500_000, None, "c"),
    (7, "Ünïcödé 𝔘𝔫𝔦 ﷽ \U0001f600 K İ ß", "de", "c"),
]


@pytest.fixture(scope="session")
def frame(spark):
    """(doc_id, text, lang, source) rows as a documents table; ``clash`` adds columns of clashing names."""
    from pyspark.sql import functions as F

    def make(rows, clash=False):
        df = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows], SCHEMA).repartition(3)
        return df.withColumns({c: F.lit(v) for c, v in CLASHING.items()}) if clash else df

    return make


@pytest.fixture(scope="session")
def odd(frame):
    return frame(ODD, clash=True)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def document_rows(documents):
    return [(r.doc_id, r.text, r.lang, r.source) for r in documents.collect()]
