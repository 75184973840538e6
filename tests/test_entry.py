"""The driver's contract."""

import os

import pytest

import __spark_entry__ as entry


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.exists(entry.SMOKE_DIR), reason="no driver tables here")
def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "context", "target_text"] and df.count() > 0


@pytest.mark.skipif(not os.path.exists(entry.SMOKE_DIR), reason="no driver tables here")
@pytest.mark.parametrize("name", ["context_pairs", "split_per_lang", "lexical_richness", "tfidf_cosine", "lang_bucket", "weighted_mix", "mail_export", "chat_export", "social_export", "chat_dates", "tree_rewrite", "generated_answers"])
def test_against_sql(spark, name):
    import glob

    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{entry.SMOKE_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = entry.queries()[name](spark, entry.SMOKE_DIR)
    found = con.execute(entry.oracle_sql()[name])
    at = [[d[0] for d in found.description].index(c) for c in df.columns]
    plain = lambda row: tuple(round(v, 5) if isinstance(v, float) else v for v in row)
    assert sorted(map(plain, df.collect()), key=repr) == sorted((plain(tuple(r[i] for i in at)) for r in found.fetchall()), key=repr)


def test_a_failing_import_of_the_subpackage_leaves_the_rest():
    """The core queries stay when the subpackage for training corpora can't be imported."""
    import subprocess
    import sys

    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; q = e.queries(); assert 'context_pairs' in q and 'op6_minhash' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(entry.__file__))
