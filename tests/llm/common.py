"""Helpers of the corpus-operator tests: small frames, tables and oracle comparison."""

import duckdb

SF = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, texts, lang="en", source="s"):
    """Documents numbered from 0; a text may also be (doc_id, text) or (doc_id, text, lang, source)."""
    rows = []
    for i, t in enumerate(texts):
        i, t, la, so = (i, t, lang, source) if not isinstance(t, tuple) else (*t, lang, source)[:4] if len(t) == 2 else t
        rows.append((i, t, la, so, None if t is None else len(t)))
    return spark.createDataFrame(rows, DOC_SCHEMA)


def table_rows(spark, name, *cols):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*cols).collect()]


def duck(sql, sf=SF, **frames):
    """Rows of DuckDB SQL over the tables of ``sf``, some replaced by pandas frames."""
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        if t not in frames:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for t, f in frames.items():
        con.register(t, f)
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], [tuple(r[i] for i in order) for r in res.fetchall()]


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, [tuple(r) for r in df.select(*cols).collect()]


def same(got, want):
    def key(r):
        return [repr(round(x, 6)) if isinstance(x, float) else repr(x) for x in r]
    assert got[0] == want[0]
    assert sorted(map(key, got[1])) == sorted(map(key, want[1]))
