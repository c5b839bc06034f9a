"""Both engines' rows of a query."""

DATA = "/root/testdata/sf0.001"


def duck(sf_dir=DATA):
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def same_rows(df, sql, sf_dir=DATA):
    """The rows of both engines as sorted tuples of text."""
    cols = sorted(df.columns)

    def text(v):
        return "NULL" if v is None else f"{v:.6f}" if isinstance(v, float) else str(list(v)) if isinstance(v, (list, tuple)) else str(v)

    ours = sorted(tuple(text(v) for v in r) for r in df.select(*cols).collect())
    got = duck(sf_dir).execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    return ours, sorted(tuple(text(r[i]) for i in order) for r in got.fetchall())
