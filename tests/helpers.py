"""Small helpers for tests."""


def values(df, *columns):
    """Rows as sorted tuples of the given columns, or all."""
    names = columns or df.columns
    rows = [tuple(r) for r in df.select(*names).collect()]
    return sorted(rows, key=lambda row: tuple((x is None, str(x)) for x in row))


def column(spark, inputs, expression, type_name="string"):
    """Value of an expression over column ``c``, one result per input in order."""
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, c {type_name}")
    return [r["out"] for r in df.select("i", expression.alias("out")).orderBy("i").collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
