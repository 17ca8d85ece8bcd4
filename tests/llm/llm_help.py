"""Paths and helpers of the text-operator tests."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def frame(spark, rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
    width = len(schema.split(","))
    return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)


def union_find(items, links):
    up = {i: i for i in items}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}
