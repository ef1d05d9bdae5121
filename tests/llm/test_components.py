import random

from pricepanel.llm.components import connected_components, spanning_stars


def test_paths_hubs_and_random_graphs(spark):
    rnd = random.Random(3)
    path = list(range(1500))
    rnd.shuffle(path)
    edges = list(zip(path, path[1:]))
    edges += [(5000, 6000 + i) for i in range(800)] + [(9000 + rnd.randrange(400), 9000 + rnd.randrange(400)) for _ in range(260)]
    edges += [(-7, -9), (-9, -8), (20_000, 20_000)] + edges[:50]
    rnd.shuffle(edges)
    want = spanning_stars([e for e in edges if e[0] != e[1]])
    # one edge a batch: nothing is contracted before the rounds
    for n, batch in ((8, "10000"), (40, "7")):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        df = spark.createDataFrame(edges, "a long, b long").repartition(n)
        got = [tuple(r) for r in connected_components(df, "a", "b").collect()]
        assert len(got) == len(set(got)) and dict(got) == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert connected_components(df.filter("false"), "a", "b").count() == 0
