"""What the pipeline's stages take of the driver."""

import random
import tracemalloc

from pyspark.sql import functions as F

from tokenmill.llm import components, language_crf


def _roots(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in root if find(n) != n}


def test_components_of_awkward_graphs(spark):
    rnd = random.Random(9)
    star = [(50, n) for n in range(100) if n != 50]
    path = list(zip(range(200, 240), range(201, 241)))
    for links in ([(1, 1)], star, path, [*star, *path, (99, 240)], [(rnd.randrange(-60, 60), rnd.randrange(-60, 60)) for _ in range(70)]):
        df = spark.createDataFrame(links * 2, "a long, b long")
        assert {r.node: r.root for r in components.connected(df).collect()} == _roots(links)


def test_a_round_of_stars_reads_its_edges_four_times(spark):
    edges = spark.range(1000).select((F.col("id") + 1).alias("u"), "id").toDF("u", "v")
    plan = components._stars(components._stars(edges, True), False)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 4 and "Union" not in plan


def test_training_holds_no_hashes_of_the_whole_sample():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(60)) for _ in range(500)]
    texts = [" ".join(rnd.choice(words) for _ in range(100)) for _ in range(600)]
    language_crf.forget_powers()
    tracemalloc.start()
    language_crf.train(texts, [("x", "y")[i % 2] for i in range(len(texts))])
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    language_crf.forget_powers()
    assert most < 25 * sum(map(len, texts)), most / sum(map(len, texts))
