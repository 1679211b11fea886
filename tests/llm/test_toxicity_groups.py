from plinth.llm import toxicity


def _groups(spark, sizes):
    return spark.createDataFrame([([0] * 6 + [-1, -1, 0, -1], [k // 100, k % 100], n) for k, n in enumerate(sizes)],
                                 "votes array<tinyint>, counts array<int>, n long")


def test_heavy_groups_always_train(spark):
    sizes = [1 + k % 2 for k in range(3000)]
    for k in range(0, 3000, 250):                       # wherever their hash puts them
        sizes[k] = 50_000 + k
    found = toxicity.training_groups(_groups(spark, sizes), 100)
    weight = {tuple(r.counts): r.weight for r in found}
    assert all(weight[k // 100, k % 100] == sizes[k] for k in range(0, 3000, 250))
    assert 12 + 50 < len(found) < 12 + 200 and len(weight) == len(found)
    assert abs(sum(weight.values()) - sum(sizes)) < 1e-3    # the sample stands for all the others


def test_few_groups_all_train(spark):
    found = toxicity.training_groups(_groups(spark, [7, 1, 1, 3]), 4)
    assert sorted(r.weight for r in found) == [1, 1, 3, 7]
    assert toxicity.training_groups(_groups(spark, [1]).limit(0)) == []
