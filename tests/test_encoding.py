import pytest

from adtally.operators import encoding as E

ROWS = [
    ("train", 1, 1, 5, 1.0), ("train", 1, 0, 5, 2.0), ("train", 2, 1, 7, None), ("train", None, 0, None, 10.0),
    ("validation", 2, 0, 9, None), ("test", 9, 1, None, 3.0), ("test", 1, 1, 7, 4.0), ("test", None, 1, 5, 5.0),
]


def table(spark):
    return spark.createDataFrame(ROWS, "split string, campaign long, click int, cat long, x double")


def test_campaign_rates_and_fallback(spark):
    rows = E.encode_campaign(table(spark), label_col="click").collect()
    found = {(r.split, r.campaign): r.campaign_ctr for r in rows}
    assert found[("train", 1)] == 0.5 and found[("validation", 2)] == 1.0
    assert found[("test", 9)] == 0.5 and found[("test", None)] == 0.5 and found[("train", None)] == 0.5


def test_metadata(spark):
    row = E.encoding_metadata(table(spark), label_col="click").first()
    assert (row.global_prior, row.train_groups) == (0.5, 2)
    assert (row.validation_unseen_rows, row.validation_unseen_rate) == (0, 0.0)
    assert (row.test_unseen_rows, row.test_unseen_rate) == (2, pytest.approx(2 / 3))
    only_train = E.encoding_metadata(table(spark).filter("split = 'train'"), label_col="click").first()
    assert only_train.test_unseen_rate is None and only_train.test_unseen_rows == 0


def test_imputation_uses_training_rows(spark):
    rows = E.impute(table(spark), numeric=["x"], categorical=["cat"]).collect()
    assert sorted(r.x for r in rows) == [1.0, 2.0, 2.0, 2.0, 3.0, 4.0, 5.0, 10.0]
    assert [r.cat for r in rows if r.split == "train"].count(5) == 3


def test_most_frequent_prefers_the_smaller_value(spark):
    df = spark.createDataFrame([(3, None), (2, None), (3, None), (2, None)], "a long, b long")
    assert E.most_frequent(df, ["a", "b"]) == {"a": 2, "b": None}


def test_ordinal_codes(spark):
    rows = E.ordinal_encode(table(spark), ["cat", "campaign"]).collect()
    codes = {(r.split, r.x): (r.cat, r.campaign) for r in rows}
    assert codes[("train", 1.0)] == (0, 0) and codes[("train", None)] == (1, 1)
    assert codes[("validation", None)] == (-1, 1) and codes[("test", 3.0)] == (-1, -1)
