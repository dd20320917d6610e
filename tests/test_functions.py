import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from courtside.functions import (blank_default, extract, flatten, guarded_ratio, nullif_ratio, parse_raw,
                                 placeholder_label, status_bucket, surrogate_key)
from tests.conftest import rows


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def test_surrogate_key_null_and_empty_parts(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "1"), (1, "")], "k long, s string")
    out = dict(((r.k, r.s), r.key) for r in df.select("k", "s", surrogate_key("k", "s").alias("key")).collect())
    assert out[(1, "a")] == md5("1-a")
    assert out[(1, None)] == md5("1-_dbt_utils_surrogate_key_null_")
    assert out[(None, "1")] == md5("_dbt_utils_surrogate_key_null_-1")
    assert out[(1, "")] == md5("1-")
    assert len(set(out.values())) == 4


def test_blank_default(spark):
    df = spark.createDataFrame([(None,), ("",), ("12:34",)], "m string")
    assert rows(df.select(blank_default("m").alias("m"))) == [("00:00",), ("00:00",), ("12:34",)]


def test_status_bucket_tolerant_and_strict(spark):
    df = spark.createDataFrame([("2023",), ("2024",), (None,), ("",), ("abc",)], "y string")
    got = [r[0] for r in df.select(status_bucket("y").alias("s")).collect()]
    assert got == ["Retired", "Active", "Active", "Active", "Active"]
    with pytest.raises(Exception):
        df.select(status_bucket("y", strict=True)).collect()


def test_ratios(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (1, None), (None, 4)], "n long, d long")
    got = [tuple(r) for r in df.select(guarded_ratio("n", "d"), nullif_ratio("n", "d")).collect()]
    assert got == [(0.5, 0.5), (0.0, None), (0.0, None), (None, None)]


def test_placeholder_label(spark):
    df = spark.createDataFrame([(7,)], "k long")
    assert df.select(placeholder_label("Unknown Player (", "k")).first()[0] == "Unknown Player (7)"


def test_flatten_edge_cases(spark):
    df = spark.createDataFrame([(1, "[]"), (2, None), (3, "not json"), (4, '{"a": 1, "b": 2}'),
                                (5, '[{"a": 1}, {"a": 2}]')], "id int, t string")
    flat = flatten(parse_raw(df, "t", "v"), "v", keep=["id"])
    assert rows(flat.select("id")) == [(4,), (4,), (5,), (5,)]


def test_typed_extraction(spark):
    docs = ['{"n": "18729", "f": 7.6, "t": "2026-03-21T10:11:12.123456", "s": "abc", "z": null}']
    df = parse_raw(spark.createDataFrame([(d,) for d in docs], "t string"), "t", "v")
    spec = [("n", "$.n", "int"), ("f", "$.f", "int"), ("t", "$.t", "timestamp_ntz"), ("missing", "$.q", "int"),
            ("z", "$.z", "string"), ("fd", "$.f", "float")]
    r = extract(df, "v", spec).first()
    assert r.n == 18729 and r.f == 8 and r.missing is None and r.z is None and r.fd == 7.6
    assert r.t == dt.datetime(2026, 3, 21, 10, 11, 12, 123456)
    bad = extract(df, "v", [("s", "$.s", "int")], tolerant=True).first()
    assert bad.s is None
    with pytest.raises(Exception):
        extract(df, "v", [("s", "$.s", "int")]).collect()
