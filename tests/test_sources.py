"""CSV and catalog sources."""

from __future__ import annotations

import pytest

from plumbline.sources.catalog import load_by_id, load_dataset, load_datasets
from plumbline.sources.csv import NULL_TOKENS, read_csv
from plumbline.sources.registry import rulesets_from_documents


def write(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_csv_types_and_null_tokens(spark, tmp_path):
    path = write(tmp_path / "a.csv", [
        "i,f,b,s,code,e", "1,1.5,True,x,007,", "NA,inf,False,\"a, \"\"b\"\"\",1d,N/A", "3,,true, ,2,null",
    ])
    df = read_csv(spark, path)
    assert [t for _, t in df.dtypes] == ["bigint", "double", "boolean", "string", "string", "string"]
    assert [tuple(r) for r in df.collect()] == [
        (1, 1.5, True, "x", "007", None), (None, float("inf"), False, 'a, "b"', "1d", None),
        (3, None, True, " ", "2", None),
    ]


def test_every_null_token(spark, tmp_path):
    path = write(tmp_path / "n.csv", ["k,v", *[f"{i},{t}" for i, t in enumerate(NULL_TOKENS)], "99,Na"])
    assert [r["v"] for r in read_csv(spark, path).where("v is not null").collect()] == ["Na"]
    assert len(NULL_TOKENS) == 19
    assert read_csv(spark, path, null_tokens=["Na"]).where("v is null").count() == 2  # and the empty field


def test_csv_with_a_schema(spark, tmp_path):
    path = write(tmp_path / "s.csv", ["i,d,t,skip", "7,1/26/2026,x,1", "boom,2026-02-01,y,2"])
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("i int, d date, t string")
    assert [(r["i"], str(r["d"]), r["t"]) for r in read_csv(spark, path, schema).collect()] == [
        (7, "2026-01-26", "x"), (None, "2026-02-01", "y"),
    ]


def test_catalog(spark, tmp_path):
    df = spark.range(5).withColumnRenamed("id", "k")
    df.write.parquet(str(tmp_path / "p"))
    df.write.orc(str(tmp_path / "o"))
    df.write.json(str(tmp_path / "j"))
    write(tmp_path / "c.csv", ["k", "1", "2"])
    df.write.saveAsTable("catalog_test", mode="overwrite")
    entries = [
        {"dataset_id": d, "source_type": t, "source_location": loc}
        for d, t, loc in (("p", "Parquet", "p"), ("o", "orc", "o"), ("j", "json", "j"), ("c", "CSV", "c.csv"),
                          ("t", "table", "catalog_test"))
    ]
    loaded = load_datasets(spark, entries, str(tmp_path))
    assert {d: f.count() for d, f in loaded.items()} == {"p": 5, "o": 5, "j": 5, "c": 2, "t": 5}
    assert load_by_id(spark, entries, "c", str(tmp_path)).columns == ["k"]
    with pytest.raises(ValueError, match="Unsupported source_type"):
        load_dataset(spark, {"dataset_id": "x", "source_type": "xml", "source_location": "x"})
    with pytest.raises(KeyError):
        load_by_id(spark, entries, "zz")


def test_rule_set_documents():
    documents = [
        {"dataset_id": "d", "ruleset_version": 2, "rules": [{"rule_id": "A", "rule_type": "schema", "extra": 1}]},
        {"dataset_id": "d", "ruleset_version": 1, "rules": []},
        {"dataset_id": "e", "rules": [{"rule_id": "B", "rule_type": "range", "severity": "low",
                                       "expectation": {"min": 1}, "suggested_by": "x"}]},
    ]
    found = rulesets_from_documents(documents)
    assert found["d"].ruleset_version == 2
    assert (found["d"].rules[0].suggested_by, found["d"].rules[0].severity) == ("manual", "medium")
    assert found["e"].rules[0].expectation == {"min": 1}
