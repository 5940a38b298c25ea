"""Quoted CSV in blocks against pandas, cell by cell."""
import random

import pandas as pd
import pytest
from pyspark.sql import types as T

from duelframe.sources import csv_blocks as B
from duelframe.sources import io

NAMES = ["id", "name", "note"]


def text_of(rows, rng, end="\n"):
    def cell(v):
        if any(c in v for c in ',\n\r') or v.startswith('"') or rng.random() < 0.2:
            return '"' + v.replace('"', '""') + '"'
        return v
    lines = [",".join(NAMES)]
    for r in rows:
        lines.append(",".join(map(cell, r)))
        if rng.random() < 0.05:
            lines.append("")
    return end.join(lines) + (end if rng.random() < 0.5 else "")


def rows_of(rng, n, start=0):
    parts = ["a", 'x"y', "5'11\"", "two\nlines", ",", '"q"', "é漢", "\n\n", "", "end\"", "a,b\n\"c\",d", " "]
    return [(str(start + k), "n" + "".join(rng.choices(parts, k=rng.randrange(4))), "".join(rng.choices(parts, k=rng.randrange(6))) + "z")
            for k in range(n)]


def in_pandas(path):
    return [tuple(r) for r in pd.read_csv(path, dtype=str, keep_default_na=False).itertuples(index=False)]


@pytest.fixture
def split_bytes(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    old = {n: spark.conf.get(n, None) for n in names}

    def use(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")
        spark.conf.set(names[2], "1")
    yield use
    for n, v in old.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


@pytest.mark.parametrize("size", [97, 1000, 1 << 20])
def test_equals_pandas_at_every_split(spark, tmp_path, split_bytes, size):
    rng = random.Random(size)
    path = tmp_path / "t.csv"
    path.write_text(text_of(rows_of(rng, 150), rng), newline="")
    split_bytes(size)
    got = B.read_blocks(spark, str(path), NAMES)
    assert size > 5000 or got.rdd.getNumPartitions() > 3
    rows = sorted(got.collect())
    assert [r["row"] for r in rows] == list(range(150))
    assert [tuple(r)[1:] for r in rows] == in_pandas(path)


def test_keys_over_files_do_not_depend_on_splits(spark, tmp_path, split_bytes):
    rng = random.Random(4)
    for k, n in enumerate((40, 1, 0, 60)):
        (tmp_path / f"p{k}.csv").write_text(text_of(rows_of(rng, n, 1000 * k), rng), newline="")
    want = [r for k in range(4) for r in in_pandas(tmp_path / f"p{k}.csv")]
    seen = []
    for size in (61, 700, 1 << 20):
        split_bytes(size)
        seen.append(sorted(B.read_blocks(spark, str(tmp_path), NAMES, key="bout_id").collect()))
    assert seen[0] == seen[1] == seen[2]
    assert [(r["bout_id"], *tuple(r)[1:]) for r in seen[0]] == [(i, *r) for i, r in enumerate(want)]
    keyed = io.read_keyed_csv(spark, str(tmp_path))
    assert keyed.columns == ["bout_id", *NAMES] and keyed.count() == 101
    assert io.read_keyed_csv(spark, str(tmp_path), key="id").columns == NAMES


def test_one_record_over_many_blocks_and_open_end(spark, tmp_path, split_bytes):
    path = tmp_path / "t.csv"
    long = "\n".join(f"line {k}, \"\"x\"\"" for k in range(300))
    path.write_text(f'id,name,note\n1,"{long}",a\n2,b,c\n')
    split_bytes(100)
    assert sorted(tuple(r)[1:] for r in B.read_blocks(spark, str(path), NAMES).collect()) == sorted(in_pandas(path))
    path.write_text('id,name,note\n1,"never closed\n2,b,c\n')
    with pytest.raises(B.CsvTextError):
        B.read_blocks(spark, str(path), NAMES)


def test_literal_quotes_and_numbers_like_text(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('code,height,n,ok\n1d,5\'11",1.5,True\n2f,6\'0",-2e3,False\n3D,"5\'9""",.5,True\n')
    schema = {f.name: f.dataType for f in io.read_raw_csv(spark, str(path)).schema.fields}
    assert schema == {"code": T.StringType(), "height": T.StringType(), "n": T.DoubleType(), "ok": T.BooleanType()}
    want = pd.read_csv(path)
    for multi in (False, True):
        got = io.read_raw_csv(spark, str(path), multi_line=multi).toPandas()
        assert got.sort_values("code").values.tolist() == want.sort_values("code").values.tolist()
    declared = T.StructType([T.StructField("code", T.DoubleType()), T.StructField("height", T.StringType()),
                             T.StructField("n", T.DoubleType()), T.StructField("ok", T.BooleanType())])
    assert [r["code"] for r in io.read_raw_csv(spark, str(path), declared).collect()] == [None] * 3
