"""Sources, sinks, persistence and the streaming scorer."""
import os
import re

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from conftest import SF001
from duelframe.operators import model as mo
from duelframe.plans.pipeline import ContestPipeline
from duelframe.plans.report import save_artifacts
from duelframe.sources.io import read_features, write_features, write_table
from duelframe.streaming.scoring import start_scoring


def _p(spark):
    return ContestPipeline.for_input(spark, SF001)


def test_clean_parquet_and_csv_round_trip(spark, tmp_path):  # O4
    clean = _p(spark).clean()
    write_table(clean, str(tmp_path / "clean"))
    back = spark.read.parquet(str(tmp_path / "clean"))
    assert back.count() == clean.count() and back.columns == clean.columns
    write_table(clean.select("bout_id", "Winner", "RedOdds"), str(tmp_path / "csv"), fmt="csv")
    csv = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert csv.count() == clean.count()


def test_feature_table_partitioned_by_year(spark, tmp_path):  # O5
    feats = _p(spark).features()
    path = str(tmp_path / "features")
    write_features(feats, path)
    assert sorted(d for d in os.listdir(path) if d.startswith("year="))[0] == "year=1995"
    sub = read_features(spark, path, "1998-01-01", "1998-12-31")
    plan = sub._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*year[^\]]*>= 1998", plan), plan
    assert sub.count() == feats.filter(F.year("Date") == 1998).count()


def test_artifacts_saved_and_reloaded(spark, tmp_path):  # O6, O7, O86
    p = _p(spark)
    doc = save_artifacts(p, str(tmp_path))
    row = doc.first()
    assert row.feature_count == len(p.feature_cols())
    assert row.split_info.train_rows + row.split_info.test_rows == 15000
    assert len(row.model_metrics.confusion_matrix) == 2
    js = spark.read.json(str(tmp_path / "reports" / "metrics"))
    assert js.count() == 1
    reloaded = PipelineModel.load(str(tmp_path / "models" / "full_model"))
    m2 = mo.FittedModel(reloaded, p.feature_cols(), 0)
    a = {r.bout_id: r.score for r in p.full_scored().collect()}
    b = {r.bout_id: r.score for r in m2.score(p.test()).collect()}
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-12
    assert spark.read.parquet(str(tmp_path / "models" / "feature_manifest")).count() == len(p.feature_cols())


def test_streaming_scorer_matches_batch(spark, tmp_path):
    p = _p(spark)
    src = tmp_path / "incoming"
    raw = p.raw()
    test_ids = p.test().select("bout_id")
    incoming = raw.join(test_ids, "bout_id", "left_semi")
    incoming.repartition(3).write.parquet(str(src))
    q = start_scoring(spark, str(src), raw.schema, p.vocab(), p.full_model(), str(tmp_path / "out"),
                      query_checkpoint=str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(300)
    streamed = {r.bout_id: r.score for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = {r.bout_id: r.score for r in p.full_scored().collect()}
    assert streamed.keys() == batch.keys()
    assert max(abs(streamed[k] - batch[k]) for k in batch) < 1e-12


def test_stage_publish_is_first_writer_wins(spark, tmp_path):
    from duelframe.sources.stages import POINTER, _publish, _published
    target = str(tmp_path / "stage")
    first = _publish(spark, spark.range(5), target)
    assert _publish(spark, spark.range(7), target) == first    # a second builder loses quietly
    assert _published(spark, target) == first and spark.read.parquet(first).count() == 5
    left = {p.name for p in (tmp_path / "stage").iterdir() if not p.name.startswith(".")}
    assert left == {POINTER, first.rsplit("/", 1)[1]}          # and leaves nothing behind


def test_a_table_without_pointer_is_not_read(spark, tmp_path):
    from duelframe.sources.stages import POINTER, _published
    spark.range(5).write.parquet(str(tmp_path / "stage" / "data-x"))
    assert _published(spark, str(tmp_path / "stage")) is None
    (tmp_path / "stage" / POINTER).write_text("")              # its writer has not finished
    assert _published(spark, str(tmp_path / "stage")) is None


def test_a_pointer_of_a_dead_builder_is_passed_over(spark, tmp_path):
    from duelframe.sources.stages import POINTER, _publish, _published
    target = tmp_path / "stage"
    target.mkdir()
    (target / POINTER).write_text("")                          # two builders died before they wrote the name
    (target / f"{POINTER}-1").write_text("")
    first = _publish(spark, spark.range(5), str(target))
    assert _publish(spark, spark.range(7), str(target)) == first == _published(spark, str(target))
    assert spark.read.parquet(first).count() == 5
    left = {p.name for p in target.iterdir() if not p.name.startswith(".")}
    assert left == {POINTER, f"{POINTER}-1", f"{POINTER}-2", first.rsplit("/", 1)[1]}


def test_stage_signature_follows_input_and_config(spark, tmp_path, monkeypatch):
    from duelframe import config
    from duelframe.sources import stages
    spark.range(5).write.parquet(str(tmp_path / "orders.parquet"))
    one = stages.signature(spark, str(tmp_path), ["orders", "part"])
    assert one == stages.signature(spark, str(tmp_path), ["orders", "part"])
    spark.range(6).write.mode("append").parquet(str(tmp_path / "orders.parquet"))
    two = stages.signature(spark, str(tmp_path), ["orders", "part"])
    changed = tmp_path / "config.py"
    changed.write_text("# other")
    monkeypatch.setattr(config, "__file__", str(changed))
    assert len({one, two, stages.signature(spark, str(tmp_path), ["orders", "part"])}) == 3


def test_stage_that_cannot_be_written_fails(spark, tmp_path, monkeypatch):
    import pytest
    from duelframe.sources import stages
    blocker = tmp_path / "file"
    blocker.write_text("x")                         # a file where a folder is needed
    monkeypatch.setattr(stages, "checkpoint_dir", lambda s: str(blocker))
    with pytest.raises(Exception):
        stages.stage(spark, "raw", SF001, ["orders"], lambda: spark.range(3)).count()


def test_csv_text_as_pandas_reads_it(spark, tmp_path):
    import pandas as pd
    import pytest
    from duelframe.sources.io import CsvTextError, read_raw_csv
    rows = pd.DataFrame({"a": [1, 2, 3], "t": ['he said "hi", then left', "two\nlines", "plain"], "z": ["x", "y", "z,\"q\""]})
    path = tmp_path / "t.csv"
    rows.to_csv(path, index=False)
    got = read_raw_csv(spark, str(path), multi_line=True).toPandas()
    assert got.values.tolist() == pd.read_csv(path).values.tolist()
    with pytest.raises(CsvTextError):
        read_raw_csv(spark, str(path))
    rows.iloc[[0, 2]].to_csv(path, index=False)
    assert read_raw_csv(spark, str(path)).toPandas().values.tolist() == pd.read_csv(path).values.tolist()


def test_several_files_without_a_key_are_numbered_by_path_and_place(spark, tmp_path):
    import pytest
    from duelframe.sources.io import read_contests, with_row_key
    for name, text in (("a.csv", "x\n1\n"), ("b.csv", "x\n2\n3\n")):
        (tmp_path / name).write_text(text)
    got = read_contests(spark, str(tmp_path)).collect()
    assert sorted((r["bout_id"], r["x"]) for r in got) == [(0, 1), (1, 2), (2, 3)]
    assert [r["bout_id"] for r in read_contests(spark, str(tmp_path / "b.csv")).collect()] == [0, 1]
    with pytest.raises(ValueError, match="key"):  # an id that follows the scan would depend on its splits
        with_row_key(spark.read.csv(str(tmp_path), header=True))


def test_checkpoint_folder_only_local_masters_go_without(spark, monkeypatch):
    import pytest
    from duelframe import session
    monkeypatch.setattr(session, "checkpoint_dir", lambda s: None)
    assert session.ensure_checkpoint_dir(spark)  # local[*]: a folder of its own

    class Cluster:
        class sparkContext:
            master = "spark://host:7077"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster())


def test_raw_stage_is_clustered_by_date_within_files(spark):
    import pyarrow.parquet as pq
    files = _p(spark).raw().inputFiles()
    assert files
    t = pq.read_table(files[0].replace("file://", "").replace("file:", ""), columns=["Date", "bout_id"])
    keys = list(zip(t.column("Date").to_pylist(), t.column("bout_id").to_pylist()))
    assert keys == sorted(keys)
