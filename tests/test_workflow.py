from pyspark.ml import PipelineModel

from cabmetrics.plans import common as K
from cabmetrics.plans.workflow import run_workflow
from cabmetrics.schema import ModelProfile, TuningProfile
from cabmetrics.session import scratch_path


def test_workflow_end_to_end(spark, sf_small):
    out = scratch_path(spark, "wf")
    res = run_workflow(
        spark,
        K.raw_trips(spark, sf_small),
        out,
        models=ModelProfile(rf_num_trees=8, rf_max_depth=4, gbt_max_iter=4),
        tuning=TuningProfile(num_trees=(4, 8), max_depth=(3,), num_folds=2, parallelism=2),
    )
    assert {r.Model for r in res.metrics.collect()} == {"Linear Regression", "Random Forest", "Gradient Boosted Trees"}
    assert [r["rank"] for r in res.ranking.collect()] == [1, 2, 3]
    assert res.grid.count() == 2
    comp = {r.metric: r for r in res.comparison.collect()}
    assert set(comp) == {"RMSE", "MAE", "R2"} and comp["RMSE"].before is not None
    assert res.importance.count() == 10
    # one run id on every written table; actual stage counts reported
    for table in ("metrics", "comparison", "stage_counts"):
        assert {r.run_id for r in spark.read.parquet(res.paths[table]).collect()} == {res.run_id}
    clean = K.clean(spark, sf_small).count()
    assert [r.n_rows for r in res.stage_counts.orderBy("stage_no").collect()][::2] == [1000, clean]
    model = PipelineModel.load(res.paths["model:final"])
    assert model.transform(K.features(spark, sf_small)).count() == clean


def test_workflow_with_sample(spark, sf_small):
    res = run_workflow(
        spark,
        K.raw_trips(spark, sf_small),
        scratch_path(spark, "wf-sample"),
        models=ModelProfile(rf_num_trees=4, rf_max_depth=3, gbt_max_iter=3),
        tuning=TuningProfile(num_trees=(4,), max_depth=(3,), num_folds=2, parallelism=1),
        kinds=("lr",),
        sample_size=400,
        clean=False,
        run_id="parity-run",
    )
    assert [r.Model for r in res.metrics.collect()] == ["Linear Regression"]
    assert res.run_id == "parity-run"


def test_command_line(spark, sf_small, capsys):
    from cabmetrics.__main__ import main
    from cabmetrics.plans.common import trips_table

    out = main(["--trips", trips_table(spark, sf_small), "--out", scratch_path(spark, "cli"), "--num-trees", "4", "--max-depth", "3", "--run-id", "r1"])
    assert [m["rank"] for m in out["metrics"]] == [1, 2, 3]
    assert out["run_id"] == "r1" and [s["stage"] for s in out["stage_counts"]] == ["original", "no_nulls", "no_outliers"]
    assert "model:final" in out["paths"]
    assert capsys.readouterr().out.strip().startswith("{")
