"""Scale properties, checked on Spark's executed plans: what is shuffled,
what is broadcast, what the scans read."""
from fairstream.operators import cluster, fair, metrics, sketch, topk
from fairstream.plans import fixtures as fx
from fairstream.plans.queries import CM, CS
from fairstream.sources import items as I
from fairstream.sources import points as P
from tests.conftest import SF_SMALL


def _plan(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_assignment_is_map_only_and_pruned(spark):
    plan = _plan(cluster.assign(P.points2d(spark, SF_SMALL), fx.CENTERS_2D))
    assert "Exchange" not in plan and "Join" not in plan
    assert "o_custkey" not in plan and "o_orderstatus" not in plan   # pruned columns
    assert "*(1) Project" in plan                                   # inside whole-stage codegen


def test_metric_table_is_one_small_shuffle(spark):
    plan = _plan(metrics.cluster_group_table(P.points2d(spark, SF_SMALL), fx.CENTERS_2D))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan and "partial_sum" in plan


def test_fair_stats_one_pass(spark):
    plan = _plan(fair.cluster_group_stats(P.points2d(spark, SF_SMALL), fx.CENTERS_2D))
    assert plan.count("FileScan") == 1
    assert "partial_var_pop" in plan or "partial_avg" in plan


def test_sketches_share_one_scan_and_combine_map_side(spark):
    plan = _plan(sketch.build(I.skewed_items(spark, SF_SMALL), [CM, CS]))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan


def test_lookup_joins_nothing(spark):
    it = I.skewed_items(spark, SF_SMALL)
    est = sketch.estimate(topk.item_counts(it), sketch.build(it, [CM, CS]), [CM, CS])
    plan = _plan(est)
    main = plan[:plan.index("Subquery")] if "Subquery" in plan else plan
    assert "Subquery" in plan and "Join" not in plan
    assert main.count("Exchange hashpartitioning") <= 1          # the histogram's own


def test_threshold_reuses_the_histogram(spark):
    hh = topk.heavy_hitters(topk.item_counts(I.skewed_items(spark, SF_SMALL)), fx.TOP_K)
    plan = _plan(hh, run=True)
    assert "ReusedExchange" in plan
    assert "Window" in plan         # over the frequency-of-frequencies table only


def test_last_lloyd_round_scans_once(spark):
    df = cluster.lloyd_rounds(P.points2d(spark, SF_SMALL), fx.CENTERS_2D, 1)
    plan = _plan(df)
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_entry_works_without_the_training_data_operators(tmp_path):
    """The subpackage gone, emptied, or without a library it needs: the rest imports."""
    import os
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for case in ("gone", "emptied", "no library"):
        copy = tmp_path / case
        shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "tests"))
        llm = copy / "fairstream" / "llm"
        if case != "no library" and llm.exists():
            shutil.rmtree(llm)
        if case == "emptied":
            llm.mkdir()
        if case == "no library":
            (copy / "zstandard.py").write_text("raise ImportError('no zstandard here')")
        code = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.oracle_sql(), 'pipeline' in e.queries())"
        done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
        n, _, pipeline = done.stdout.split()
        assert int(n) >= 59 and pipeline == "False", done.stderr
