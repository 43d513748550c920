"""Plan shape checks: the blocked operators never fall back to one partition,
and scans prune columns and push filters."""

from pyspark.sql import functions as F

from given import SF001
from ledgerline import catalog as C
from ledgerline.operators import backtest as BT


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return df._jdf.queryExecution().explainString(jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_blocked_plans_never_use_a_single_partition(spark):
    ds = C.modeling_dataset(spark, SF001)
    rules = BT.rule_strategy_frames(ds)
    preds = C.score_predictions(ds)
    for df in (
        rules,
        BT.portfolio_daily_returns(rules, C.RUN),
        BT.sweep_daily(preds, BT.THRESHOLDS, ["split"])[0],
    ):
        plan = _plan(df)
        assert "SinglePartition" not in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_document_scan_is_pruned(spark):
    text = _formatted(C.QUERIES["classification_metrics"](spark, SF001))
    assert "ReadSchema: struct<doc_id:bigint,lang:string,n_chars:bigint>" in text
    assert "text:string" not in text


def test_panel_scan_pushes_filters(spark):
    from ledgerline.sources.panels import order_panel_raw

    text = _formatted(order_panel_raw(spark, SF001))
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_orderdate)]" in text
    assert "o_orderpriority" not in text
