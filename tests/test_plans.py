"""Plan shape: filters and projections reach the scan on raw coded files."""

import contextlib
import io

from riskframe.operators import cohort as coh
from riskframe.plans import queries as Q
from riskframe.plans import standin as S
from riskframe.session import scratch_path
from riskframe.sources import files, sinks
from tests.conftest import SMALL


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_cohort_filters_pushed_to_parquet_scan(spark):
    path = sinks.write_parquet(Q.cases(spark, SMALL), scratch_path(spark, "raw-cases"))
    out = coh.select_cohort(files.scan_parquet(spark, path), S.CASE_SPEC)
    text = plan_text(out)
    assert "PushedFilters" in text
    for pushed in ("IsNotNull(CLASSI_FIN)", "In(EVOLUCAO", "IsNotNull(VACINA_COV)",
                   "Not(EqualTo(VACINA_COV,12/02/2000))", "IsNotNull(TP_IDADE)"):
        assert pushed in text, pushed
    # Only the columns the cohort needs are read.
    read_schema = [ln for ln in text.splitlines() if ln.startswith("ReadSchema")][0]
    assert "case_order" not in read_schema and "FATOR_RISC" not in read_schema


def test_clean_codes_are_pushed_as_text(spark):
    path = sinks.write_parquet(Q.cases(spark, SMALL), scratch_path(spark, "raw-cases"))
    raw = files.scan_parquet(spark, path)
    out = coh.select_cohort(raw, S.CASE_SPEC.with_(clean_codes=True))
    text = plan_text(out)
    assert "EqualTo(CLASSI_FIN,5)" in text and "EqualTo(TP_IDADE,3)" in text
    assert out.count() == coh.select_cohort(raw, S.CASE_SPEC).count()


def test_confusion_metrics_single_scan_partial_aggregate(spark):
    text = plan_text(Q.QUERIES["class_metrics"](spark, SMALL))
    scans = [ln for ln in text.splitlines() if ln.startswith("(") and "Scan parquet" in ln]
    assert len(scans) == 1
    assert "partial_count" in text


def test_pivot_with_values_needs_no_distinct_job(spark):
    scans = lambda df: plan_text(df).count("Scan parquet")
    df = Q.QUERIES["pivot_sum"](spark, SMALL)
    assert scans(df) and {r["l_returnflag"] for r in df.collect()} <= set("ANR")
    assert df.columns == ["l_returnflag", "F", "O"]


def test_correlation_makes_no_row_per_pair(spark):
    from riskframe.operators import metrics as met
    cols = list(Q.CORR_COLS)
    df = met.pair_vectors(Q.cohort(spark, SMALL), cols, [0.0] * len(cols))
    text = plan_text(df)
    for node in ("Generate", "Expand", "MapInArrow", "PythonUDF", "Exchange"):
        assert node not in text, node
    assert {r["v"].size for r in df.collect()} == {3 * len(cols)}


def test_seven_models_are_scored_in_one_scan(spark):
    from riskframe.plans import models as M
    train = Q.planted_training(spark, SMALL)
    fitted = {k: M.fit(k, train, **Q.planted_settings(k)) for k in ("lr", "nb", "lsvc")}
    models = {f"{k}{i}": m for i in range(3) for k, m in fitted.items()}
    text = plan_text(Q.planted_model_confusion(models, Q.planted_assembled(spark, SMALL)))
    scans = [ln for ln in text.splitlines() if ln.startswith("(") and "Scan parquet" in ln]
    assert len(models) == 9 and len(scans) == 1


def test_a_cluster_session_without_checkpoint_folder_raises(spark):
    import pytest
    from riskframe.session import scratch_root

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="checkpoint"):
        scratch_root(Session())
