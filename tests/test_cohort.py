from riskframe.functions import codes as C
from riskframe.operators import cohort as coh

CASE_COLS = ["CLASSI_FIN", "VACINA_COV", "EVOLUCAO", "TP_IDADE", "RENAL", "ASMA",
             "NU_IDADE_N", "CS_SEXO"]
SPEC = coh.CohortSpec(date_sentinel="12/02/2021", flag_cols=("RENAL", "ASMA"))


def frame(spark, rows):
    schema = ", ".join(f"{c} STRING" for c in CASE_COLS)
    return spark.createDataFrame(rows, schema)


def test_cohort_filter_rules(spark):
    rows = [
        ("5", "01/01/2021", "1", "3", "1", "2", "40", "M"),    # kept
        (" 5 ", "01/01/2021", "2", "3", "9", None, "41", "F"),  # kept: spaces parse
        ("5.0", "01/01/2021", "1", "3", "1", "1", "42", "M"),   # dropped: not an int
        ("5", None, "1", "3", "1", "1", "43", "M"),             # dropped: null date
        ("5", "12/02/2021", "1", "3", "1", "1", "44", "M"),     # dropped: sentinel
        ("5", "01/01/2021", "9", "3", "1", "1", "45", "M"),     # dropped: outcome 9
        ("5", "01/01/2021", "1", "2", "1", "1", "46", "M"),     # dropped: age unit
        ("x", "01/01/2021", "1", "3", "1", "1", "47", "M"),     # dropped: bad code
    ]
    out = coh.cohort_filter(frame(spark, rows), SPEC).collect()
    assert sorted(r["NU_IDADE_N"] for r in out) == ["40", "41"]
    assert list(out[0].asDict()) == SPEC.selected_cols


def test_cohort_encode_values(spark):
    rows = [
        ("5", "d", "1", "3", "1", "2", "40", "M"),
        ("5", "d", "2", "3", "9", None, "NA", "F"),
        ("5", "d", "2", "3", "1", "1", "50", "I"),  # unknown sex: dropped
    ]
    out = coh.select_cohort(frame(spark, rows), SPEC).orderBy("CS_SEXO").collect()
    assert [tuple(r) for r in out] == [(0, 0, None, 0, "2", 1), (1, 0, 40, 1, "1", 0)]


def test_empty_input_keeps_schema(spark):
    out = coh.select_cohort(frame(spark, []), SPEC)
    assert out.count() == 0
    assert out.columns == SPEC.feature_cols + ["EVOLUCAO", "label"]


def test_encoders(spark):
    df = spark.createDataFrame([("1",), ("2",), ("9",), (None,), ("S",), ("N",)], "x STRING")
    got = df.select(C.flag_binary("x").alias("f"), C.ternary("x").alias("t"),
                    C.two_code("x", "S", "N").alias("s"),
                    C.normalize_codes("x", {"S": "1", "N": "2"}).alias("n")).collect()
    assert [r["f"] for r in got] == [1, 0, 0, 0, 0, 0]
    assert [r["t"] for r in got] == [1, -1, 0, 0, 0, 0]
    assert [r["s"] for r in got] == [None, None, None, None, 1, 0]
    assert [r["n"] for r in got] == ["1", "2", "9", None, "1", "2"]


def test_fill_unknown_only_strings(spark):
    df = spark.createDataFrame([(None, None)], "a STRING, b INT")
    r = coh.fill_unknown(df, "9").first()
    assert r["a"] == "9" and r["b"] is None


def test_type_dispatch(spark):
    df = spark.createDataFrame([("a", 1, 2.0, "y")], "s STRING, i INT, d DOUBLE, EVOLUCAO STRING")
    assert coh.type_dispatch(df, exclude=("EVOLUCAO",)) == (["s"], ["i", "d"])


def test_malformed_numbers_become_null(spark):
    df = spark.createDataFrame([("12",), (" 7 ",), ("NA",), ("40.0",), (None,)], "x STRING")
    assert [r[0] for r in df.select(C.to_int("x")).collect()] == [12, 7, None, None, None]


def test_label_offset(spark):
    df = spark.createDataFrame([("1",), ("2",)], "EVOLUCAO STRING")
    assert [r[0] for r in coh.derive_label(df, "EVOLUCAO").select("label").collect()] == [0, 1]
