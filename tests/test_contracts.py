import pytest
from pyspark.sql import functions as F

from tessera.operators import contracts as C
from tessera.operators.contracts import PreferenceFields, ResponseFields

SCHEMA = "row_index bigint, id string, prompt string, response string, metadata map<string,string>"
MESSAGES = "row_index bigint, id string, prompt array<struct<role:string,content:string,extra:string>>, chosen array<struct<role:string,content:string,extra:string>>, rejected array<struct<role:string,content:string,extra:string>>"


def codes(df, fields, limit=None):
    return {r.row_index: r.violation for r in C.check_rows(df, fields, limit).collect()}


def test_response_contract_order_and_duplicates(spark):
    m = {"a": "b"}
    df = spark.createDataFrame(
        [(0, "x", "p", "r", m), (1, "x", "p", "r", m), (2, None, " ", None, None), (3, "y", "p", "　", m), (4, " ", "p", "r", m), (5, "z", "p", "r", None), (6, "x", "p", "", m)],
        SCHEMA,
    )
    assert codes(df, ResponseFields()) == {0: None, 1: "duplicate_id", 2: "prompt", 3: "response", 4: "id", 5: "metadata", 6: "response"}
    assert codes(df, ResponseFields(), 1) == {0: None}
    first = C.first_violation(C.check_rows(df, ResponseFields())).collect()
    assert [(r.row_index, r.code) for r in first] == [(1, "duplicate_id")]
    with pytest.raises(C.ContractError, match="row 1: duplicate_id"):
        C.require_valid(df, ResponseFields())
    s = C.summary(df, C.check_rows(df, ResponseFields())).collect()[0]
    assert (s.row_count, s.inspected_rows, s.unique_ids, s.n_violations) == (7, 7, 1, 6)


def test_generated_ids_and_remapped_columns(spark):
    df = spark.createDataFrame([(3, "p", "a")], "row_index bigint, instruction string, answer string")
    fields = ResponseFields("instruction", "answer", None, None, "train")
    r = C.canonical(df, fields).collect()[0]
    assert (r.id, r.prompt, r.response, r.metadata) == ("train-00000003", "p", "a", {})


def test_missing_columns_are_named_in_order(spark):
    df = spark.createDataFrame([(1,)], "row_index int")
    with pytest.raises(C.ContractError, match="id, metadata, prompt, response"):
        C.check_rows(df, ResponseFields())


def test_limit_must_be_positive(spark):
    with pytest.raises(ValueError, match="positive"):
        C.check_rows(spark.createDataFrame([], SCHEMA), ResponseFields(), 0)


def test_empty_dataset(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert C.first_violation(C.check_rows(df, ResponseFields())).count() == 0
    assert C.summary(df, C.check_rows(df, ResponseFields())).collect()[0].asDict() == {"row_count": 0, "inspected_rows": 0, "unique_ids": 0, "n_violations": 0}
    C.require_valid(df, ResponseFields())


def test_standard_preferences(spark):
    df = spark.createDataFrame(
        [(0, "a", "p", "c", "r"), (1, "b", "p", "c", "c"), (2, None, "", "c", "c"), (3, "d", "p", None, "r")], "row_index bigint, id string, prompt string, chosen string, rejected string"
    )
    fields = PreferenceFields(metadata=None)
    assert codes(df, fields) == {0: None, 1: "identical", 2: "id", 3: "chosen"}
    assert C.dataset_format(df, fields) == "standard"
    assert C.dataset_format(df.limit(0), fields) == "empty"


def msg(*pairs):
    return [(r, c, "x") for r, c in pairs]


def test_conversational_preferences(spark):
    u, a, b = msg(("user", "q")), msg(("assistant", "yes")), msg(("assistant", "no"))
    other = [("assistant", "yes", "y")]  # differs in a key that isn't kept
    df = spark.createDataFrame(
        [(0, "a", u, a, b), (1, "b", u, a, other), (2, "c", [], a, b), (3, "d", u, msg(("assistant", "ok"), (" ", "x")), b), (4, "e", u, a, None), (5, "f", u, a, msg(("assistant", None)))], MESSAGES
    )
    fields = PreferenceFields(metadata=None)
    assert codes(df, fields) == {0: None, 1: "identical", 2: "prompt", 3: "chosen_message", 4: "rejected", 5: "rejected_message"}
    at = {r.row_index: r.at for r in df.select("row_index", C.bad_message(F.col("chosen")).alias("at")).collect()}
    assert at[3] == 1 and at[0] == -1
    r = C.canonical(df, fields).collect()[0]
    assert r.prompt[0].asDict() == {"role": "user", "content": "q"}


def test_mixed_formats(spark):
    df = spark.createDataFrame([(0, "a", "p", "c", msg(("assistant", "r")))], "row_index bigint, id string, prompt string, chosen string, rejected array<struct<role:string,content:string,extra:string>>")
    assert codes(df, PreferenceFields(metadata=None)) == {0: "mixed_formats"}


def test_scan_reads_only_what_a_check_needs(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/response_records.parquet")
    checked = C.check_rows(df.where("row_index < 50"), ResponseFields(metadata=None)).groupBy("violation").count()
    plan = checked._jdf.queryExecution().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("created_at" not in s and "metadata" not in s.split("ReadSchema")[1] for s in scans)
    assert any("GreaterThan" in s or "LessThan(row_index" in s for s in scans)
