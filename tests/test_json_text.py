import json

from pyspark.sql import functions as F

from rtmart import schemas as S
from rtmart.functions import json_text as J
from rtmart.operators import ingest


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_numbers_quoted_or_not(spark):
    df = J.decode_json(lines(spark, '{"id":"1","total_amount":"12.5"}', '{"id":2,"total_amount":12.5}'), S.ORDER_INFO)
    assert [(r.id, r.total_amount) for r in df.collect()] == [("1", 12.5), ("2", 12.5)]


def test_rejects_complement_decoded(spark):
    bad = ["oops", "[1,2]", "12", None, "{}", "", '{"unknown":1}', '{"uid":"1","ts":5}', '{"mid":"m","ts":"soon"}']
    good = ['{"mid":"m","ts":5}', '{"mid":"m","ts":"6","x":[1]}']
    df = lines(spark, *bad, *good)
    required = ("mid", "ts")
    assert sorted(r.ts for r in J.decode_json(df, S.STARTUP_LOG, required=required).collect()) == [5, 6]
    rejected = [r.value for r in J.rejected_json(df, S.STARTUP_LOG, required=required).collect()]
    assert sorted(map(str, rejected)) == sorted(map(str, bad))


def test_each_line_is_parsed_once(spark):
    df = J.decode_json(lines(spark, '{"mid":"m","ts":5}'), S.STARTUP_LOG, required=("mid", "ts"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_server_time_replaces_client_time_and_types_stay(spark):
    sent = '{"type":"startup","ts":1,"n":7,"deep":{"k":[1,null]},"none":null}'
    out = ingest.route_logs(lines(spark, sent), F.lit(99)).first()
    assert out.topic == S.TOPIC_START and out.ts == 99
    assert json.loads(out.value) == {**json.loads(sent), "ts": 99}


def test_log_routing(spark):
    df = lines(spark, '{"type":"startup"}', '{"type":"event"}', '{"mid":"1"}', '{"type":null}', '{"type":7}', "oops")
    topics = [r.topic for r in ingest.route_logs(df, F.lit(1)).collect()]
    assert topics == [S.TOPIC_START] + [S.TOPIC_EVENT] * 4
    assert [r.value for r in ingest.rejected_logs(df).collect()] == ["oops"]


def test_daily_log_folder(spark, tmp_path):
    df = lines(spark, '{"a":1}', '{"a":2}')
    routed = ingest.route_logs(df, F.lit(1704153599000))
    ingest.write_daily_log(routed, str(tmp_path / "log"))
    back = spark.read.text(str(tmp_path / "log" / "day=2024-01-01"))
    assert sorted(json.loads(r.value)["a"] for r in back.collect()) == [1, 2]


def test_change_routing(spark):
    cases = [
        ("ROWDATA", "order_info", "INSERT", S.TOPIC_ORDER_INFO),
        ("ROWDATA", "order_info", "UPDATE", None),
        ("ROWDATA", "order_detail", "INSERT", S.TOPIC_ORDER_DETAIL),
        ("ROWDATA", "order_detail", "DELETE", None),
        ("ROWDATA", "user_info", "INSERT", S.TOPIC_USER_INFO),
        ("ROWDATA", "user_info", "UPDATE", S.TOPIC_USER_INFO),
        ("ROWDATA", "user_info", "DELETE", None),
        ("ROWDATA", "sku_info", "INSERT", None),
        ("TRANSACTIONBEGIN", "user_info", "INSERT", None),
    ]
    rows = [(e, t, o, {"id": str(i), "note": None}) for i, (e, t, o, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "entry_type string, table string, op string, after map<string,string>")
    got = {json.loads(r.value)["id"]: r.topic for r in ingest.route_changes(df).collect()}
    assert got == {str(i): c[3] for i, c in enumerate(cases) if c[3]}
