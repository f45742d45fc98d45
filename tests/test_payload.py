import json

import pytest
from pyspark.sql import functions as F

from brindle.operators import payload as p
from brindle.sources import schemas as S

COLUMNS = "acme_request_id string, status_code string, timestamp_ms long, request string, response string"
CHOICES = [{"message": {"role": "assistant", "content": "hi"}}]


def chat(*turns, conversation="c1"):
    messages = [{"role": "user", "content": t} for t in turns]
    return json.dumps({"messages": messages, "acme_options": {"conversation_id": conversation}})


def answer(choices=CHOICES):
    trace = {"app_version_id": "v", "start_timestamp": "2024-01-01T00:00:00Z", "is_truncated": False, "steps": []}
    return json.dumps({"choices": choices, "acme_output": {"trace": trace}})


RATING = {"good": {"value": True, "rationale": "why"}}
TEXT = {"step_id": "t", "ratings": RATING, "free_text_comment": "c", "suggested_output": "s"}
RETRIEVAL = {"position": 2, "step_id": "x", "ratings": None, "free_text_comment": None}


def feedback(**lists):
    record = {"request_id": "r", "step_id": "z", "source": {"type": "human", "id": "u", "tags": {"a": "b"}}, **lists}
    return json.dumps({"dataframe_records": [record]})


@pytest.fixture(scope="module")
def payloads(spark):
    rows = [
        ("chat", "200", 1500, chat("one"), answer()),
        ("two turns", "200", 1500, chat("one", "two"), answer()),
        ("failed", "500", 1500, chat("one"), answer()),
        ("no messages", "200", 1500, chat(), answer()),
        ("broken", "200", 1500, "{not json", "{not json"),
        ("null choices", "200", 1500, chat("one"), answer(None)),
        ("text", "200", 1500, feedback(text_assessments=[TEXT]), "{}"),
        ("retrieval", "200", 1500, feedback(retrieval_assessments=[RETRIEVAL]), "{}"),
        ("both", "200", 1500, feedback(text_assessments=[TEXT], retrieval_assessments=[RETRIEVAL]), "{}"),
        ("neither", "200", 1500, feedback(), "{}"),
    ]
    return spark.createDataFrame(rows, COLUMNS)


def test_routing(payloads):
    requests, assessments = p.split_payloads(p.successful_payloads(payloads))
    names = lambda d: sorted(x.acme_request_id for x in d.collect())
    assert names(requests) == ["chat", "no messages", "two turns"]
    assert names(assessments) == ["both", "broken", "neither", "null choices", "retrieval", "text"]


def test_integer_status_codes(payloads):
    numbers = payloads.withColumn("status_code", F.col("status_code").cast("int"))
    assert p.successful_payloads(numbers).count() == 9


def test_request_log(payloads):
    log, _ = p.unpack_and_split_payloads(payloads)
    got = {r.request.request_id: r for r in log.collect()}
    assert got["chat"].request.last_input == "one"
    assert got["two turns"].request.last_input == "two"
    assert got["no messages"].request.messages == [] and got["no messages"].request.last_input is None
    assert got["chat"].request.conversation_id == "c1"
    assert got["chat"].request.timestamp.timestamp() == 1.5
    assert got["chat"].trace.app_version_id == "v" and got["chat"].trace.steps == []
    assert got["chat"].output.choices[0].message.content == "hi"


def test_assessment_log(payloads):
    _, log = p.unpack_and_split_payloads(payloads)
    rows = log.collect()
    assert len(rows) == 4
    texts = [r for r in rows if r.text_assessment]
    assert all(r.retrieval_assessment is None and r.step_id == "t" for r in texts)
    rating = texts[0].text_assessment.ratings["good"]
    assert (rating.bool_value, rating.double_value, rating.rationale) == (True, None, "why")
    others = [r for r in rows if not r.text_assessment]
    assert all(r.step_id == "x" and r.retrieval_assessment.position == 2 for r in others)
    assert all(r.retrieval_assessment.ratings is None for r in others)
    assert texts[0].source.tags == {"a": "b"}


def shape(kind) -> str:
    return kind.simpleString().replace(" ", "")


def test_schemas_match_the_log_formats(spark, payloads):
    log, assessed = p.unpack_and_split_payloads(payloads)
    want = lambda ddl: shape(spark.range(0).select(F.lit(None).cast(ddl).alias("x")).schema["x"].dataType)
    assert shape(log.schema) == want(S.REQUEST_LOG)
    assert shape(assessed.schema) == want(S.ASSESSMENT_LOG)


def test_no_python_and_one_json_parse_of_messages(payloads):
    log, _ = p.unpack_and_split_payloads(payloads)
    plan = log._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan
    assert plan.count("from_json(ArrayType(StructType(StructField(role") == 1


def test_id_column_is_required(spark):
    with pytest.raises(ValueError):
        p.payload_prefix(spark.range(1))


def test_message_pairs_need_both_sides(spark):
    trace = {"data": {"request": {"messages": [{"role": "user", "content": "q"}]}}}
    rows = [
        ("both", json.dumps({"choices": CHOICES, "acme_output": {"trace": trace}})),
        ("no answer", json.dumps({"acme_output": {"trace": trace}})),
        ("no question", json.dumps({"choices": CHOICES})),
    ]
    pairs = p.message_pairs(spark.createDataFrame(rows, "acme_request_id string, response string")).collect()
    assert [json.loads(m) for m in pairs[0].messages] == [trace["data"]["request"]["messages"][0], CHOICES[0]["message"]]
    assert len(pairs) == 1
