import json
import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from goldleaf.functions.payload import body_records, parse_body
from goldleaf.plans import inference_log as log
from goldleaf.schemas import FEATURE_COLUMNS, REQUEST_RECORD, RESPONSE_RECORD

FIRST = {"trip_distance": 2.5, "pickup_hour": 8, "pickup_dayofweek": 2, "pickup_month": 1, "is_weekend": 0, "is_rush_hour": 1}
SECOND = {**FIRST, "trip_distance": 5, "pickup_hour": 14}
AS_ROWS = [tuple(FIRST.values()), tuple(SECOND.values())]
NOTHING = (None,) * 6


def read(spark, bodies, record=REQUEST_RECORD):
    df = spark.createDataFrame([(k, body) for k, body in enumerate(bodies)], "k int, body string")
    parsed = df.withColumn("_p", parse_body(F.col("body"), record))
    found = parsed.select("k", body_records(F.col("body"), F.col("_p"), record).alias("r")).orderBy("k").collect()
    return [None if row.r is None else [tuple(item) for item in row.r] for row in found]


def split(columns, data):
    return json.dumps({"dataframe_split": {"columns": columns, "data": data}})


def test_five_encodings(spark):
    records = [FIRST, SECOND]
    bodies = [json.dumps({key: records}) for key in ("dataframe_records", "instances", "inputs")]
    bodies.append(split(list(FIRST), [list(FIRST.values()), list(SECOND.values())]))
    assert read(spark, bodies) == [AS_ROWS] * 4
    assert read(spark, ['{"predictions": [1, 2.5, null]}'], RESPONSE_RECORD) == [[(1.0,), (2.5,), (None,)]]


def test_order_of_precedence(spark):
    both = {"predictions": [1.0], "inputs": [SECOND], "instances": [SECOND], "dataframe_records": [FIRST]}
    assert read(spark, [json.dumps(both)]) == [[AS_ROWS[0]]]
    later = {"predictions": [1.0], "inputs": [SECOND]}
    assert read(spark, [json.dumps(later)]) == [[AS_ROWS[1]]]


def test_split_follows_column_names(spark):
    turned = split(["pickup_hour", "extra", "trip_distance"], [[7, "x", 1.25], [9]])
    assert read(spark, [turned]) == [[(1.25, 7, None, None, None, None), (None, 9, None, None, None, None)]]


def test_other_bodies(spark):
    bodies = ["{}", '{"other": 1}', "[1, 2]", json.dumps([FIRST]), "5", "{broken", "", None, '{"instances": []}']
    assert read(spark, bodies) == [[], [], [], [], [], None, None, None, []]


def test_missing_and_malformed_fields_are_null(spark):
    bodies = ['{"instances": [{"pickup_hour": 3}, {"trip_distance": "far", "pickup_hour": 4}]}', '{"inputs": {"pickup_hour": [1, 2]}}']
    records, columns = read(spark, bodies)
    assert records == [(None, 3, None, None, None, None), (None, 4, None, None, None, None)]
    assert columns is None


@pytest.mark.parametrize(
    "text, fares",
    [
        ('[1.0, "x", 3.0]', [1.0, None, 3.0]),
        ('["2.5", 1]', [None, 1.0]),
        ("[[1.5], [2.5]]", [None, None]),
        ("[true, 7]", [None, 7.0]),
        ('[{"predicted_fare": 3.0}, 4]', [None, 4.0]),
        ("[null, 2]", [None, 2.0]),
    ],
)
def test_one_bad_prediction_is_one_null(spark, text, fares):
    assert read(spark, [f'{{"predictions": {text}}}'], RESPONSE_RECORD) == [[(fare,) for fare in fares]]


def test_not_a_number_keeps_its_call(spark):
    (found,) = read(spark, ['{"predictions": [NaN, 1]}'], RESPONSE_RECORD)
    assert len(found) == 2 and found[1] == (1.0,)


def test_text_that_is_no_json_from_end_to_end(spark):
    good = json.dumps({"inputs": [FIRST]})
    assert read(spark, [good + " trailing", good + good, f"{good},{good}", good.replace('"', "'"), f" {good} "]) == [None] * 4 + [[AS_ROWS[0]]]


def test_cells_of_tables(spark):
    quoted = split(["trip_distance", "pickup_hour"], [["2.5", "8"], [1, 8.0], [True, 3]])
    assert [row[:2] for row in read(spark, [quoted])[0]] == [(None, None), (1.0, None), (None, 3)]
    assert read(spark, [split(["pickup_hour", "pickup_hour"], [[1, 2]])])[0][0][1] == 2


LOG = "request string, response string, status_code string, request_time timestamp, served_entity_id string"
NOON = datetime(2024, 5, 1, 12)


def call(request, response, status="200", model="m1"):
    return (request, response, status, NOON, model)


def test_unpack(spark, rows):
    two, answers = json.dumps({"inputs": [FIRST, SECOND]}), '{"predictions": [10, 20]}'
    calls = spark.createDataFrame(
        [
            call(two, answers),
            call(two, '{"predictions": [30]}', model=None),
            call(two, answers, status="500"),
            call("{broken", answers),
            call(None, answers),
            call("{}", '{"predictions": [40]}'),
            call('{"inputs": []}', '{"predictions": []}'),
        ],
        LOG,
    )
    found = log.unpack_payloads(calls)
    assert found.columns == ["timestamp", "date", "model_id", *FEATURE_COLUMNS, "predicted_fare", "example_id"]
    assert rows(found, "model_id", "trip_distance", "pickup_hour", "predicted_fare") == [
        ("m1", 2.5, 8, 10.0),
        ("m1", 5.0, 14, 20.0),
        ("m1", None, None, 40.0),
        ("unknown", 2.5, 8, 30.0),
        ("unknown", 5.0, 14, None),
    ]
    ids = [row.example_id for row in found.collect()]
    assert len(set(ids)) == 5 and sorted(ids) == sorted(row.example_id for row in found.collect())


def test_unpack_keeps_the_rows_around_a_bad_prediction(spark, rows):
    three = json.dumps({"inputs": [FIRST, SECOND, FIRST]})
    found = log.unpack_payloads(spark.createDataFrame([call(three, '{"predictions": [1.0, "x", 3.0]}')], LOG))
    assert rows(found, "trip_distance", "predicted_fare") == [(2.5, 1.0), (2.5, 3.0), (5.0, None)]


def test_number_status_and_no_calls(spark):
    number = LOG.replace("status_code string", "status_code int")
    one = spark.createDataFrame([call('{"inputs": [{}]}', '{"predictions": [1]}', 200)], number)
    assert log.unpack_payloads(one).count() == 1
    none = log.unpack_payloads(spark.createDataFrame([], LOG))
    assert none.count() == 0 and "example_id" in none.columns


def test_parsing_needs_no_python_worker(spark):
    plan = log.unpack_payloads(spark.createDataFrame([call("{}", "{}")], LOG))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.replace("PythonRDD", "")


PREDICTED = "timestamp timestamp, date date, model_id string, trip_distance float, pickup_hour int, pickup_dayofweek int, pickup_month int, is_weekend int, is_rush_hour int, predicted_fare float, example_id string"
KNOWN = "trip_distance double, pickup_hour int, pickup_dayofweek int, pickup_month int, is_weekend int, is_rush_hour int, fare_amount double"


def predicted(spark, distances, fare=10.0):
    return spark.createDataFrame(
        [(NOON, NOON.date(), "m", d, 8, 2, 1, 0, 1, fare, str(k)) for k, d in enumerate(distances)], PREDICTED
    )


def known(spark, pairs):
    return spark.createDataFrame([(d, 8, 2, 1, 0, 1, fare) for d, fare in pairs], KNOWN)


def test_distance_that_is_no_exact_float(spark):
    joined = log.join_ground_truth(predicted(spark, [2.1]), known(spark, [(2.1, 12.0)]))
    assert [row.fare_amount for row in joined.collect()] == [12.0]


def test_unmatched_and_null_features_keep_a_null_label(spark):
    joined = log.join_ground_truth(predicted(spark, [1.0, None]), known(spark, [(2.0, 9.0), (None, 9.0)]))
    assert [(row.fare_amount, row.label_count) for row in joined.collect()] == [(None, None)] * 2


@pytest.fixture(scope="module")
def repeated(spark):
    """Feature vectors that repeat on both sides; one holds a third of all rows."""
    draw = random.Random(3)
    pick = lambda: 1.0 if draw.random() < 0.34 else float(draw.randrange(2, 12))
    asked = [pick() for _ in range(150)]
    truth = [(pick(), float(draw.randrange(5, 9))) for _ in range(200)]
    return asked, truth


def test_every_label_keeps_every_match(spark, repeated, rows):
    asked, truth = repeated
    joined = log.join_ground_truth(predicted(spark, asked), known(spark, truth), every_label=True)
    expected = Counter()
    for k, distance in enumerate(asked):
        fares = [fare for d, fare in truth if d == distance] or [None]
        expected.update((str(k), fare) for fare in fares)
    assert {(r.example_id, r.fare_amount): r.label_count or 1 for r in joined.collect()} == dict(expected)
    plain = Counter((r.example_id, r.fare_amount) for r in log.expand_labels(joined, block=3).collect())
    assert plain == expected


def test_one_label_per_prediction(spark, repeated):
    asked, truth = repeated
    joined = log.join_ground_truth(predicted(spark, asked), known(spark, truth)).collect()
    assert len(joined) == len(asked)
    for row in joined:
        fares = [fare for d, fare in truth if d == row.trip_distance]
        assert row.fare_amount == (pytest.approx(sum(fares) / len(fares)) if fares else None)


def test_match_rate(spark, repeated):
    asked, truth = repeated
    hits = [sum(d == distance for d, _ in truth) for distance in asked]
    row = log.match_rate(predicted(spark, asked), known(spark, truth)).first()
    assert (row.matched, row.total) == (sum(hits), sum(max(h, 1) for h in hits))
    assert row.match_rate == pytest.approx(row.matched / row.total)


def test_each_body_is_read_once_for_its_records_and_once_for_its_names(spark):
    calls = spark.createDataFrame(
        [(1, '{"inputs":[{"pickup_hour":3},{"pickup_hour":4}]}', '{"predictions":[1.5]}'), (2, None, "{}"), (3, "[1]", "{")],
        "k int, request string, response string",
    )
    parsed = log.normalize_payloads(calls)
    rows = log.each_record(parsed, F.col("request"), "position", "r", "k")
    assert [tuple(row) for row in rows.orderBy("position").select("k", "position", "r.pickup_hour").collect()] == [(1, 0, 3), (1, 1, 4)]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2 and plan.count("json_object_keys(") <= 1
    answers = {row["k"]: row["response"] for row in parsed.collect()}
    assert [len(answers[1]), answers[2], answers[3]] == [1, [], None]
